"""Screens and sectors made of the order table: a screen a customer, a page a year and a quote an order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import screens
from .registry import query, table


def _pages(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    quote = F.struct(F.when(k % 5 != 0, F.concat(F.lit("P"), (k % 11).cast("string"))).alias("symbol"), F.col("o_totalprice").alias("regularMarketPrice"), k.alias("regularMarketVolume"), F.col("o_orderpriority").alias("shortName"))
    listed = o.groupBy(F.concat(F.lit("screen "), F.col("o_custkey").cast("string")).alias("screen_key"), F.year("o_orderdate").alias("page")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", quote.alias("q")))).alias("r"))  # a customer's orders of a year
    body = F.to_json(F.struct(F.transform("r", lambda r: r["q"]).alias("quotes"), (F.size("r") * 10).alias("total")))
    return listed.select("screen_key", F.lit("2024-02-01").cast("timestamp").alias("fetched_at"), "page", body.alias("payload"))


_PLACED = "r AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN 'P' || (o_orderkey % 11) END AS symbol, row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate), o_orderkey) - 1 AS place FROM orders)"


@query("ds_screen_members", f"WITH {_PLACED} SELECT 'screen ' || o_custkey AS screen_key, symbol, max(place)::INT AS rank_index FROM r WHERE symbol IS NOT NULL GROUP BY ALL")
def screen_members(spark, d):
    """Members by their place over all pages."""
    return screens.screens(_pages(spark, d))["screen_members"].select("screen_key", "symbol", "rank_index")


@query("ds_screen_quotes", f"""
    WITH {_PLACED}, f AS (SELECT 'screen ' || o_custkey AS screen_key, symbol, arg_min(o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR, place) AS price, arg_min(o_orderkey, place) AS volume FROM r WHERE symbol IS NOT NULL GROUP BY ALL)
    SELECT symbol, arg_max(price, screen_key) AS price, arg_max(volume, screen_key)::VARCHAR AS volume FROM f GROUP BY 1""")
def screen_quotes(spark, d):
    """A quote a symbol, however many screens and pages have it."""
    out = screens.screens(_pages(spark, d))["screen_quotes"]
    return out.select("symbol", F.col("regular_market_price").cast("string").alias("price"), F.col("regular_market_volume").cast("string").alias("volume"))


@query("ds_screen_runs", """
    WITH p AS (SELECT o_custkey, year(o_orderdate) AS page, count(*) * 10 AS total FROM orders GROUP BY ALL), m AS (SELECT o_custkey, count(DISTINCT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 11 END) AS members FROM orders GROUP BY 1)
    SELECT 'screen ' || o_custkey AS screen_key, arg_min(total, page)::BIGINT AS total, count(*) AS page_count, any_value(members) AS members FROM p JOIN m USING (o_custkey) GROUP BY o_custkey""")
def screen_runs(spark, d):
    """What the first page says there is, beside what was had; runs without members count too."""
    return screens.screens(_pages(spark, d))["screen_runs"].select("screen_key", "total", "page_count", "members")


@query("ds_domain_taxonomy", """
    WITH s AS (SELECT 'sector ' || n_nationkey AS k, n_name AS name, n_nationkey FROM nation WHERE n_nationkey % 6 <> 5), c AS (SELECT 'industry ' || (c_custkey % 700) AS k, 's' || c_nationkey AS _, c_nationkey, c_custkey FROM customer WHERE c_custkey % 4 <> 0)
    SELECT k AS domain_key, 'sector' AS domain_type, '^S' || n_nationkey AS symbol, 'none' AS parent_key, name FROM s
    UNION ALL SELECT c.k, 'industry', '^I' || split_part(c.k, ' ', 2), min(s.k), 'Industry' FROM c JOIN s ON c_nationkey = n_nationkey GROUP BY c.k""")
def domain_taxonomy(spark, d):
    """Sectors and their industries as one table of parents and children; rows without a key stand for all industries and are none."""
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    no = (F.col("c_custkey") % 700).cast("string")
    part = F.struct(F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("industry "), no)).alias("key"), F.concat(F.lit("^I"), no).alias("symbol"), F.lit("Industry").alias("name"))
    parts = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.collect_set(part).alias("industries"))  # 700 industries at most
    k = F.col("n_nationkey")
    body = F.to_json(F.struct(F.when(k % 6 != 5, F.concat(F.lit("^S"), k.cast("string"))).alias("symbol"), F.col("n_name").alias("name"), F.struct(F.col("n_name").alias("description")).alias("overview"), "industries"))
    raw = n.join(parts, "n_nationkey", "left").select(F.concat(F.lit("sector "), k.cast("string")).alias("sector_key"), F.current_timestamp().alias("fetched_at"), body.alias("payload"))
    return screens.taxonomy(raw)["domains"].select("domain_key", "domain_type", "symbol", F.coalesce("parent_key", F.lit("none")).alias("parent_key"), "name")
