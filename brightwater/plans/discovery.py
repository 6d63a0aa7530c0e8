"""Searches, lookups and boards over answers that are made of the order table: a term a customer, and a record an order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import discovery
from .registry import query, table

_RECORD = {
    "quotes": {"symbol": "CASE WHEN o_orderkey % 5 <> 0 THEN concat(' P', o_orderkey % 11, ' ') END", "score": "o_totalprice", "shortname": "o_orderpriority", "isYahooFinance": "o_orderkey % 2 = 0"},
    "lists": {"slug": "CASE WHEN o_orderkey % 2 = 0 THEN concat('l', o_orderkey % 7) END", "name": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END", "symbolCount": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END",
              "canonicalName": "CASE WHEN o_orderkey % 2 = 1 THEN concat('l', o_orderkey % 7) END", "title": "CASE WHEN o_orderkey % 2 = 1 THEN upper(o_orderpriority) END", "total": "CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey END"},
    "researchReports": {"id": "concat(repeat('r', CASE WHEN o_orderkey % 9 = 8 THEN 70 ELSE 1 END), o_orderkey % 9)", "reportDate": "o_orderkey * 1000", "author": "o_orderpriority"},
    "news": {"uuid": "concat('n', o_orderkey % 300)", "title": "CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END", "providerPublishTime": "1700000000", "relatedTickers": "array(concat('T', o_orderkey % 300 % 9), repeat('X', 40))"},
}


def _answers(spark, d):
    o = table(spark, d, "orders")
    records = [F.struct(*[F.expr(sql).alias(name) for name, sql in fields.items()]).alias(part) for part, fields in _RECORD.items()]
    one = o.select(F.concat(F.lit("term "), F.col("o_custkey").cast("string")).alias("query_term"), F.struct("o_orderkey", *records).alias("r"))
    listed = one.groupBy("query_term").agg(F.array_sort(F.collect_list("r")).alias("r"))  # orders of one customer are few
    body = F.to_json(F.struct(*[F.col(f"r.{part}").alias(part) for part in _RECORD]))
    return listed.select("query_term", F.lit("2024-02-01").cast("timestamp").alias("fetched_at"), body.alias("payload"))


@query("ds_search_quotes", """
    WITH q AS (SELECT o_custkey, 'P' || (o_orderkey % 11) AS symbol, min(o_orderkey) AS k, arg_min(o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR, o_orderkey) AS score, arg_min(o_orderpriority, o_orderkey) AS short_name FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY ALL)
    SELECT 'term ' || o_custkey AS query_term, symbol, (row_number() OVER (PARTITION BY o_custkey ORDER BY k) - 1)::INT AS rank_index, score, short_name, k % 2 = 0 AS is_listed FROM q""")
def search_quotes(spark, d):
    """Quotes by rank; those without a symbol take none, and a symbol that comes again stays where it was first."""
    out = discovery.search(_answers(spark, d))["search_quotes"]
    return out.select("query_term", "symbol", "rank_index", F.col("score").cast("string").alias("score"), "short_name", "is_listed")


@query("ds_search_lists", """
    WITH q AS (SELECT o_custkey, 'l' || (o_orderkey % 7) AS list_key, min(o_orderkey) AS k, arg_min(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE upper(o_orderpriority) END, o_orderkey) AS name FROM orders GROUP BY ALL)
    SELECT 'term ' || o_custkey AS query_term, list_key, (row_number() OVER (PARTITION BY o_custkey ORDER BY k) - 1)::INT AS rank_index, name, CASE WHEN k % 2 = 0 THEN k END::VARCHAR AS symbol_count, CASE WHEN k % 2 = 1 THEN k END::VARCHAR AS total FROM q""")
def search_lists(spark, d):
    """One table of two shapes, ranked together."""
    out = discovery.search(_answers(spark, d))["search_lists"]
    return out.select("query_term", "list_key", "rank_index", "name", F.col("symbol_count").cast("string").alias("symbol_count"), F.col("total").cast("string").alias("total"))


@query("ds_search_reports", """
    WITH h AS (SELECT o_custkey, 'r' || (o_orderkey % 9) AS report_id, min(o_orderkey) AS k FROM orders WHERE o_orderkey % 9 <> 8 GROUP BY ALL)
    SELECT 'term ' || o_custkey AS query_term, report_id, (row_number() OVER (PARTITION BY o_custkey ORDER BY k) - 1)::INT AS rank_index FROM h""")
def search_reports(spark, d):
    """Hits of reports by term; an overlong id is left out and takes no rank."""
    return discovery.search(_answers(spark, d))["search_report_hits"].select("query_term", "report_id", "rank_index")


@query("ds_research_reports", """
    WITH h AS (SELECT 'term ' || o_custkey AS term, 'r' || (o_orderkey % 9) AS report_id, min(o_orderkey) AS k, arg_min(o_orderpriority, o_orderkey) AS author FROM orders WHERE o_orderkey % 9 <> 8 GROUP BY ALL)
    SELECT report_id, arg_max(author, term) AS author, strftime(to_timestamp(arg_max(k, term)) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS report_ts FROM h GROUP BY 1""")
def research_reports(spark, d):
    """A report that several terms share is one row."""
    out = discovery.search(_answers(spark, d))["research_reports"]
    return out.select("report_id", "author", F.date_format("report_ts_utc", "yyyy-MM-dd HH:mm:ss").alias("report_ts"))


@query("ds_search_news", """
    WITH n AS (SELECT o_custkey, o_orderkey % 300 AS id, arg_min(o_orderkey, o_orderkey) AS k FROM orders GROUP BY ALL) SELECT DISTINCT 'n' || id AS news_id, 'T' || (id % 9) AS symbol FROM n WHERE k % 6 <> 0""")
def search_news(spark, d):
    """Articles with a title and a time link to the tickers they name, if those can be symbols at all."""
    return discovery.search(_answers(spark, d))["news_symbols"].select("news_id", "symbol")


_DOCS = """d AS (SELECT o_custkey, 'P' || (o_orderkey % 11) AS symbol, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders)"""


def _lookups(spark, d):
    o = table(spark, d, "orders")
    doc = F.struct(F.concat(F.lit("P"), (F.col("o_orderkey") % 11).cast("string")).alias("symbol"), F.when(F.col("o_orderkey") % 3 == 0, "equity").otherwise("all").alias("lookupType"), F.col("o_totalprice").alias("regularMarketPrice"), F.col("o_orderkey").alias("rank"))
    listed = o.groupBy(F.concat(F.lit("term "), F.col("o_custkey").cast("string")).alias("query_term")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", doc.alias("doc")))).alias("r"))
    totals = F.create_map(F.lit("all"), F.size("r"), F.lit("equity"), F.size(F.filter("r", lambda r: r["o_orderkey"] % 3 == 0)))
    body = F.to_json(F.struct(F.transform("r", lambda r: r["doc"]).alias("documents"), totals.alias("lookupTotals")))
    return listed.select("query_term", F.lit("2024-02-01").cast("timestamp").alias("fetched_at"), body.alias("payload"))


@query("ds_lookup_results", f"""
    WITH {_DOCS} SELECT 'term ' || o_custkey AS query_term, symbol, min(place)::INT AS rank_index, CASE WHEN min(o_orderkey) % 3 = 0 THEN 'equity' ELSE 'all' END AS lookup_type, arg_min(o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR, o_orderkey) AS price FROM d GROUP BY o_custkey, symbol""")
def lookup_results(spark, d):
    """The first document of a symbol stays, at its place in the answer."""
    out = discovery.lookup(_lookups(spark, d))["lookup_results"]
    return out.select("query_term", "symbol", "rank_index", "lookup_type", F.col("regular_market_price").cast("string").alias("price"))


@query("ds_lookup_totals", "SELECT 'term ' || o_custkey AS query_term, 'all' AS lookup_type, count(*) AS total FROM orders GROUP BY o_custkey UNION ALL SELECT 'term ' || o_custkey, 'equity', count(*) FILTER (o_orderkey % 3 = 0) FROM orders GROUP BY o_custkey")
def lookup_totals(spark, d):
    """As many types as the answer names, those without any included."""
    return discovery.lookup(_lookups(spark, d))["lookup_totals"].drop("fetched_at")


@query("ds_market_summary", """
    SELECT n_name AS region, 'B' || s_suppkey AS board_code, 'S' || s_suppkey AS symbol, s_acctbal::VARCHAR::DECIMAL(28,12)::VARCHAR AS price, s_suppkey % 2 = 0 AS is_known FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def market_summary(spark, d):
    """Boards of a region to rows; symbols that the universe has are marked, and none is left out."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey").cast("string")
    board = F.to_json(F.struct(F.concat(F.lit(" s"), key).alias("symbol"), F.col("s_acctbal").alias("regularMarketPrice"), F.lit("REGULAR").alias("marketState")))
    parts = s.groupBy(F.col("n_name").alias("region")).agg(F.collect_list(F.concat(F.lit('"B'), key, F.lit('":'), board)).alias("b"))  # boards of a region are few
    raw = parts.select("region", F.current_timestamp().alias("fetched_at"), F.concat(F.lit("{"), F.array_join("b", ","), F.lit("}")).alias("payload"))
    known = table(spark, d, "supplier").filter("s_suppkey % 2 = 0").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"))
    return discovery.market_summary(raw, known).select("region", "board_code", "symbol", F.col("regular_market_price").cast("string").alias("price"), "is_known")
