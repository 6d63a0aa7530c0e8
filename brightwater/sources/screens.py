"""Screens page by page, and the taxonomy of sectors and industries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .normalize import _fields, _typed

RUN = ["screen_key", "fetched_at"]

# Source key | column | kind.
QUOTE = _fields("""shortName | short_name | text128
quoteType | quote_type | text32
exchange | exchange | text32
regularMarketPrice | regular_market_price | price
regularMarketChangePercent | regular_market_change_percent | price
regularMarketVolume | regular_market_volume | unsigned
marketCap | market_cap | big""")
# What the index of a domain is listed as.
LISTED_KIND, LISTED_AT = "INDEX", "YHD"


def screens(raw: DataFrame) -> dict[str, DataFrame]:
    """Tables of screens: screen_key, fetched_at, page (from 0), payload (an object of quotes and total).

    A member's rank is its place over all pages of the run, quotes without a symbol included; of a symbol that moved to a later page while pages were fetched the later rank
    stays. Its quote is written once: that of its first place, and of several screens of a day that of the newest run. A run counts pages, members and what the source says there is.
    """
    parsed = F.from_json("payload", "struct<quotes:array<map<string,string>>,total:bigint>")
    pages = raw.withColumn("_p", parsed).withColumn("_n", F.coalesce(F.size("_p.quotes"), F.lit(0)))
    before = F.sum("_n").over(Window.partitionBy(*RUN).orderBy("page").rowsBetween(Window.unboundedPreceding, -1))  # the pages of one run
    rows = pages.withColumn("_before", F.coalesce(before, F.lit(0))).select(*RUN, "_before", F.posexplode("_p.quotes").alias("_at", "_m"))
    rows = rows.withColumn("symbol", S.to_text(F.col("_m")["symbol"])).filter("symbol IS NOT NULL").withColumn("_rank", (F.col("_before") + F.col("_at")).cast("int"))
    per = rows.groupBy(*RUN, "symbol").agg(F.max("_rank").alias("rank_index"), F.min_by("_m", "_rank").alias("_m"))
    per = per.withColumn("is_known", F.coalesce(S.writable_symbol(F.col("symbol")), F.lit(False)))
    quotes = per.select(*RUN, "symbol", "is_known", F.to_date("fetched_at").alias("as_of_date"), *_typed(F.col("_m"), QUOTE))
    values = [f.target for f in QUOTE]
    newest = quotes.groupBy("symbol", "as_of_date").agg(F.max_by(F.struct("is_known", *values, "fetched_at"), F.struct("fetched_at", "screen_key")).alias("_r")).select("symbol", "as_of_date", "_r.*")
    found = pages.groupBy(*RUN).agg(F.min_by("_p.total", "page").alias("total"), F.count(F.lit(1)).alias("page_count"))
    runs = found.join(per.groupBy(*RUN).agg(F.count(F.lit(1)).alias("members")), RUN, "left").withColumn("members", F.coalesce("members", F.lit(0)))
    return {"screen_members": per.select(*RUN, "symbol", "rank_index", "is_known"), "screen_quotes": newest, "screen_runs": runs,
            "symbols": newest.filter("is_known").select("symbol", "short_name", "exchange", "quote_type")}


def taxonomy(raw: DataFrame) -> dict[str, DataFrame]:
    """domains and symbols of sectors: sector_key, fetched_at, payload (name, symbol, overview, and industries with a key, symbol and name each).

    A domain without a symbol or a name is left out; so is a row of industries without a key, which stands for all of them, and industries of a sector that is left out.
    Of an industry that several sectors name, the one of the first sector stays. The indices of domains are listed as inactive symbols.
    """
    kind = "struct<symbol:string,name:string,overview:struct<description:string,messageBoardId:string>,industries:array<struct<key:string,symbol:string,name:string>>>"
    rows = raw.select(F.col("sector_key"), "fetched_at", F.from_json("payload", kind).alias("p")).withColumns({"symbol": S.to_text(F.col("p.symbol"), 32), "name": S.to_text(F.col("p.name"), 64)}).filter("symbol IS NOT NULL AND name IS NOT NULL")
    sectors = rows.select(F.col("sector_key").alias("domain_key"), F.lit("sector").alias("domain_type"), "symbol", F.lit(None).cast("string").alias("parent_key"), "name",
                          S.to_text(F.col("p.overview.description")).alias("description"), S.to_text(F.col("p.overview.messageBoardId"), 32).alias("message_board_id"), "fetched_at")
    parts = rows.select("sector_key", "fetched_at", F.inline("p.industries"))
    parts = parts.select(S.key_text(F.col("key"), 48).alias("domain_key"), F.lit("industry").alias("domain_type"), S.to_text(F.col("symbol"), 32).alias("symbol"), F.col("sector_key").alias("parent_key"), S.to_text(F.col("name"), 64).alias("name"),
                         F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("message_board_id"), "fetched_at").filter("domain_key IS NOT NULL AND symbol IS NOT NULL AND name IS NOT NULL")
    others = [c for c in parts.columns if c != "domain_key"]
    first = parts.groupBy("domain_key").agg(F.min_by(F.struct(*others), "parent_key").alias("_r")).select("domain_key", "_r.*")
    domains = sectors.unionByName(first)
    listed = domains.select("symbol", F.substring("name", 1, 128).alias("short_name"), F.lit(LISTED_KIND).alias("quote_type"), F.lit(LISTED_AT).alias("exchange"), F.lit(False).alias("is_active"))
    return {"domains": domains, "symbols": listed.dropDuplicates(["symbol"])}
