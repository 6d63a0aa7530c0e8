"""What searches find: quotes, lists of two shapes, reports and news of a term; lookups by type; and boards of a region.

A payload is one JSON text a term or region, and its records are few. Of records with one key the first stays, where normalizers of frames keep the last. A rank counts
the rows that are kept, from 0 and without holes, but for lookups, whose rank is the place in the answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .normalize import _fields, _typed

TERM = ["query_term", "fetched_at"]
_RECORDS = "array<map<string,string>>"
#: Longest key of a list, a report and a board that is taken.
LONGEST_LIST, LONGEST_REPORT, LONGEST_BOARD = 128, 64, 16

# Source key | column | kind.
QUOTE = _fields("""score | score | price
quoteType | quote_type | text32
exchange | exchange | text32
shortname | short_name | text128
longname | long_name | text255
sector | sector | text64
industry | industry | text128
isYahooFinance | is_listed | flag
prevName | prev_name | text255""")
LIST = _fields("""type | list_type | text32
score | score | price
iconUrl | icon_url | text
symbolCount | symbol_count | count
dailyPercentGain | daily_percent_gain | price
followerCount | follower_count | count
total | total | count
isPremium | is_premium | flag""")
REPORT = _fields("""provider | provider | text64
reportDate | report_ts_utc | epoch_ms
author | author | text128
reportHeadline | report_headline | text""")
NEWS = _fields("""title | title | text
type | content_type | text32
providerPublishTime | pub_date | epoch_s
publisher | provider_name | text128
link | click_through_url | text""")
DOCUMENT = _fields("""rank | source_rank | count
quoteType | quote_type | text32
exchange | exchange | text32
shortName | short_name | text128
industryName | industry_name | text128
regularMarketPrice | regular_market_price | price
regularMarketChange | regular_market_change | price""")
BOARD = _fields("""shortName | short_name | text64
quoteType | quote_type | text32
exchange | exchange | text32
marketState | market_state | text16
regularMarketPrice | regular_market_price | price
regularMarketChange | regular_market_change | price
regularMarketTime | regular_market_ts_utc | epoch_s
exchangeTimezoneName | exchange_timezone_name | text64""")


def _first_of(raw: DataFrame, records: str, key: Column, wanted: Column, name: str) -> DataFrame:
    """A row for each key of a payload's records, of those ``wanted``, with the first one's record, its place and its rank."""
    rows = raw.select(*TERM, F.posexplode(F.from_json(F.get_json_object("payload", f"$.{records}"), _RECORDS)).alias("_at", "_m")).withColumn(name, key)
    rows = rows.filter(F.col(name).isNotNull() & wanted)
    first = rows.groupBy(*TERM, name).agg(F.min_by("_m", "_at").alias("_m"), F.min("_at").alias("_at"))
    return first.withColumn("rank_index", F.row_number().over(Window.partitionBy(*TERM).orderBy("_at")) - 1)  # the records of one payload


def _discovered(rows: DataFrame) -> DataFrame:
    """Symbols that the universe can take up, each once, as its newest answer names it."""
    named = rows.filter("is_known").select("symbol", "fetched_at", "short_name", "exchange", "quote_type", "query_term")
    newest = named.groupBy("symbol").agg(F.max_by(F.struct("short_name", "exchange", "quote_type"), F.struct("fetched_at", "query_term")).alias("_r"))
    return newest.select("symbol", "_r.*")


def search(raw: DataFrame) -> dict[str, DataFrame]:
    """Tables of search answers: query_term, fetched_at, payload (an object of quotes, lists, researchReports and news).

    Quotes without a symbol (private companies) take no rank. A list is named by its slug or, of the other shape, by its canonical name. Reports and news are entities that
    terms share: each has one row, that of the newest answer. News without a title or a time is left out; it links to the tickers that it names.
    """
    m = F.col("_m")
    key = S.to_text(m["symbol"])
    quotes = _first_of(raw, "quotes", key, F.lit(True), "symbol").withColumn("is_known", F.coalesce(S.writable_symbol(F.col("symbol")), F.lit(False)))
    quotes = quotes.select(*TERM, "symbol", "rank_index", "is_known", *_typed(m, QUOTE))
    slug = F.coalesce(S.to_text(m["slug"]), S.to_text(m["canonicalName"]))
    lists = _first_of(raw, "lists", slug, F.length("list_key") <= LONGEST_LIST, "list_key").select(*TERM, "list_key", "rank_index", S.to_text(F.coalesce(m["name"], m["title"]), 255).alias("name"), *_typed(m, LIST))
    found = _first_of(raw, "researchReports", S.to_text(m["id"]), F.length("report_id") <= LONGEST_REPORT, "report_id")
    reports = found.select(*TERM, "report_id", *_typed(m, REPORT))
    items = _first_of(raw, "news", S.to_text(m["uuid"]), F.lit(True), "news_id").select(*TERM, "news_id", m["relatedTickers"].alias("_tickers"), *_typed(m, NEWS)).filter("title IS NOT NULL AND pub_date IS NOT NULL")
    tickers = items.select("news_id", F.explode(F.from_json("_tickers", "array<string>")).alias("symbol")).select("news_id", S.to_text(F.col("symbol")).alias("symbol"))
    return {"search_quotes": quotes, "search_lists": lists, "search_report_hits": found.select(*TERM, "report_id", "rank_index"), "research_reports": _newest(reports, "report_id"),
            "news": _newest(items.drop("_tickers"), "news_id"), "news_symbols": tickers.filter(S.writable_symbol(F.col("symbol"))).distinct(), "symbols": _discovered(quotes)}


def _newest(rows: DataFrame, key: str) -> DataFrame:
    others = [c for c in rows.columns if c not in (key, *TERM)]
    best = rows.groupBy(key).agg(F.max_by(F.struct("fetched_at", *others), F.struct("fetched_at", "query_term")).alias("_r"))
    return best.select(key, "_r.*")


def lookup(raw: DataFrame) -> dict[str, DataFrame]:
    """Tables of lookups: query_term, fetched_at, payload (documents, each with its lookup type, those of ``all`` first; and lookupTotals by type).

    A symbol that several calls gave is that of the first. A term that nothing is found of still has its totals.
    """
    m = F.col("_m")
    found = _first_of(raw, "documents", S.to_text(m["symbol"]), F.lit(True), "symbol")
    results = found.select(*TERM, "symbol", F.col("_at").alias("rank_index"), S.to_text(m["lookupType"], 32).alias("lookup_type"), F.coalesce(S.writable_symbol(F.col("symbol")), F.lit(False)).alias("is_known"), *_typed(m, DOCUMENT))
    totals = raw.select(*TERM, F.explode(F.from_json(F.get_json_object("payload", "$.lookupTotals"), "map<string,string>")).alias("lookup_type", "_n"))
    totals = totals.select(*TERM, "lookup_type", F.col("_n").try_cast("bigint").alias("total")).filter("total IS NOT NULL")
    return {"lookup_results": results, "lookup_totals": totals, "symbols": _discovered(results)}


def market_summary(raw: DataFrame, known: DataFrame) -> DataFrame:
    """A row for each board of a region: region, fetched_at, payload (an object of boards by code). known: symbol, each once.

    A payload of another shape (an overlong code, a board that is no object) is refused, as rows keyed by its parts would stay. Boards name symbols outside the universe too: ``is_known`` tells.
    """
    boards = raw.select("region", "fetched_at", F.explode(F.from_json("payload", "map<string,string>")).alias("board_code", "_text"))
    odd = (F.length("board_code") > LONGEST_BOARD) | F.col("_text").isNull() | ~F.col("_text").startswith("{")
    code = F.when(odd, F.raise_error(F.concat(F.lit("unexpected shape of a market summary: "), "board_code"))).otherwise(F.col("board_code"))
    rows = boards.withColumn("board_code", code).withColumn("_m", F.from_json("_text", "map<string,string>"))
    rows = rows.select("region", "board_code", S.symbol(F.col("_m")["symbol"]).alias("symbol"), *_typed(F.col("_m"), BOARD), "fetched_at")
    return rows.join(known.select("symbol", F.lit(True).alias("_k")), "symbol", "left").withColumn("is_known", F.col("_k").isNotNull()).drop("_k")
