"""Payloads with parts inside: officers, a ticker's own calendar, filings with exhibits, weightings and metrics of funds, option expiries.

raw: symbol, fetched_at, payload (JSON text). Of records of one key the last stays, unless said otherwise. Parts are rows of their own tables, and of what replaces a scope
the symbols that came are told even where they have no part any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .normalize import BASE, CONVERT, _fields, _typed

LONGEST_KEY = 64

# Source key | column | kind.
OFFICER = _fields("""title | title | text255
age | age | count
yearBorn | year_born | count
fiscalYear | fiscal_year | count
totalPay | total_pay | price
exercisedValue | exercised_value | price
unexercisedValue | unexercised_value | price""")
CALENDAR = _fields("""Dividend Date | dividend_date | date
Ex-Dividend Date | ex_dividend_date | date
Earnings High | earnings_high | price
Earnings Low | earnings_low | price
Earnings Average | earnings_average | price
Revenue High | revenue_high | price
Revenue Low | revenue_low | price
Revenue Average | revenue_average | price""")
# Part of a fund's payload and the category or section it makes.
WEIGHTINGS = {"sector_weightings": "sector", "bond_ratings": "bond_rating"}
METRICS = {"equity_holdings": "equity", "bond_holdings": "bond"}


def _parsed(raw: DataFrame) -> DataFrame:
    return raw.withColumn("symbol", S.symbol(F.col("symbol")))


def _part(path: str, kind: str) -> Column:
    return F.from_json(F.get_json_object("payload", f"$['{path}']"), kind)


def officers(raw: DataFrame) -> DataFrame:
    """company_officers: a row a person, whose name has single spaces; of two rows of one name the first stays."""
    rows = _parsed(raw).select(*BASE, F.posexplode(_part("companyOfficers", "array<map<string,string>>")).alias("_at", "_m"))
    rows = rows.withColumn("name", S.person_name(S.to_text(F.col("_m")["name"], 255))).filter("name IS NOT NULL")
    first = rows.groupBy(*BASE, "name").agg(F.min_by("_m", "_at").alias("_m"))
    return first.select(*BASE, "name", *_typed(F.col("_m"), OFFICER))


def ticker_calendar(raw: DataFrame) -> DataFrame:
    """ticker_calendar: one row a payload. Earnings come as a list of dates or as one: first, last and how many."""
    m, text = F.from_json("payload", "map<string,string>"), F.col("_m")["Earnings Date"]
    rows = _parsed(raw).select(*BASE, m.alias("_m"))
    listed = F.when(text.startswith("["), F.from_json(text, "array<string>")).when(text.isNotNull(), F.array(text)).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("_dates", listed)
    day = lambda at: CONVERT["date"](F.try_element_at("_dates", F.lit(at)))
    return rows.select(*BASE, *_typed(F.col("_m"), CALENDAR), day(1).alias("earnings_date_start"), day(-1).alias("earnings_date_end"), F.size("_dates").alias("earnings_date_count"))


def filings(raw: DataFrame) -> dict[str, DataFrame]:
    """sec_filings and sec_filing_exhibits; filings without day, instant or type are left out with their exhibits. An exhibit is told apart by its type and a hash of its address."""
    kind = "array<struct<date:string,epochDate:string,type:string,title:string,edgarUrl:string,exhibits:string>>"
    rows = _parsed(raw).select(*BASE, F.posexplode(F.from_json("payload", kind)).alias("_at", "_r")).select(*BASE, "_at", "_r.*")
    rows = rows.select(*BASE, "_at", CONVERT["date"](F.col("date")).alias("filing_date"), CONVERT["epoch_s"](F.col("epochDate")).alias("filed_ts_utc"), S.to_text(F.col("type"), 32).alias("filing_type"),
                       S.to_text(F.col("title")).alias("title"), S.to_text(F.col("edgarUrl")).alias("edgar_url"), F.from_json("exhibits", "map<string,string>").alias("_x"))
    rows = rows.filter("filing_date IS NOT NULL AND filed_ts_utc IS NOT NULL AND filing_type IS NOT NULL")
    rows = rows.withColumn("filing_id", S.accession(F.coalesce("edgar_url", F.lit("")), F.col("filing_date"), F.col("filing_type"), F.coalesce("title", F.lit(""))))
    last = ["filing_date", "filed_ts_utc", "filing_type", "title", "edgar_url", "exhibit_count"]
    one = rows.withColumn("exhibit_count", F.coalesce(F.size("_x"), F.lit(0))).groupBy(*BASE, "filing_id").agg(F.max_by(F.struct(*last), "_at").alias("_l"))
    exhibits = rows.select(*BASE, "filing_id", F.explode("_x").alias("_t", "_u")).select("symbol", "filing_id", S.key_text(F.col("_t"), 32).alias("exhibit_type"), S.to_text(F.col("_u")).alias("url"))
    exhibits = exhibits.filter("exhibit_type IS NOT NULL AND url IS NOT NULL").withColumn("url_hash", F.substring(S.content_hash(F.col("url")), 1, 16)).distinct()
    return {"sec_filings": one.select(*BASE, "filing_id", "_l.*"), "sec_filing_exhibits": exhibits}


def fund_weightings(raw: DataFrame) -> DataFrame:
    """fund_weightings: category, item_key, weight of each part; items without a weight, or with an overlong key, are left out."""
    parts = F.map_from_arrays(F.array(*map(F.lit, WEIGHTINGS.values())), F.array(*[_part(p, "map<string,string>") for p in WEIGHTINGS]))
    rows = _parsed(raw).select(*BASE, F.explode(parts).alias("category", "_items")).select(*BASE, "category", F.explode("_items").alias("_k", "_w"))
    rows = rows.select(*BASE, "category", S.key_text(S.slug(F.col("_k")), LONGEST_KEY).alias("item_key"), CONVERT["price"](F.col("_w")).alias("weight"))
    return rows.filter("item_key IS NOT NULL AND weight IS NOT NULL").groupBy(*BASE, "category", "item_key").agg(F.max("weight").alias("weight"))


def fund_metrics(raw: DataFrame) -> DataFrame:
    """fund_metrics: section, metric, value, category_average. A part is a list of records (label, own, category); one metric may stand in both sections."""
    kind = "array<struct<label:string,own:string,category:string>>"
    parts = F.map_from_arrays(F.array(*map(F.lit, METRICS.values())), F.array(*[_part(p, kind) for p in METRICS]))
    rows = _parsed(raw).select(*BASE, F.explode(parts).alias("section", "_items")).select(*BASE, "section", F.posexplode("_items").alias("_at", "_r"))
    rows = rows.withColumn("metric", S.key_text(S.slug(F.col("_r.label")), LONGEST_KEY)).filter("metric IS NOT NULL")
    last = rows.groupBy(*BASE, "section", "metric").agg(F.max_by("_r", "_at").alias("_r"))
    return last.select(*BASE, "section", "metric", CONVERT["fact"](F.col("_r.own")).alias("value"), CONVERT["fact"](F.col("_r.category")).alias("category_average"))


def option_expirations(raw: DataFrame) -> DataFrame:
    """option_expirations: a row for each day that a symbol offers, all of them, whether or not its chain was asked for."""
    days = _parsed(raw).select(*BASE, F.explode(_part("expirations", "array<string>")).alias("_d"))
    return days.select(*BASE, F.to_date("fetched_at").alias("as_of_date"), CONVERT["date"](F.col("_d")).alias("expiry_date")).filter("expiry_date IS NOT NULL").distinct()
