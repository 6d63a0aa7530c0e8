"""Raw provider payloads to typed rows, driven by field lists.

Payloads are JSON text beside a symbol and the instant of their fetch. Shapes: a map (one row), a list
of records (frame), a series of dated values, a wide statement, and labelled rows. Bad values become null,
rows without their key are dropped, unknown keys are listed, and the body is kept as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.canonical import canonical_row


@dataclass(frozen=True)
class Field:
    source: str
    target: str
    kind: str


#: How a kind is made of a JSON value's text.
CONVERT = {
    "text": S.to_text,
    "price": lambda t: S.to_price(t.try_cast("double")),
    "fact": lambda t: S.to_fact(S.to_text(t).try_cast("decimal(38,18)")),
    "big": lambda t: S.to_big(S.to_text(t)),
    "count": lambda t: F.coalesce(S.to_long(t), S.whole(t.try_cast("double"))),
    "flag": S.to_flag,
    "date": lambda t: F.substring(t, 1, 10).try_cast("date"),
    "instant": lambda t: t.try_cast("timestamp"),
    "epoch": lambda t: F.timestamp_seconds(t.try_cast("bigint")),
    **{f"text{n}": lambda t, n=n: S.to_text(t, n) for n in (16, 32, 64, 128, 255)},
    "unsigned": lambda t: F.when(CONVERT["count"](t) >= 0, CONVERT["count"](t)),  # a negative one is dropped, not its row
    "epoch_s": lambda t: S.epoch_within(t.try_cast("double").try_cast("bigint"), "s"),
    "epoch_ms": lambda t: S.epoch_within(t.try_cast("double").try_cast("bigint"), "ms"),
    "number_or_instant": lambda t: S.epoch_or_instant(t),
}


def add_kind(name: str, convert: Callable[[Column], Column]) -> None:
    """Declares a kind of field: how it is made of a JSON value's text."""
    if name in CONVERT:
        raise ValueError(f"there is a kind {name}")
    CONVERT[name] = convert


def add_frame(dataset: str, key: str, fields: list[Field]) -> None:
    """Declares a dataset of records told apart by ``key``, one of the fields' targets; ``normalize`` then reads it."""
    if dataset in FRAMES:
        raise ValueError(f"there is a dataset {dataset}")
    unknown = sorted({f.kind for f in fields} - set(CONVERT))
    if unknown or key not in {f.target for f in fields}:
        raise ValueError(f"no such kind: {', '.join(unknown)}" if unknown else f"{key} is no field")
    FRAMES[dataset] = (key, list(fields))


def _fields(text: str) -> list[Field]:
    return [Field(*(p.strip() for p in line.split("|"))) for line in text.strip().splitlines()]


# Source key | column | kind, by dataset.
FRAMES = {
    "recommendations": ("period", _fields("""period | period | text
strongBuy | strong_buy | count
buy | buy | count
hold | hold | count
sell | sell | count
strongSell | strong_sell | count""")),
    "earnings_estimate": ("period", _fields("""index | period | text
avg | avg | price
low | low | price
high | high | price
growth | growth | price
numberOfAnalysts | number_of_analysts | count
yearAgoEps | year_ago_value | price""")),
    "growth_estimates": ("period", _fields("""index | period | text
stockTrend | stock_trend | price
indexTrend | index_trend | price""")),
    "earnings_history": ("quarter_end", _fields("""index | quarter_end | date
epsActual | eps_actual | price
epsEstimate | eps_estimate | price
epsDifference | eps_difference | price
surprisePercent | surprise_percent | price""")),
    "institutional_holders": ("holder", _fields("""Holder | holder | text
Date Reported | date_reported | date
Shares | shares | count
Value | value | count
pctHeld | pct_held | price
pctChange | pct_change | price""")),
    "revenue_estimate": ("period", _fields("""index | period | text
avg | avg | fact
low | low | fact
high | high | fact
growth | growth | price
numberOfAnalysts | number_of_analysts | count
yearAgoRevenue | year_ago_value | fact""")),
    "eps_trend": ("period", _fields("""index | period | text
current | current | fact
7daysAgo | days_ago_7 | fact
30daysAgo | days_ago_30 | fact
60daysAgo | days_ago_60 | fact
90daysAgo | days_ago_90 | fact
currency | currency | text""")),
    "eps_revisions": ("period", _fields("""index | period | text
upLast7days | up_last_7d | count
upLast30days | up_last_30d | count
downLast7Days | down_last_7d | count
downLast30days | down_last_30d | count
currency | currency | text""")),
    "upgrades_downgrades": ("grade_ts_utc", _fields("""index | grade_ts_utc | instant
Firm | firm | text
ToGrade | to_grade | text
FromGrade | from_grade | text
Action | action | text
priceTargetAction | price_target_action | text
currentPriceTarget | current_price_target | price
priorPriceTarget | prior_price_target | price""")),
    "mutualfund_holders": ("holder", _fields("""Holder | holder | text
Date Reported | date_reported | date
Shares | shares | count
Value | value | count
pctHeld | pct_held | price
pctChange | pct_change | price""")),
    "insider_roster_holders": ("name", _fields("""Name | name | text
Position | position | text
URL | url | text
Most Recent Transaction | most_recent_transaction | text
Latest Transaction Date | latest_transaction_date | date
Position Direct Date | position_direct_date | date
Position Indirect Date | position_indirect_date | date
Shares Owned Directly | shares_owned_directly | big
Shares Owned Indirectly | shares_owned_indirectly | big""")),
    "option_quotes": ("contract_symbol", _fields("""contractSymbol | contract_symbol | text
lastTradeDate | last_trade_ts_utc | instant
strike | strike | price
lastPrice | last_price | price
bid | bid | price
ask | ask | price
change | change | price
percentChange | percent_change | price
volume | volume | count
openInterest | open_interest | count
impliedVolatility | implied_volatility | price
inTheMoney | in_the_money | flag
contractSize | contract_size | text
currency | currency | text""")),
    "fund_top_holdings": ("holding_symbol", _fields("""Symbol | holding_symbol | text
Name | holding_name | text
Holding Percent | holding_percent | price""")),
    "sec_filings": ("title", _fields("""title | title | text
date | filing_date | date
type | filing_type | text
edgarUrl | url | text""")),
    "shares_full": ("as_of_date", _fields("""index | as_of_date | date
shares | shares | count""")),
    "earnings_calendar": ("event_ts_utc", _fields("""Event Start Date | event_ts_utc | instant
Company | company | text
Marketcap | market_cap | price
Event Name | event_name | text
Timing | timing | text
EPS Estimate | eps_estimate | price
Reported EPS | reported_eps | price
Surprise(%) | surprise_pct | price""")),
    "economic_events_calendar": ("event_ts_utc", _fields("""Event Time | event_ts_utc | instant
Region | region | text
For | period_for | text
Actual | actual | price
Expected | expected | price
Last | last_reported | price
Revised | revised | price""")),
    "ipo_calendar": ("action", _fields("""Date | event_ts_utc | instant
Action | action | text
Company | company | text
Exchange | exchange | text
Filing Date | filing_date | date
Amended Date | amended_date | date
Price From | price_from | price
Price To | price_to | price
Price | price | price
Currency | currency | text
Shares | shares | price""")),
    "splits_calendar": ("payable_ts_utc", _fields("""Payable On | payable_ts_utc | instant
Company | company | text
Old Share Worth | old_share_worth | count
Share Worth | share_worth | count
Optionable | optionable | flag""")),
    "bars": ("ts_utc", _fields("""index | ts_utc | instant
Open | open | price
High | high | price
Low | low | price
Close | close | price
Volume | volume | count""")),
}
MAPS = {
    "fast_info": _fields("""currency | currency | text
dayHigh | day_high | price
dayLow | day_low | price
exchange | exchange | text
fiftyDayAverage | fifty_day_average | price
lastPrice | last_price | price
lastVolume | last_volume | count
marketCap | market_cap | big
open | open | price
previousClose | previous_close | price
quoteType | quote_type | text
regularMarketPreviousClose | regular_market_previous_close | price
shares | shares | big
tenDayAverageVolume | ten_day_average_volume | count
threeMonthAverageVolume | three_month_average_volume | count
timezone | timezone | text
twoHundredDayAverage | two_hundred_day_average | price
yearChange | year_change | price
yearHigh | year_high | price
yearLow | year_low | price"""),
    "history_metadata": _fields("""currency | currency | text
exchangeName | exchange_name | text
fullExchangeName | full_exchange_name | text
instrumentType | instrument_type | text
timezone | timezone | text
exchangeTimezoneName | exchange_timezone_name | text
gmtoffset | gmt_offset | count
firstTradeDate | first_trade_date | instant
regularMarketTime | regular_market_time | instant
regularMarketPrice | regular_market_price | price
fiftyTwoWeekHigh | fifty_two_week_high | price
fiftyTwoWeekLow | fifty_two_week_low | price
priceHint | price_hint | count
dataGranularity | data_granularity | text
range | range | text
hasPrePostMarketData | has_pre_post_market_data | flag
shortName | short_name | text
longName | long_name | text
chartPreviousClose | chart_previous_close | price
regularMarketDayHigh | regular_market_day_high | price
regularMarketDayLow | regular_market_day_low | price
regularMarketVolume | regular_market_volume | count"""),
    "market_status": _fields("""id | market_id | text
name | name | text
status | status | text
yfit_market_status | yfit_market_status | text
message | message | text
open | open_ts_utc | instant
close | close_ts_utc | instant
tz | tz_short | text"""),
    "analyst_price_targets": _fields("""current | current | price
low | low | price
high | high | price
mean | mean | price
median | median | price"""),
}
# The day or instant, the columns whose hash tells records of it apart, and the fields.
HASHED = {
    "insider_transactions": ("start_date", ["insider", "position", "text", "shares", "value", "ownership"], _fields("""Start Date | start_date | date
Insider | insider | text
Position | position | text
URL | url | text
Transaction | transaction_label | text
Text | text | text
Shares | shares | big
Value | value | big
Ownership | ownership | text""")),
    "earnings_dates": ("earnings_ts_utc", ["eps_estimate", "reported_eps", "surprise_pct"], _fields("""index | earnings_ts_utc | instant
EPS Estimate | eps_estimate | price
Reported EPS | reported_eps | price
Surprise(%) | surprise_pct | price""")),
}
# Column by label of a labelled frame.
LABELS = {
    "major_holders": {"insidersPercentHeld": "insiders_percent_held", "institutionsPercentHeld": "institutions_percent_held",
                      "institutionsFloatPercentHeld": "institutions_float_percent_held", "institutionsCount": "institutions_count"},
}
# Columns of an insider summary by row label: shares and number of transactions, or a percentage.
INSIDER_SHARES = {"Purchases": ("purchases_shares", "purchases_trans"), "Sales": ("sales_shares", "sales_trans"),
                  "Net Shares Purchased (Sold)": ("net_shares", "net_trans"), "Total Insider Shares Held": ("total_insider_shares", None)}
INSIDER_PERCENTS = {"% Net Shares Purchased (Sold)": "net_pct", "% Buy Shares": "buy_pct", "% Sell Shares": "sell_pct"}
BASE = ["symbol", "fetched_at"]


def _typed(record: Column, fields: list[Field]) -> list[Column]:
    return [CONVERT[f.kind](record[f.source]).alias(f.target) for f in fields]


def map_rows(raw: DataFrame, fields: list[Field]) -> DataFrame:
    """One row per payload, with the body, its hash and the keys that no field names."""
    known = F.array(*[F.lit(f.source) for f in fields])
    out = raw.withColumn("_m", F.from_json("payload", "map<string,string>"))
    return out.select(*BASE, *_typed(F.col("_m"), fields), F.col("payload").alias("raw_json"), S.content_hash(F.col("payload")).alias("payload_hash"),
                      F.array_sort(F.array_except(F.map_keys("_m"), known)).alias("unmapped"))


def frame_rows(raw: DataFrame, key: str, fields: list[Field]) -> DataFrame:
    """A row per record; of records with one key the last stays; those without a key are dropped."""
    out = raw.select(*BASE, F.posexplode(F.from_json("payload", "array<map<string,string>>")).alias("_at", "_m"))
    out = out.select(*BASE, "_at", *_typed(F.col("_m"), fields)).filter(F.col(key).isNotNull())
    last = F.row_number().over(Window.partitionBy("symbol", "fetched_at", key).orderBy(F.desc("_at")))
    return out.withColumn("_n", last).filter("_n = 1").drop("_n", "_at")


def hashed_rows(raw: DataFrame, at: str, parts: list[str], fields: list[Field]) -> DataFrame:
    """A row per record that differs from the others of its day or instant, told apart by ``fact_hash``; those without it are dropped."""
    out = raw.select(*BASE, F.posexplode(F.from_json("payload", "array<map<string,string>>")).alias("_at", "_m"))
    out = out.select(*BASE, "_at", *_typed(F.col("_m"), fields)).filter(F.col(at).isNotNull()).withColumn("fact_hash", F.substring(S.content_hash(canonical_row(parts)), 1, 16))
    others = [f.target for f in fields if f.target != at]
    last = out.groupBy(*BASE, at, "fact_hash").agg(F.max_by(F.struct(*others), "_at").alias("_r"))
    return last.select(*BASE, at, "fact_hash", "_r.*")


def series_rows(raw: DataFrame, value: str) -> DataFrame:
    """(symbol, local day, value) of a dated series; zero isn't an event, and a day's last value stays."""
    out = raw.select(*BASE, F.posexplode(F.from_json("payload", "array<struct<index:string,value:double>>")).alias("_at", "_r"))
    out = out.select(*BASE, "_at", CONVERT["date"](F.col("_r.index")).alias("day"), S.to_price(F.col("_r.value")).alias(value)).filter(F.col("day").isNotNull() & (F.col(value) != 0))
    return out.groupBy(*BASE, "day").agg(F.max_by(value, "_at").alias(value))


def statement_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(periods, facts) of a statement whose columns are period ends; other columns and empty cells are dropped."""
    out = raw.select(*BASE, F.posexplode(F.from_json("payload", "array<map<string,string>>")).alias("_at", "_m"))
    out = out.select(*BASE, "_at", F.trim(F.col("_m")["index"]).alias("item_key"), F.explode("_m").alias("_column", "_value"))
    day = F.coalesce(F.substring("_column", 1, 10).try_cast("date"), F.try_to_date("_column", "M/d/yyyy"))
    facts = out.select(*BASE, "_at", day.alias("period_end"), "item_key", CONVERT["fact"](F.col("_value")).alias("value")).filter(
        F.col("period_end").isNotNull() & F.col("item_key").isNotNull() & F.col("value").isNotNull())
    facts = facts.groupBy(*BASE, "period_end", "item_key").agg(F.max_by("value", "_at").alias("value"))  # of records with one item the last stays
    return facts.groupBy(*BASE, "period_end").agg(F.count(F.lit(1)).cast("int").alias("item_count")), facts


def insider_summary(raw: DataFrame) -> DataFrame:
    """Labelled rows of shares and transactions to one row. The period stands in the header; without it no row is written."""
    out = raw.select(*BASE, S.period_of(F.get_json_object("payload", "$.header")).alias("period_label"),
                     F.from_json(F.get_json_object("payload", "$.rows"), "array<struct<label:string,Shares:string,Trans:string>>").alias("_r"))
    of = lambda label, c: F.get(F.filter("_r", lambda r: r["label"] == label), F.lit(0))[c]
    columns = []
    for label, (shares, trans) in INSIDER_SHARES.items():
        columns.append(CONVERT["big"](of(label, "Shares")).alias(shares))
        columns += [CONVERT["count"](of(label, "Trans")).alias(trans)] if trans else []
    columns += [CONVERT["price"](of(label, "Shares")).alias(c) for label, c in INSIDER_PERCENTS.items()]
    return out.filter("period_label IS NOT NULL").select(*BASE, F.substring("period_label", 1, 8).alias("period_label"), *columns)


def news_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(news, links): articles once by id, and a link for each ticker that one names, the payload's own symbol included."""
    one = raw.select("symbol", "fetched_at", F.explode(F.from_json("payload", "array<struct<id:string,title:string,pubDate:string,tickers:array<string>>>")).alias("_a")).filter("_a.id IS NOT NULL")
    news = one.groupBy(F.col("_a.id").alias("news_id")).agg(F.max_by(F.col("_a.title"), F.struct("fetched_at", "symbol")).alias("title"), F.max(CONVERT["instant"](F.col("_a.pubDate"))).alias("pub_date"))
    named = F.explode(F.array_distinct(F.concat(F.array("symbol"), F.coalesce(F.transform("_a.tickers", S.symbol), F.array().cast("array<string>")))))
    return news, one.select(F.col("_a.id").alias("news_id"), named.alias("symbol")).distinct()


def labelled_row(raw: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Key and value records to one row of known columns."""
    pairs = F.transform(F.from_json("payload", "array<struct<index:string,Value:double>>"), lambda r: F.struct(r["index"], r["Value"]))
    out = raw.withColumn("_m", F.map_from_entries(pairs))
    return out.select(*BASE, *[S.to_price(F.col("_m")[k]).alias(v) for k, v in labels.items()])


def normalize(dataset: str, raw: DataFrame) -> dict[str, DataFrame]:
    """Tables of a dataset from payloads (symbol, fetched_at, payload)."""
    raw = raw.withColumn("symbol", S.symbol(F.col("symbol")))
    if dataset in FRAMES:
        key, fields = FRAMES[dataset]
        out = frame_rows(raw, key, fields)
        return {dataset: out.filter("close IS NOT NULL") if dataset == "bars" else out}
    if dataset in HASHED:
        return {dataset: hashed_rows(raw, *HASHED[dataset])}
    if dataset in MAPS:
        return {dataset: map_rows(raw, MAPS[dataset])}
    if dataset in LABELS:
        return {dataset: labelled_row(raw, LABELS[dataset])}
    if dataset == "insider_purchases":
        return {dataset: insider_summary(raw)}
    if dataset == "news":
        news, links = news_rows(raw)
        return {"news": news, "news_symbols": links}
    if dataset in ("dividends", "splits", "capital_gains"):
        return {dataset: series_rows(raw, "ratio" if dataset == "splits" else "amount")}
    if dataset in ("income", "balance", "cashflow", "valuation_measures"):
        periods, facts = statement_rows(raw)
        return {"financial_periods": periods.withColumn("statement", F.lit(dataset)), "financial_facts": facts.withColumn("statement", F.lit(dataset))}
    raise ValueError(f"no such dataset: {dataset}")
