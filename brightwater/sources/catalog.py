"""The catalogue of served datasets: one declaration each, one reader for all.

A reader takes a declaration, a table, a caller's filters and a key to go on from, and gives a
page. What a declaration doesn't name is refused, never ignored.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import symbol as as_symbol
from ..operators import keyset

MOST_ROWS = 1000

# Resource | table | family | sort key | direction | filters | fixed slice | symbol.
_DECLARED = """
earnings_history | earnings_history | fundamentals | quarter_end | desc | | | required
eps_trend | analyst_eps_trend | fundamentals | as_of_date, period | desc | | | required
eps_revisions | analyst_eps_revisions | fundamentals | as_of_date, period | desc | | | required
earnings_estimate | analyst_estimates | fundamentals | as_of_date, period | desc | | metric=eps | required
revenue_estimate | analyst_estimates | fundamentals | as_of_date, period | desc | | metric=revenue | required
upgrades_downgrades | analyst_grade_changes | fundamentals | grade_ts_utc, firm | desc | | | required
growth_estimates | analyst_growth_estimates | fundamentals | as_of_date, period | desc | | | required
analyst_price_targets | analyst_price_targets | fundamentals | as_of_date | desc | | | required
recommendations | analyst_recommendations | fundamentals | as_of_date, period | desc | | | required
lookup_results | lookup_results | discovery | as_of_date, query_term, symbol | desc | query_term | | optional
lookup_totals | lookup_totals | discovery | as_of_date, query_term, lookup_type | desc | query_term, lookup_type | | none
search_quotes | search_quotes | discovery | as_of_date, query_term, symbol | desc | query_term | | optional
search_lists | search_lists | discovery | as_of_date, query_term, list_key | desc | query_term | | none
search_report_hits | search_report_hits | discovery | as_of_date, query_term, report_id | desc | query_term | | none
domain_metrics | domain_metrics | domains | as_of_date, domain_key | desc | domain_key | | none
research_reports | research_reports | domains | as_of_date, report_id | desc | | | none
domain_report_links | domain_report_links | domains | as_of_date, domain_key, report_id | desc | domain_key | | none
domain_top_companies | domain_top_companies | domains | as_of_date, domain_key, region, symbol | desc | domain_key, region | | optional
domain_top_funds | domain_top_funds | domains | as_of_date, domain_key, region, fund_type, symbol | desc | domain_key, region, fund_type | | optional
domain_top_movers | domain_top_movers | domains | as_of_date, domain_key, region, rank_type, symbol | desc | domain_key, region, rank_type | | optional
domains | domains | domains | domain_key | asc | domain_type, parent_key | | none
fast_info | ticker_fast_info | reference | symbol | asc | | | required
fast_info_history | ticker_fast_info_history | reference | fetched_at | desc | | | required
ticker_calendar | ticker_calendar | fundamentals | symbol | asc | | | required
ticker_calendar_history | ticker_calendar_history | fundamentals | fetched_at | desc | | | required
earnings_dates | earnings_dates | fundamentals | earnings_ts_utc, fact_hash | desc | | | required
sec_filings | sec_filings | fundamentals | filing_date, filing_id | desc | filing_type | | required
sec_filing_exhibits | sec_filing_exhibits | fundamentals | filing_id, exhibit_type, url_hash | desc | exhibit_type | | required
fund_profile | fund_profile | holders | as_of_date | desc | | | required
fund_metrics | fund_metrics | holders | as_of_date, section, metric | desc | section | | required
fund_weightings | fund_weightings | holders | as_of_date, category, item_key | desc | category | | required
fund_top_holdings | fund_top_holdings | holders | as_of_date, holding_symbol | desc | | | required
history_metadata | history_metadata | reference | symbol | asc | | | required
major_holders | holder_breakdown | holders | as_of_date | desc | | | required
insider_purchases | insider_activity | holders | as_of_date | desc | | | required
insider_roster_holders | insider_roster | holders | as_of_date, name | desc | | | required
insider_transactions | insider_transactions | holders | start_date, fact_hash | desc | | | required
institutional_holders | institutional_holders | holders | as_of_date, holder | desc | | holder_type=institution | required
mutualfund_holders | institutional_holders | holders | as_of_date, holder | desc | | holder_type=mutualfund | required
company_officers | company_officers | reference | name | asc | | | required
info_history | ticker_info_history | reference | fetched_at | desc | | | required
earnings_calendar | calendar_earnings | fundamentals | event_start_ts_utc, symbol | desc | | | optional
economic_calendar | calendar_economic | fundamentals | event_time_utc, event_name | desc | region | | none
ipo_calendar | calendar_ipo | fundamentals | ipo_date_utc, symbol | desc | action | | optional
splits_calendar | calendar_splits | fundamentals | payable_on_utc, symbol | desc | | | optional
screens | screens | discovery | screen_key | asc | kind, quote_type | | none
screen_members | screen_members | discovery | as_of_date, screen_key, symbol | desc | screen_key | | optional
screen_quotes | screen_quotes | discovery | as_of_date, symbol | desc | | | required
screen_runs | screen_runs | discovery | as_of_date, screen_key | desc | screen_key | | none
market_status | market_status | reference | region | asc | | | none
market_status_history | market_status_history | reference | fetched_at, region | desc | region | | none
market_summary | market_summary | reference | region, board_code | asc | region | | optional
market_summary_history | market_summary_history | reference | fetched_at, region, board_code | desc | region | | none
news | news | news | pub_date, news_id | desc | | | none
news_symbols | news_symbols | news | news_id | desc | | | required
option_expirations | option_expirations | derivatives | as_of_date, expiry_date | desc | | | required
option_quotes | option_quotes | derivatives | as_of_date, expiry_date, contract_symbol | desc | expiry_date | | required
shares_full | shares_full | fundamentals | as_of_date, shares | desc | | | required
"""
# An interval's table.
BARS_TABLE = {**dict.fromkeys(["1m", "5m", "15m", "60m"], "price_bars"), "1d": "price_history", **dict.fromkeys(["1wk", "1mo"], "periodic_bars")}
# Days that a read may span, by class of interval.
WIDEST = {"intraday": 31, "daily": 3653, "periodic": 18262}


@dataclass(frozen=True)
class Exposure:
    resource: str
    table: str
    family: str
    keys: tuple[tuple[str, bool], ...]
    filters: tuple[str, ...]
    fixed: tuple[tuple[str, str], ...]
    symbol: str


def _parse(line: str) -> Exposure:
    name, table, family, keys, way, filters, fixed, symbol = (p.strip() for p in line.split("|"))
    listed = lambda x: tuple(p.strip() for p in x.split(",") if p.strip())
    return Exposure(name, table, family, tuple((k, way == "desc") for k in listed(keys)), listed(filters), tuple(tuple(p.split("=")) for p in listed(fixed)), symbol)


EXPOSURES = {e.resource: e for e in map(_parse, _DECLARED.strip().splitlines())}


def bars_table(interval: str) -> str:
    if interval not in BARS_TABLE:
        raise ValueError(f"no such interval: {interval}")
    return BARS_TABLE[interval]


def page_size(asked: int | None, default: int = 100) -> int:
    """Too many are refused, never clipped."""
    size = default if asked is None else asked
    if not 1 <= size <= MOST_ROWS:
        raise ValueError(f"a page has 1 to {MOST_ROWS} rows")
    return size


def window(kind: str, start: dt.date | None, end: dt.date | None, today: dt.date) -> tuple[dt.date, dt.date]:
    """Half-open; an open end is today or the widest span. Inverted or too wide windows are refused."""
    widest = dt.timedelta(days=WIDEST[kind])
    end = end or (min(start + widest, today + dt.timedelta(days=1)) if start else today + dt.timedelta(days=1))
    start = start or end - widest
    if start >= end:
        raise ValueError("the window ends before it starts")
    if end - start > widest:
        raise ValueError(f"a window spans {WIDEST[kind]} days at most")
    return start, end


def bars_table_of(interval: Column) -> Column:
    """The table that serves an interval; null where none does."""
    return F.create_map(*[F.lit(x) for pair in BARS_TABLE.items() for x in pair])[interval]


def page_size_of(asked: Column, default: int = 100) -> Column:
    """The rows of a page; null where what is asked for is refused."""
    return F.when(asked.isNull(), F.lit(default)).when(asked.between(1, MOST_ROWS), asked)


def widest_of(interval: Column) -> Column:
    """Days that a read of an interval may span."""
    kind = F.when(bars_table_of(interval) == "price_bars", "intraday").when(interval == "1d", "daily").otherwise("periodic")
    return F.create_map(*[F.lit(x) for pair in WIDEST.items() for x in pair])[kind]


def window_of(interval: Column, start: Column, end: Column, now: Column) -> Column:
    """low and high of a read, half-open: a bound that is missing is the widest span from the other, and without any the window ends now."""
    span = F.make_dt_interval(widest_of(interval))
    high = F.coalesce(end, start + span, now)
    return F.struct(F.coalesce(start, high - span).alias("low"), high.alias("high"))


def window_refusal(interval: Column, low: Column, high: Column) -> Column:
    """Why a window is refused: inverted or too_wide; null if it isn't."""
    return F.when(low >= high, "inverted").when(high > low + F.make_dt_interval(widest_of(interval)), "too_wide")


def refused(requests: DataFrame) -> DataFrame:
    """``requests`` (resource, symbol, filter; the last two may be null) with why one is refused, null if it isn't: what no declaration names is refused, never ignored."""
    spark = requests.sparkSession
    declared = spark.createDataFrame([(e.resource, e.symbol, list(e.filters)) for e in EXPOSURES.values()], "resource string, _symbol string, _filters array<string>")
    out = requests.join(F.broadcast(declared), "resource", "left")  # a row a declaration
    why = (F.when(F.col("_symbol").isNull(), "no such resource").when(F.col("filter").isNotNull() & ~F.array_contains("_filters", F.col("filter")), "no such filter")
           .when((F.col("_symbol") == "required") & F.col("symbol").isNull(), "needs a symbol").when((F.col("_symbol") == "none") & F.col("symbol").isNotNull(), "has no symbols"))
    return out.withColumn("refused", why).drop("_symbol", "_filters")


def read(exposure: Exposure, table: DataFrame, symbol: str | None = None, filters: dict | None = None, size: int | None = None,
         after: list | None = None, hidden: tuple[str, ...] = ("raw_json",)) -> DataFrame:
    """A page of a dataset, with one row more where another page follows. Filters reach the scan; the order is a top-k."""
    unknown = set(filters or {}) - set(exposure.filters)
    if unknown:
        raise ValueError(f"{exposure.resource} has no filter {', '.join(sorted(unknown))}")
    if exposure.symbol == "required" and not symbol:
        raise ValueError(f"{exposure.resource} needs a symbol")
    if exposure.symbol == "none" and symbol:
        raise ValueError(f"{exposure.resource} has no symbols")
    out = table
    for column, value in [*exposure.fixed, *(filters or {}).items()]:
        out = out.filter(F.col(column) == F.lit(value))
    if symbol:
        out = out.filter(F.col("symbol") == as_symbol(F.lit(symbol)))
    # A row's place within a symbol is told by the sort key; without one the symbol comes first.
    keys = list(exposure.keys)
    return keyset.page(out, keys, page_size(size), after).drop(*hidden)
