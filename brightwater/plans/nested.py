"""Payloads with parts inside, made of the order table: a payload a customer and a part an order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import nested
from .datasets import _payloads
from .registry import query, table

_PRICE = "o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR"


def _inside(raw, name: str):
    """The records of a payload as one of its parts."""
    return raw.withColumn("payload", F.concat(F.lit(f'{{"{name}":'), F.col("payload"), F.lit("}")))


def _text(df, *columns: str):
    return df.select("symbol", *[F.col(c).cast("string").alias(c) for c in columns])


@query("ds_company_officers", f"""
    SELECT 'S' || o_custkey AS symbol, 'Ms ' || o_orderpriority AS name, (arg_min(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END, o_orderkey))::VARCHAR AS age, arg_min({_PRICE}, o_orderkey) AS total_pay FROM orders GROUP BY 1, 2""".replace("arg_min(CASE", "arg_min_null(CASE"))
def company_officers(spark, d):
    """Names are one whatever spaces they have; the first of a name stays, with what it lacks."""
    raw = _payloads(spark, d, {"name": "concat(' Ms   ', o_orderpriority, ' ')", "age": "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END", "totalPay": "o_totalprice"})
    return _text(nested.officers(_inside(raw, "companyOfficers")), "name", "age", "total_pay")


@query("ds_ticker_calendar", """
    SELECT 'S' || o_orderkey AS symbol, o_orderdate::DATE::VARCHAR AS dividend_date, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE::VARCHAR END AS earnings_date_start, CASE o_orderkey % 3 WHEN 0 THEN (o_orderdate::DATE + 4)::VARCHAR WHEN 1 THEN o_orderdate::DATE::VARCHAR END AS earnings_date_end,
           (CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END)::VARCHAR AS earnings_date_count, o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR AS revenue_high FROM orders""")
def ticker_calendar(spark, d):
    """Earnings dates come as two, as one that is no list, or not at all."""
    day = lambda n: F.date_format(F.date_add(F.to_date("o_orderdate"), n), "yyyy-MM-dd")
    k = F.col("o_orderkey") % 3
    dates = F.when(k == 0, F.concat(F.lit(',"Earnings Date":["'), day(0), F.lit('","'), day(4), F.lit('"]'))).when(k == 1, F.concat(F.lit(',"Earnings Date":"'), day(0), F.lit('"'))).otherwise("")
    body = F.concat(F.lit('{"Dividend Date":"'), day(0), F.lit('","Revenue High":'), F.col("o_totalprice").cast("string"), dates, F.lit("}"))
    raw = table(spark, d, "orders").select(F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("symbol"), F.current_timestamp().alias("fetched_at"), body.alias("payload"))
    return _text(nested.ticker_calendar(raw), "dividend_date", "earnings_date_start", "earnings_date_end", "earnings_date_count", "revenue_high")


_FILED = {"date": "date_format(o_orderdate, 'yyyy-MM-dd')", "epochDate": "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey END", "type": "o_orderpriority", "title": "concat('t', o_orderkey % 4)",
          "edgarUrl": "concat('https://x/', lpad(o_custkey, 10, '0'), '-24-', lpad(o_orderkey % 5, 6, '0'), '/')", "exhibits": "map('EX-1', concat('u', o_orderkey % 3), 'EX-2', 'same')"}
_FILING = "lpad(o_custkey::VARCHAR, 10, '0') || '-24-' || lpad((o_orderkey % 5)::VARCHAR, 6, '0')"


@query("ds_sec_filing_entities", f"SELECT 'S' || o_custkey AS symbol, {_FILING} AS filing_id, arg_max(o_orderpriority, o_orderkey) AS filing_type, arg_max('t' || (o_orderkey % 4), o_orderkey) AS title, '2' AS exhibit_count FROM orders WHERE o_orderkey % 11 <> 0 GROUP BY 1, 2")
def filings(spark, d):
    """A filing is named by the number in its address; of one that comes again the last stays, and one without an instant is left out."""
    return _text(nested.filings(_payloads(spark, d, _FILED))["sec_filings"], "filing_id", "filing_type", "title", "exhibit_count")


@query("ds_sec_filing_exhibits", f"""
    SELECT DISTINCT 'S' || o_custkey AS symbol, {_FILING} AS filing_id, kind AS exhibit_type, url, sha256(url)[1:16] AS url_hash FROM (SELECT *, unnest(['EX-1', 'EX-2']) AS kind, unnest(['u' || (o_orderkey % 3), 'same']) AS url FROM orders WHERE o_orderkey % 11 <> 0)""")
def exhibits(spark, d):
    """Exhibits of one type with other addresses are several, and repeated ones are one."""
    return _text(nested.filings(_payloads(spark, d, _FILED))["sec_filing_exhibits"], "filing_id", "exhibit_type", "url", "url_hash")


@query("ds_fund_weightings", """
    SELECT 'S' || c_custkey AS symbol, category, item_key, (CASE WHEN item_key = 'real_estate' THEN c_acctbal ELSE c_nationkey END)::DOUBLE::VARCHAR::DECIMAL(28,12)::VARCHAR AS weight
    FROM customer, (VALUES ('sector', 'real_estate'), ('sector', 'tech'), ('bond_rating', 'tech')) v(category, item_key) WHERE c_custkey % 3 <> 0 OR category = 'sector'""")
def fund_weightings(spark, d):
    """Two parts of a payload as rows by category; a part that is missing gives none, and neither does an item without a number."""
    c, n = F.col("c_acctbal").cast("string"), F.col("c_nationkey").cast("string")
    bonds = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit(',"bond_ratings":{"Tech":'), n, F.lit("}"))).otherwise("")
    body = F.concat(F.lit('{"sector_weightings":{"Real Estate":'), c, F.lit(',"tech":'), n, F.lit(',"none":null,"odd":"N/A"}'), bonds, F.lit("}"))
    raw = table(spark, d, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("symbol"), F.current_timestamp().alias("fetched_at"), body.alias("payload"))
    return _text(nested.fund_weightings(raw), "category", "item_key", "weight")


@query("ds_fund_metrics", """
    SELECT 'S' || o_custkey AS symbol, 'equity' AS section, lower(replace(replace(o_orderpriority, ' ', '_'), '-', '_')) AS metric, arg_max(o_totalprice::VARCHAR::DECIMAL(38,10)::VARCHAR, o_orderkey) AS value, arg_max(o_orderkey::DECIMAL(38,10)::VARCHAR, o_orderkey) AS category_average FROM orders GROUP BY 1, 3""")
def fund_metrics(spark, d):
    """Labelled rows with a fund's own value and its category's."""
    raw = _payloads(spark, d, {"label": "o_orderpriority", "own": "cast(o_totalprice AS string)", "category": "cast(o_orderkey AS string)"})
    return _text(nested.fund_metrics(_inside(raw, "equity_holdings")), "section", "metric", "value", "category_average")


@query("ds_option_expirations", "SELECT DISTINCT 'S' || o_custkey AS symbol, '2024-02-01' AS as_of_date, o_orderdate::DATE::VARCHAR AS expiry_date FROM orders WHERE o_orderkey % 7 <> 0")
def option_expirations(spark, d):
    """Every day that is offered, once; what is no day is left out."""
    raw = _payloads(spark, d, {"day": "CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"})
    days = F.to_json(F.transform(F.from_json("payload", "array<struct<day:string>>"), lambda r: r["day"]))
    return _text(nested.option_expirations(_inside(raw.withColumn("payload", days), "expirations")), "as_of_date", "expiry_date")
