"""Each dataset's normalizer over payloads that are made of the order table, a payload a customer and a record an order.

Records come in the order of their keys, and several share one; every seventh has ``N/A`` where numbers should be.
Columns are compared as text, so that nulls and decimals are the same in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.normalize import FRAMES, HASHED, INSIDER_PERCENTS, INSIDER_SHARES, MAPS, normalize
from .registry import query, table

#: By kind: the value in a record, and what it is normalized to, both as SQL of the engine.
_SENT = {"text": "concat(' ', o_orderpriority, ' ')", "price": "cast(o_totalprice AS string)", "fact": "cast(o_totalprice AS string)", "big": "cast(o_orderkey AS string)", "count": "cast(o_orderkey AS string)",
         "flag": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END", "date": "date_format(o_orderdate, 'yyyy-MM-dd')", "instant": "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00Z')"}
_MEANT = {"text": "o_orderpriority", "price": "o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR", "fact": "o_totalprice::VARCHAR::DECIMAL(38,10)::VARCHAR", "big": "o_orderkey::VARCHAR", "count": "o_orderkey::VARCHAR",
          "flag": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END", "date": "o_orderdate::DATE::VARCHAR", "instant": "strftime(o_orderdate, '%Y-%m-%d 10:00:00')"}
_NUMBERS = ("price", "fact", "big", "count")


def _payloads(spark: SparkSession, d: str, record: dict[str, str]) -> DataFrame:
    """(symbol, fetched_at, payload): a customer's records as a JSON array. Orders of one customer are few."""
    o = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    body = F.to_json(F.struct(*[F.expr(sql).alias(name) for name, sql in record.items()]))
    one = o.select(F.concat(F.lit(" s"), F.col("o_custkey").cast("string")).alias("symbol"), F.struct("o_orderkey", body.alias("body")).alias("r"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["body"]), ",")
    return one.groupBy("symbol").agg(F.concat(F.lit("["), rows, F.lit("]")).alias("payload")).withColumn("fetched_at", F.lit("2024-02-01").cast("timestamp"))


def _text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select("symbol", *[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in columns])


def _frame_sql(key: str, fields: list) -> str:
    meant = {f.target: f"CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE {_MEANT[f.kind]} END" if f.kind in _NUMBERS else _MEANT[f.kind] for f in fields}
    values = ", ".join(f"arg_max({sql}, o_orderkey) AS {c}" for c, sql in meant.items() if c != key)
    return f"SELECT 'S' || o_custkey AS symbol, {meant[key]} AS {key}, {values} FROM orders GROUP BY 1, 2"


def _frame_query(name: str):
    key, fields = FRAMES[name]

    @query(f"ds_{name}", _frame_sql(key, fields) if name != "bars" else f"SELECT * FROM ({_frame_sql(key, fields)}) WHERE close <> 'null'")
    def run(spark, d):
        sent = {f.source: f"CASE WHEN o_orderkey % 7 = 0 THEN 'N/A' ELSE {_SENT[f.kind]} END" if f.kind in _NUMBERS else _SENT[f.kind] for f in fields}
        return _text(normalize(name, _payloads(spark, d, sent))[name], [f.target for f in fields])

    return run


for _name in FRAMES:
    _frame_query(_name)


def _hashed_query(name: str):
    at, parts, fields = HASHED[name]
    shown = [f for f in fields if f.target == at or f.target in parts]
    meant = ", ".join(f"CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE {_MEANT[f.kind]} END AS {f.target}" if f.kind in _NUMBERS else f"{_MEANT[f.kind]} AS {f.target}" for f in shown)

    @query(f"ds_{name}", f"SELECT DISTINCT 'S' || o_custkey AS symbol, {meant} FROM orders")
    def run(spark, d):
        """Records that differ in any part that is hashed are rows of their own; repeated ones are one row."""
        sent = {f.source: f"CASE WHEN o_orderkey % 7 = 0 THEN 'N/A' ELSE {_SENT[f.kind]} END" if f.kind in _NUMBERS else _SENT[f.kind] for f in fields}
        raw = _payloads(spark, d, sent)
        twice = raw.withColumn("payload", F.concat(F.lit("["), F.substr("payload", F.lit(2), F.length("payload") - 2), F.lit(","), F.substr("payload", F.lit(2))))
        return _text(normalize(name, twice)[name], [f.target for f in shown])

    return run


for _name in HASHED:
    _hashed_query(_name)


def _map_query(name: str):
    fields = MAPS[name]
    meant = ", ".join(f"CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE {_MEANT[f.kind]} END AS {f.target}" if f.kind in _NUMBERS else f"{_MEANT[f.kind]} AS {f.target}" for f in fields)

    @query(f"ds_{name}", f"SELECT 'S' || o_orderkey AS symbol, {meant}, 'odd' AS unmapped FROM orders")
    def run(spark, d):
        """One row a payload; a key that no field names is listed."""
        o = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
        sent = [F.expr(f"CASE WHEN o_orderkey % 7 = 0 THEN 'N/A' ELSE {_SENT[f.kind]} END" if f.kind in _NUMBERS else _SENT[f.kind]).alias(f.source) for f in fields]
        raw = o.select(F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("symbol"), F.lit("2024-02-01").cast("timestamp").alias("fetched_at"), F.to_json(F.struct(*sent, F.lit(1).alias("odd"))).alias("payload"))
        out = normalize(name, raw)[name]
        return _text(out.withColumn("unmapped", F.array_join("unmapped", ",")), [*[f.target for f in fields], "unmapped"])

    return run


for _name in ("fast_info", "history_metadata", "market_status"):
    _map_query(_name)


@query("ds_analyst_price_targets", """SELECT 'S' || o_orderkey AS symbol, CASE WHEN o_orderkey % 7 = 0 THEN 'null' ELSE o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR END AS mean, o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR AS high, 'odd' AS unmapped FROM orders""")
def price_targets(spark, d):
    """One row a payload; keys that no field names are listed."""
    body = F.to_json(F.struct(F.expr("CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE cast(o_totalprice AS string) END").alias("mean"), F.col("o_totalprice").alias("high"), F.lit(1).alias("odd")))
    raw = table(spark, d, "orders").select(F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("symbol"), F.current_timestamp().alias("fetched_at"), body.alias("payload"))
    out = normalize("analyst_price_targets", raw)["analyst_price_targets"]
    return _text(out.withColumn("unmapped", F.array_join("unmapped", ",")), ["mean", "high", "unmapped"])


@query("ds_major_holders", "SELECT 'S' || c_custkey AS symbol, (c_nationkey * 0.01::DOUBLE)::VARCHAR::DECIMAL(28,12)::VARCHAR AS insiders_percent_held, (c_custkey::DOUBLE)::VARCHAR::DECIMAL(28,12)::VARCHAR AS institutions_count FROM customer")
def major_holders(spark, d):
    pair = lambda k, v: F.struct(F.lit(k).alias("index"), v.cast("double").alias("Value"))
    body = F.to_json(F.array(pair("insidersPercentHeld", F.col("c_nationkey") * F.lit(0.01)), pair("other", F.lit(1)), pair("institutionsCount", F.col("c_custkey"))))
    raw = table(spark, d, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("symbol"), F.current_timestamp().alias("fetched_at"), body.alias("payload"))
    return _text(normalize("major_holders", raw)["major_holders"], ["insiders_percent_held", "institutions_count"])


@query("ds_insider_purchases", """
    SELECT 'S' || c_custkey AS symbol, (c_custkey % 12) || 'm' AS period_label, c_custkey::VARCHAR AS purchases_shares, (c_custkey % 50)::VARCHAR AS purchases_trans, 'null' AS sales_shares, (c_nationkey * 2)::VARCHAR AS total_insider_shares,
           '0.250000000000' AS buy_pct FROM customer WHERE c_custkey % 5 <> 0""")
def insider_purchases(spark, d):
    """Labels to columns; sales have no number here, unknown labels are passed over, and a header without a period gives no row."""
    rows = {"Purchases": (F.col("c_custkey").cast("string"), (F.col("c_custkey") % 50).cast("string")), "Sales": (F.lit("N/A"), F.lit("-")), "Odd": (F.lit("1"), F.lit("1")),
            "Total Insider Shares Held": ((F.col("c_nationkey") * 2).cast("string"), F.lit(None).cast("string")), "% Buy Shares": (F.lit("0.25"), F.lit(None).cast("string"))}
    listed = F.array(*[F.struct(F.lit(k).alias("label"), s.alias("Shares"), t.alias("Trans")) for k, (s, t) in rows.items()])
    header = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("Insider Purchases Last "), (F.col("c_custkey") % 12).cast("string"), F.lit("m"))).otherwise("Purchases")
    raw = table(spark, d, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("symbol"), F.current_timestamp().alias("fetched_at"), F.to_json(F.struct(header.alias("header"), listed.alias("rows"))).alias("payload"))
    wanted = ["period_label", "purchases_shares", "purchases_trans", "sales_shares", "total_insider_shares", "buy_pct"]
    assert {c for pair in INSIDER_SHARES.values() for c in pair} | set(INSIDER_PERCENTS.values()) >= set(wanted[1:])
    return _text(normalize("insider_purchases", raw)["insider_purchases"], wanted)


def _series_query(name: str, value: str):
    @query(f"ds_{name}", f"""SELECT 'S' || o_custkey AS symbol, o_orderdate::DATE::VARCHAR AS day, arg_max(o_totalprice::VARCHAR::DECIMAL(28,12)::VARCHAR, o_orderkey) AS {value} FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1, 2""")
    def run(spark, d):
        """Zero is no event, and of a day the last value stays."""
        sent = {"index": "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00-05:00')", "value": "CASE WHEN o_orderkey % 7 = 0 THEN 0.0D ELSE o_totalprice END"}
        return _text(normalize(name, _payloads(spark, d, sent))[name], ["day", value])

    return run


_series_query("dividends", "amount")
_series_query("splits", "ratio")
_series_query("capital_gains", "amount")


def _statement_query(name: str):
    @query(f"ds_{name}", """
        WITH r AS (SELECT 'S' || o_custkey AS symbol, o_orderpriority AS item_key, o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice::VARCHAR::DECIMAL(38,10)::VARCHAR END AS a, o_orderkey::DECIMAL(38,10)::VARCHAR AS b FROM orders)
        SELECT symbol, '2023-12-31' AS period_end, item_key, arg_max(a, o_orderkey) AS value FROM r WHERE a IS NOT NULL GROUP BY 1, 3 UNION ALL SELECT symbol, '2022-12-31', item_key, arg_max(b, o_orderkey) FROM r GROUP BY 1, 3""")
    def run(spark, d):
        """A wide statement to facts: columns that are no dates and empty cells are dropped, of an item's records the last counts."""
        sent = {"index": "o_orderpriority", "12/31/2023": "CASE WHEN o_orderkey % 7 > 0 THEN cast(o_totalprice AS string) ELSE 'N/A' END", "2022-12-31 00:00:00": "cast(o_orderkey AS string)", "Current": "'1'", "ttm": "'2'"}
        return _text(normalize(name, _payloads(spark, d, sent))["financial_facts"], ["period_end", "item_key", "value"])

    return run


for _name in ("income", "balance", "cashflow", "valuation_measures"):
    _statement_query(_name)


@query("ds_news", "SELECT 'N' || (o_orderkey % 300) AS news_id, 'S' || o_custkey AS symbol FROM orders UNION SELECT 'N' || (o_orderkey % 300), 'T' || (o_orderkey % 300 % 9) FROM orders")
def news(spark, d):
    """Articles name tickers; each is linked to those and to the symbol it was asked for, once."""
    sent = {"id": "concat('N', o_orderkey % 300)", "title": "o_orderpriority", "pubDate": "date_format(o_orderdate, 'yyyy-MM-dd')", "tickers": "array(concat('t', o_orderkey % 300 % 9), concat('s', o_custkey))"}
    return normalize("news", _payloads(spark, d, sent))["news_symbols"]
