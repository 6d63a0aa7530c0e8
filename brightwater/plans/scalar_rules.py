"""Scalar rules of the data model, each over a table with nulls, sentinels and values out of range mixed in.

``_SPOILED`` spoils a column by key, the same way in the query and in its SQL, so every rule meets what it is for.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.canonical import canonical_row, canonical_text
from .registry import query, table

#: What replaces a price's text, by the key's remainder by 12.
_SPOILED = {1: None, 2: "-", 3: "", 4: " N/A ", 5: "null", 6: "1e400", 7: "yes", 8: "0", 9: "NaN", 10: "-7"}
_SQL_TEXT = "SELECT *, CASE o_orderkey % 12 " + " ".join(f"WHEN {k} THEN {'NULL' if v is None else repr(v)}" for k, v in _SPOILED.items()) + " ELSE ' ' || o_orderpriority || ' ' END AS t FROM orders"
_MISSING = "(t IS NULL OR trim(t) IN ('-', '', 'N/A', 'n/a', 'None', 'null'))"


def _dirty(spark, d):
    o = table(spark, d, "orders")
    t = F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))
    for k, v in _SPOILED.items():
        t = F.when(F.col("o_orderkey") % 12 == k, F.lit(v)).otherwise(t)
    return o.withColumn("t", t)


@query("scl_02_is_missing", f"SELECT o_orderkey, {_MISSING} AS missing FROM ({_SQL_TEXT})")
def missing(spark, d):
    return _dirty(spark, d).select("o_orderkey", S.is_missing(F.col("t")).alias("missing"))


@query("scl_03_to_str", f"SELECT o_orderkey, CASE WHEN NOT {_MISSING} THEN trim(t)[1:6] END AS text FROM ({_SQL_TEXT})")
def to_str(spark, d):
    return _dirty(spark, d).select("o_orderkey", S.to_text(F.col("t"), 6).alias("text"))


@query("scl_05_to_bool", f"""
    SELECT o_orderkey, CASE WHEN lower(trim(t)) IN ('true', 'yes', '1') THEN true WHEN lower(trim(t)) IN ('false', 'no', '0') THEN false END AS flag,
           CASE o_orderkey % 4 WHEN 0 THEN false WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE true END AS of_number FROM ({_SQL_TEXT})""")
def to_bool(spark, d):
    """Words by their list; a number is true unless it is 0, and NaN and null have no truth value."""
    k = F.col("o_orderkey") % 4
    number = F.when(k == 0, F.lit(0.0)).when(k == 1, F.lit(float("nan"))).when(k == 3, -F.col("o_totalprice"))
    return _dirty(spark, d).select("o_orderkey", S.to_flag(F.col("t")).alias("flag"), S.number_flag(number).alias("of_number"))


@query("scl_07_to_datetime_utc", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 2 HOUR WHEN 2 THEN date_trunc('day', ts) END::TIMESTAMP AS at FROM events""")
def to_datetime_utc(spark, d):
    """A zone is applied, a naive instant is UTC, a date is its midnight, other text is null."""
    e, stamp = table(spark, d, "events"), F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    t = F.when(F.col("event_id") % 4 == 0, stamp).when(F.col("event_id") % 4 == 1, F.concat(stamp, F.lit("+02:00"))).when(F.col("event_id") % 4 == 2, F.substring(stamp, 1, 10)).otherwise("soon")
    return e.select("event_id", S.instant(t).cast("timestamp_ntz").alias("at"))


@query("scl_08_to_local_date", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN ts::DATE END::VARCHAR AS day FROM events")
def to_local_date(spark, d):
    """The wall-clock day of a text, whatever zone it names."""
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    t = F.when(F.col("event_id") % 3 == 0, F.concat(stamp, F.lit("-11:00"))).when(F.col("event_id") % 3 == 1, F.substring(stamp, 1, 10)).otherwise("2024-99-99")
    return table(spark, d, "events").select("event_id", S.day_of_text(t).cast("string").alias("day"))


@query("scl_09_epoch", """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END::TIMESTAMP AS s, CASE WHEN event_id % 5 <> 0 THEN date_trunc('millisecond', ts) END::TIMESTAMP AS ms FROM events""")
def epoch(spark, d):
    """Seconds and milliseconds; what lies outside 1970 to 2100 is null."""
    at, far = F.col("ts").cast("timestamp"), F.col("event_id") % 5 == 0
    s, ms = F.when(far, F.lit(99_999_999_999)).otherwise(F.unix_timestamp(at)), F.when(far, F.lit(-1)).otherwise(F.unix_millis(at))
    return table(spark, d, "events").select("event_id", S.epoch_within(s, "s").cast("timestamp_ntz").alias("s"), S.epoch_within(ms, "ms").cast("timestamp_ntz").alias("ms"))


@query("scl_10_canonical_json", """SELECT c_custkey, '{"a":' || (c_custkey / 1e9)::DOUBLE::VARCHAR || ',"b":' || CASE WHEN c_nationkey = 3 THEN 'null' ELSE '"' || c_mktsegment || '"' END || ',"c":{"k":null,"n":' || c_nationkey || ',"z":[' || (c_custkey * 1e15)::DOUBLE::VARCHAR || ',null]}}' AS body FROM customer""")
def canonical_json(spark, d):
    """Keys in order at every level, compact, nulls kept, numbers as short as they go, no NaN, whatever order the columns have."""
    nan = F.lit(float("nan"))
    inner = F.struct(F.array(F.col("c_custkey") * 1e15, F.lit(float("inf"))).alias("z"), F.col("c_nationkey").alias("n"), nan.alias("k"))
    row = table(spark, d, "customer").select("c_custkey", inner.alias("c"), F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment")).alias("b"), (F.col("c_custkey") / 1e9).alias("a"))
    return row.select("c_custkey", canonical_row(["c", "b", "a"]).alias("body"))


@query("scl_10_canonical_bodies", """SELECT event_id, sha256('{"id":' || event_id || ',"nested":{"a":{"x":1e-07,"y":[1,2.5,"é"]},"b":null,"value":' || value::VARCHAR || '},"props":' || replace(props, ' ', '') || '}') AS payload_hash FROM events""")
def canonical_bodies(spark, d):
    """Bodies of JSON text whose keys come in another order at two levels, and with spaces, hash as the canonical text does."""
    body = F.concat(F.lit('{ "props": '), F.col("props"), F.lit(', "nested" : {"value":'), F.col("value").cast("string"), F.lit(', "b": NaN, "a": {"y": [1, 2.50, "é"], "x": 0.0000001}}, "id": '), F.col("event_id").cast("string"), F.lit("}"))
    return table(spark, d, "events").select("event_id", S.content_hash(canonical_text(body)).alias("payload_hash"))


@query("scl_13_person_name", "SELECT c_custkey, 'Ms ' || c_mktsegment || ' ' || c_nationkey AS name FROM customer")
def person_name(spark, d):
    raw = F.concat(F.lit("  Ms \t "), "c_mktsegment", F.lit("\n  "), F.col("c_nationkey").cast("string"), F.lit(" "))
    return table(spark, d, "customer").select("c_custkey", S.person_name(raw).alias("name"))


@query("scl_16_facts", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 12 IN (0, 11) THEN ((o_orderkey::HUGEINT // 2 + CASE WHEN o_orderkey % 2 = 1 AND (o_orderkey // 2) % 2 = 1 THEN 1 ELSE 0 END)::DECIMAL(38,0))::VARCHAR END AS big,
           CASE WHEN o_orderkey % 12 IN (0, 11) THEN (o_orderkey::DECIMAL(20,10) / 1)::DECIMAL(20,10)::VARCHAR WHEN o_orderkey % 12 = 8 THEN '0.0000000000' WHEN o_orderkey % 12 = 10 THEN '-7.0000000000' END AS fact FROM ({_SQL_TEXT})""")
def facts(spark, d):
    """Half to even at ten places and at none; sentinels, words and what overflows are null."""
    real = (F.col("o_orderkey") % 12).isin(0, 11)
    half = F.when(real, F.concat((F.col("o_orderkey") / 2).cast("decimal(20,1)").cast("string")))
    whole = F.when(real, F.col("o_orderkey").cast("string")).otherwise(F.when(F.col("o_orderkey") % 12 != 6, F.col("t")))
    return _dirty(spark, d).select("o_orderkey", S.to_big(S.to_text(half)).cast("string").alias("big"), S.to_fact(S.to_text(whole)).cast("string").alias("fact"))


_WIDTHS = (16, 32, 64, 128, 255)


@query("scl_18_kinds", f"""
    WITH x AS (SELECT *, CASE WHEN NOT {_MISSING} THEN trim(t) END AS v, epoch(o_orderdate)::BIGINT AS s, CASE WHEN o_orderkey % 12 = 8 THEN 0 WHEN o_orderkey % 12 = 10 THEN -7 END AS n FROM ({_SQL_TEXT}))
    SELECT o_orderkey, v AS text, {", ".join(f"repeat(v, 40)[1:{n}] AS text{n}" for n in _WIDTHS)}, n::VARCHAR AS count, CASE WHEN n >= 0 THEN n END::VARCHAR AS unsigned,
           CASE WHEN o_orderkey % 12 = 7 THEN true WHEN o_orderkey % 12 = 8 THEN false END::VARCHAR AS flag, o_orderdate::DATE::VARCHAR AS date,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS epoch_s, strftime(o_orderdate + INTERVAL 7 MILLISECOND, '%Y-%m-%d %H:%M:%S.%g') AS epoch_ms, strftime(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate ELSE o_orderdate::DATE END, '%Y-%m-%d %H:%M:%S') AS number_or_instant FROM x""")
def kinds(spark, d):
    """The converters of the kinds table, over text that holds what spoils it."""
    from ..sources.normalize import CONVERT

    at = F.col("o_orderdate").cast("timestamp")
    day, s = F.date_format(at, "yyyy-MM-dd'T'00:00:00"), F.unix_timestamp(at)
    often = F.when(S.to_text(F.col("t")).isNotNull(), F.repeat(S.to_text(F.col("t")), 40))
    shown = lambda c, form="yyyy-MM-dd HH:mm:ss": F.date_format(c, form)
    either = F.when(F.col("o_orderkey") % 2 == 0, s.cast("string")).otherwise(F.date_format(at, "yyyy-MM-dd"))
    return _dirty(spark, d).select("o_orderkey", *[CONVERT[k](F.col("t")).cast("string").alias(k) for k in ("text", "count", "unsigned", "flag")], CONVERT["date"](day).cast("string").alias("date"),
                                   *[CONVERT[f"text{n}"](often).alias(f"text{n}") for n in _WIDTHS], shown(CONVERT["epoch_s"](s.cast("string"))).alias("epoch_s"),
                                   shown(CONVERT["epoch_ms"]((s * 1000 + 7).cast("string")), "yyyy-MM-dd HH:mm:ss.SSS").alias("epoch_ms"), shown(CONVERT["number_or_instant"](either)).alias("number_or_instant"))


@query("scl_19_number_or_text_instant", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN ts::DATE::TIMESTAMP END::TIMESTAMP AS at FROM events")
def number_or_text_instant(spark, d):
    """A number is seconds of the epoch, anything else is parsed."""
    t = F.when(F.col("event_id") % 3 == 0, F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")).when(F.col("event_id") % 3 == 1, F.col("ts").cast("date").cast("string")).otherwise("n/a")
    return table(spark, d, "events").select("event_id", S.epoch_or_instant(t).cast("timestamp_ntz").alias("at"))


@query("scl_20_f32_decimal", "SELECT l_orderkey, l_linenumber, l_tax::FLOAT::VARCHAR::DECIMAL(28,12)::VARCHAR AS price FROM lineitem")
def f32_decimal(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.float_price(F.col("l_tax")).cast("string").alias("price"))


@query("scl_21_enum_names", """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 0 THEN 'pre' WHEN 1 THEN 'regular' WHEN 2 THEN 'post' WHEN 3 THEN 'extended' END AS session,
    l_linenumber <> 1 AS is_extended FROM lineitem""")
def enum_names(spark, d):
    """Codes to names by a constant map; unknown codes are null. All sessions but the regular one are extended."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.named(F.col("l_linenumber"), S.MARKET_HOURS).alias("session"), S.is_extended_session(F.col("l_linenumber")).alias("is_extended"))


@query("scl_22_extended_session", "SELECT event_type, count(*) FILTER (event_id % 4 <> 1) AS extended, count(*) AS n FROM events GROUP BY 1")
def extended_session(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(S.is_extended_session(F.col("event_id") % 4)).alias("extended"), F.count(F.lit(1)).alias("n"))


@query("scl_23_unwrap", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN value::VARCHAR WHEN 1 THEN 'plain' END AS v FROM events")
def unwrap(spark, d):
    """{"raw": x, "fmt": y} gives x, an empty envelope null, and anything else itself."""
    v = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"raw": '), F.col("value").cast("string"), F.lit(', "fmt": "x"}'))).when(F.col("event_id") % 3 == 1, "plain").otherwise("{}")
    return table(spark, d, "events").select("event_id", S.unwrap(v).alias("v"))


@query("scl_25_accession", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN lpad(o_orderkey::VARCHAR, 10, '0') || '-24-' || lpad(o_custkey::VARCHAR, 6, '0')
           ELSE sha256(o_orderdate::DATE::VARCHAR || '|' || o_orderstatus || '|' || o_orderpriority)[1:32] END AS accession FROM orders""")
def accession(spark, d):
    """The number in a filing's address; without one a hash of date, type and title."""
    number = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-24-"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
    url = F.concat(F.lit("https://example.org/data/"), F.when(F.col("o_orderkey") % 2 == 0, number).otherwise("none"), F.lit("/index.htm"))
    return table(spark, d, "orders").select("o_orderkey", S.accession(url, F.col("o_orderdate").cast("date"), F.col("o_orderstatus"), F.col("o_orderpriority")).alias("accession"))


@query("scl_26_split_ratio", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber - 1 > 0 AND l_quantity > 0 THEN l_quantity / (l_linenumber - 1) END AS ratio FROM lineitem")
def split_ratio(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.split_ratio(F.col("l_quantity"), (F.col("l_linenumber") - 1).cast("double")).alias("ratio"))


@query("scl_27_period_label", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN (o_orderkey % 12) || 'm' END AS period FROM orders")
def period_label(spark, d):
    label = F.when(F.col("o_orderkey") % 3 < 2, F.concat(F.lit("Insider Purchases Last "), (F.col("o_orderkey") % 12).cast("string"), F.lit("m"))).otherwise("Purchases")
    return table(spark, d, "orders").select("o_orderkey", S.period_of(label).alias("period"))


@query("scl_28_thumbnails", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'o' || event_id WHEN 1 THEN 's' || event_id END AS thumbnail, CASE event_id % 4 WHEN 2 THEN 'u' || event_id WHEN 3 THEN 'plain' || event_id END AS url FROM events""")
def thumbnails(spark, d):
    """The picture tagged original, else the first; an address from an object or from text."""
    k, n = F.col("event_id") % 4, F.col("event_id").cast("string")
    small = F.concat(F.lit('{"tag":"small","url":"s'), n, F.lit('"}'))
    pictures = F.when(k == 0, F.concat(F.lit("["), small, F.lit(',{"tag":"original","url":"o'), n, F.lit('"}]'))).when(k == 1, F.concat(F.lit("["), small, F.lit("]"))).otherwise("[]")
    url = F.when(k == 2, F.concat(F.lit('{"url":"u'), n, F.lit('"}'))).when(k == 3, F.concat(F.lit("plain"), n))
    return table(spark, d, "events").select("event_id", S.thumbnail(pictures).alias("thumbnail"), S.url_of(url).alias("url"))


@query("scl_29_urls", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'https://x/' || o_orderkey WHEN 1 THEN 'https://y/' || o_orderkey END AS url FROM orders")
def urls(spark, d):
    k, n = F.col("o_orderkey") % 3, F.col("o_orderkey").cast("string")
    v = F.when(k == 0, F.concat(F.lit('{"url": "https://x/'), n, F.lit('"}'))).when(k == 1, F.concat(F.lit("https://y/"), n)).otherwise("{}")
    return table(spark, d, "orders").select("o_orderkey", S.url_of(v).alias("url"))


@query("scl_30_rescale_factors", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 1 THEN round(1 / ((l_linenumber - 1) / 4.0::DOUBLE), 9) END AS price_factor,
    CASE WHEN l_linenumber > 1 THEN (l_linenumber - 1) / 4.0::DOUBLE END AS volume_factor FROM lineitem""")
def rescale_factors(spark, d):
    """1 / ratio for prices and ratio for volumes, as decimals; a ratio of 0 or less has none."""
    price, volume = S.rescale_factors(((F.col("l_linenumber") - 1) / 4).cast("decimal(20,10)"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(price.cast("double"), 9).alias("price_factor"), volume.cast("double").alias("volume_factor"))


_ZONES = "CASE o_orderkey % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Asia/Tokyo' ELSE 'Europe/Berlin' END"


def _zone():
    return F.when(F.col("o_orderkey") % 3 == 0, "America/New_York").when(F.col("o_orderkey") % 3 == 1, "Asia/Tokyo").otherwise("Europe/Berlin")


@query("scl_31_split_boundary", f"SELECT o_orderkey, ((o_orderdate AT TIME ZONE {_ZONES}) AT TIME ZONE 'UTC')::TIMESTAMP AS boundary FROM orders")
def split_boundary(spark, d):
    """The instant of a day's midnight at its exchange."""
    return table(spark, d, "orders").select("o_orderkey", S.midnight(F.col("o_orderdate").cast("date"), _zone()).cast("timestamp_ntz").alias("boundary"))


@query("scl_33_local_bound", """
    WITH z AS (SELECT o_orderkey, o_orderdate::DATE AS day, CASE o_orderkey % 3 WHEN 0 THEN 'America/Sao_Paulo' WHEN 1 THEN 'Asia/Tokyo' END AS zone FROM orders)
    SELECT o_orderkey, CASE WHEN zone IS NULL THEN day::VARCHAR ELSE ((day::TIMESTAMP AT TIME ZONE zone) AT TIME ZONE 'UTC')::VARCHAR END AS bound FROM z""")
def local_bound(spark, d):
    """A day's bound on its exchange's clock; a midnight that a clock change skips moves forward (Sao Paulo, in October), and without a zone the day stays as it is."""
    k = F.col("o_orderkey")
    zone, day = F.when(k % 3 == 0, "America/Sao_Paulo").when(k % 3 == 1, "Asia/Tokyo"), F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", F.coalesce(F.date_format(S.midnight(day, zone), "yyyy-MM-dd HH:mm:ss"), day.cast("string")).alias("bound"))


@query("scl_34_as_of_day", "SELECT event_id, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE::VARCHAR AS as_of, ts::DATE::VARCHAR AS utc_as_of FROM events")
def as_of_day(spark, d):
    at = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select("event_id", S.local_date(at, "America/New_York").cast("string").alias("as_of"), S.local_date(at, "UTC").cast("string").alias("utc_as_of"))


@query("scl_35_writable_symbols", "SELECT c_custkey, c_custkey % 3 = 0 AS writable, c_custkey % 3 <> 2 AND c_custkey % 3 <> 1 AS valid FROM customer")
def writable_symbols(spark, d):
    """At most 32 characters, ASCII alone; and the narrower character set that a user may ask for."""
    s = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("BRK-B.^="), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 3 == 1, F.repeat(F.lit("A"), 33)).otherwise("ÅB")
    return table(spark, d, "customer").select("c_custkey", S.writable_symbol(s).alias("writable"), S.valid_symbol(s).alias("valid"))


@query("scl_36_exchanges", "SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN 'UNKNOWN' ELSE upper(c_mktsegment) END AS exchange FROM customer")
def exchanges(spark, d):
    raw = F.when(F.col("c_nationkey") % 8 == 0, "  ").when(F.col("c_nationkey") % 4 != 0, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")))
    return table(spark, d, "customer").select("c_custkey", S.exchange(raw).alias("exchange"))


@query("scl_37_wire_decimal", "SELECT l_orderkey, l_linenumber, l_extendedprice::VARCHAR::DECIMAL(28,12)::VARCHAR AS wire FROM lineitem")
def wire_decimal(spark, d):
    """Fixed point, never an exponent."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.to_price(F.col("l_extendedprice")).cast("string").alias("wire"))


@query("scl_38_tick_wire", """SELECT event_id, '{"p":"' || regexp_replace(value::DECIMAL(28,12)::VARCHAR, '\\.?0+$', '') || '","s":' || user_id || ',"t":' || (epoch_us(ts) // 1000) || '}' AS wire FROM events""")
def tick_wire(spark, d):
    """Milliseconds of the epoch, prices without trailing zeros."""
    price = S.trim_decimal(S.to_price(F.col("value")))
    return table(spark, d, "events").select("event_id", F.to_json(F.struct(price.alias("p"), F.col("user_id").alias("s"), F.unix_millis(F.col("ts").cast("timestamp")).alias("t"))).alias("wire"))


@query("scl_39_trim_decimal", "SELECT DISTINCT l_quantity, regexp_replace(l_quantity::DECIMAL(20,4)::VARCHAR, '\\.?0+$', '') AS text FROM lineitem")
def trim_decimal(spark, d):
    return table(spark, d, "lineitem").select("l_quantity", S.trim_decimal(F.col("l_quantity").cast("decimal(20,4)")).alias("text")).distinct()


@query("scl_41_linear_scale", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 60.0::DOUBLE ELSE 20 + (p_size - 10) / 30.0::DOUBLE * 80 END AS x FROM part")
def linear_scale(spark, d):
    """Not clamped; a span of 0 gives the middle."""
    high = F.when(F.col("p_size") % 5 == 0, 10.0).otherwise(40.0)
    return table(spark, d, "part").select("p_partkey", S.linear(F.col("p_size"), F.lit(10.0), high, 20.0, 100.0).alias("x"))


@query("scl_42_nice_ticks", """
    WITH s AS (SELECT o_custkey, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1 HAVING max(o_totalprice) > min(o_totalprice)),
    r AS (SELECT *, (hi - lo) / 5 AS raw, pow(10, floor(log10((hi - lo) / 5))) AS mag FROM s),
    t AS (SELECT *, CASE WHEN raw / mag <= 1 THEN 1 WHEN raw / mag <= 2 THEN 2 WHEN raw / mag <= 2.5 THEN 2.5 WHEN raw / mag <= 5 THEN 5 ELSE 10 END * mag AS step FROM r)
    SELECT o_custkey, step::DOUBLE AS step, (floor(hi / step) - ceil(lo / step) + 1)::BIGINT AS n, round(ceil(lo / step) * step, 6)::DOUBLE AS first FROM t""")
def nice_ticks(spark, d):
    """Steps of 1, 2, 2.5, 5 or 10 times a power of ten; at most about five of them within the range."""
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")).filter("hi > lo")
    s = s.withColumn("step", S.nice_step(F.col("lo"), F.col("hi"), 5)).withColumn("ticks", S.nice_ticks(F.col("lo"), F.col("hi"), F.col("step")))
    return s.select("o_custkey", "step", F.size("ticks").cast("long").alias("n"), F.round(F.get("ticks", F.lit(0)), 6).alias("first"))


@query("scl_44_bullet_marker", """SELECT o_orderkey, least(greatest(o_totalprice, 50000), 400000)::DOUBLE AS marker, CASE WHEN o_totalprice < 50000 THEN 'below' WHEN o_totalprice > 400000 THEN 'above' END AS outside FROM orders""")
def bullet_marker(spark, d):
    marker, outside = S.clipped(F.col("o_totalprice"), F.lit(50000.0), F.lit(400000.0))
    return table(spark, d, "orders").select("o_orderkey", marker.alias("marker"), outside.alias("outside"))


@query("scl_46_error_kinds", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'rate_limited' WHEN 1 THEN 'timeout' WHEN 2 THEN 'not_found' WHEN 3 THEN 'parse' WHEN 4 THEN 'connection' ELSE 'other' END AS kind FROM orders""")
def error_kinds(spark, d):
    """The first rule whose pattern an error's text has."""
    texts = ["HTTP 429 Too Many Requests", "Read timed out after 30s", "404 Client Error: Not Found", "JSONDecodeError: Expecting value", "Connection reset by peer", "strange"]
    text = F.element_at(F.array(*[F.lit(x) for x in texts]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", S.error_kind(text).alias("kind"))


@query("scl_47_status_rank", "SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 2 WHEN 'O' THEN 1 ELSE 0 END::INT AS rank, count(*) AS n FROM orders GROUP BY ALL")
def status_rank(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus", F.coalesce(S.named(F.col("o_orderstatus"), {"F": 3, "P": 2, "O": 1}), F.lit(0)).alias("rank")).agg(F.count(F.lit(1)).alias("n"))


@query("scl_48_epoch_age", "SELECT event_id, (epoch_us(TIMESTAMP '2024-02-01') // 1000000 - epoch_us(ts) // 1000000)::BIGINT AS age FROM events")
def epoch_age(spark, d):
    return table(spark, d, "events").select("event_id", S.age_seconds(F.lit("2024-02-01").cast("timestamp"), F.col("ts").cast("timestamp")).alias("age"))


@query("scl_49_retention_warning", "SELECT p_partkey, (DATE '2024-02-01' - greatest(p_size - 10, 0)::INT)::DATE::VARCHAR AS warn_from FROM part")
def retention_warning(spark, d):
    """A history of so many days warns ten days before its end, and never in the future."""
    return table(spark, d, "part").select("p_partkey", S.warn_from(F.lit("2024-02-01").cast("date"), F.col("p_size"), 10).cast("string").alias("warn_from"))


@query("scl_50_sql_scalars", """SELECT c_custkey, coalesce(CASE WHEN c_nationkey > 5 THEN upper(c_mktsegment) END, 'NONE') AS a, length(c_name)::INT AS b, c_name LIKE '%99%' AS c FROM customer""")
def sql_scalars(spark, d):
    """The same rules written as SQL."""
    table(spark, d, "customer").createOrReplaceTempView("scl_50_customer")
    return spark.sql("SELECT c_custkey, coalesce(CASE WHEN c_nationkey > 5 THEN upper(c_mktsegment) END, 'NONE') AS a, length(c_name) AS b, c_name LIKE '%99%' AS c FROM scl_50_customer")


@query("scl_51_symbol_charset", "SELECT p_partkey, regexp_full_match(upper(replace(p_name, ' ', CASE WHEN p_partkey % 2 = 0 THEN '.' ELSE '_' END)), '[A-Z0-9.^=-]{1,32}') AS valid FROM part")
def symbol_charset(spark, d):
    text = F.when(F.col("p_partkey") % 2 == 0, F.translate("p_name", " ", ".")).otherwise(F.translate("p_name", " ", "_"))
    return table(spark, d, "part").select("p_partkey", S.valid_symbol(F.upper(text)).alias("valid"))


@query("scl_53_label_key", """SELECT DISTINCT o_orderstatus, '{"priority":"' || o_orderpriority || '","status":"' || o_orderstatus || '"}' AS label_key FROM orders""")
def label_key(spark, d):
    """Labels as sorted compact JSON, whatever order they came in."""
    labels = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    return table(spark, d, "orders").select("o_orderstatus", S.label_key(labels).alias("label_key")).distinct()


@query("scl_54_misfire_grace", "SELECT p_partkey, greatest(1, least(p_size * 30 // 2, 600))::BIGINT AS grace FROM part")
def misfire_grace(spark, d):
    """Half a job's cadence, no more than configured, one second at least."""
    return table(spark, d, "part").select("p_partkey", S.misfire_grace(F.col("p_size") * 30, 600).alias("grace"))


@query("scl_55_exit_words", "SELECT l_linenumber, CASE l_linenumber WHEN 0 THEN 'ok' WHEN 2 THEN 'partial' WHEN 4 THEN 'locked' ELSE 'failed' END AS result, count(*) AS n FROM lineitem GROUP BY ALL")
def exit_words(spark, d):
    return table(spark, d, "lineitem").groupBy("l_linenumber", F.coalesce(S.named(F.col("l_linenumber"), S.EXIT_WORDS), F.lit("failed")).alias("result")).agg(F.count(F.lit(1)).alias("n"))


@query("scl_01_symbols", "SELECT c_custkey, upper(c_mktsegment) || '-' || c_nationkey AS symbol FROM customer")
def symbols(spark, d):
    raw = F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string"), F.lit(" "))
    return table(spark, d, "customer").select("c_custkey", S.symbol(raw).alias("symbol"))


@query("scl_04_to_int", f"""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 12 = 8 THEN '0' WHEN o_orderkey % 12 = 10 THEN '-7' END, 'null') AS n, coalesce(CASE WHEN o_orderkey % 5 > 0 THEN o_custkey::VARCHAR END, 'null') AS big FROM ({_SQL_TEXT})""")
def to_int(spark, d):
    """Whole numbers alone: words, fractions and what overflows are null."""
    far = F.when(F.col("o_orderkey") % 5 == 0, F.lit("9" * 25)).otherwise(F.col("o_custkey").cast("string"))
    text = lambda c: F.coalesce(S.to_long(c).cast("string"), F.lit("null"))
    return _dirty(spark, d).select("o_orderkey", text(F.col("t")).alias("n"), text(far).alias("big"))


@query("scl_06_to_decimal", "SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 2 THEN 'null' WHEN 3 THEN 'null' ELSE l_discount::VARCHAR::DECIMAL(28,12)::VARCHAR END AS price FROM lineitem")
def to_decimal(spark, d):
    """By the shortest digits of a double; what isn't finite is null, and a zero stays one."""
    x = F.when(F.col("l_linenumber") == 2, float("nan")).when(F.col("l_linenumber") == 3, float("inf")).otherwise(F.col("l_discount"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.coalesce(S.to_price(x).cast("string"), F.lit("null")).alias("price"))


@query("scl_11_content_hash", f"SELECT o_orderkey, coalesce(sha256(t), 'null') AS h FROM ({_SQL_TEXT})")
def content_hash(spark, d):
    return _dirty(spark, d).select("o_orderkey", F.coalesce(S.content_hash(F.col("t")), F.lit("null")).alias("h"))


@query("scl_12_short_hash", f"SELECT o_orderkey, coalesce(sha256(t)[1:16], 'null') AS h FROM ({_SQL_TEXT})")
def short_hash(spark, d):
    return _dirty(spark, d).select("o_orderkey", F.coalesce(S.short_hash(F.col("t")), F.lit("null")).alias("h"))


@query("scl_14_blank_to_none", f"SELECT o_orderkey, coalesce(nullif(trim(t), ''), 'null') AS v FROM ({_SQL_TEXT})")
def blank_to_none(spark, d):
    return _dirty(spark, d).select("o_orderkey", F.coalesce(S.blank_to_null(F.col("t")), F.lit("null")).alias("v"))


@query("scl_15_key_value", f"SELECT o_orderkey, trim(t) AS v FROM ({_SQL_TEXT}) WHERE trim(t) <> '' AND length(trim(t)) <= 6")
def key_value(spark, d):
    """Keys that are empty or too long drop their row; they are never cut."""
    return _dirty(spark, d).select("o_orderkey", S.key_text(F.col("t"), 6).alias("v")).filter("v IS NOT NULL")


@query("scl_17_big_values", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 4 THEN 'null' ELSE (l_orderkey * 1000 + 2 * round(l_quantity / 2))::HUGEINT::VARCHAR END AS big FROM lineitem WHERE l_quantity % 2 = 0")
def big_values(spark, d):
    """Halves go to the even neighbour; what has more than 38 digits is null."""
    x = F.concat((F.col("l_orderkey") * 1000 + F.col("l_quantity").cast("long")).cast("string"), F.lit(".5"))
    x = F.when(F.col("l_linenumber") == 4, F.lit("9" * 45)).otherwise(x)
    return table(spark, d, "lineitem").filter("l_quantity % 2 = 0").select("l_orderkey", "l_linenumber", F.coalesce(S.to_big(x).cast("string"), F.lit("null")).alias("big"))


@query("scl_24_slugs", "SELECT p_partkey, replace(replace(lower(trim(p_name)), ' ', '_'), '-', '_') || '_' || lower(p_type) AS slug FROM part")
def slugs(spark, d):
    return table(spark, d, "part").select("p_partkey", S.slug(F.concat(F.lit(" "), F.upper("p_name"), F.lit("-"), F.col("p_type"), F.lit(" "))).alias("slug"))


@query("scl_32_local_dates", f"SELECT o_orderkey, (((o_orderdate + INTERVAL 5 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE {_ZONES})::DATE::VARCHAR AS day FROM orders")
def local_dates(spark, d):
    """The calendar day at the exchange, each row in its own zone."""
    at = F.expr("o_orderdate + INTERVAL 5 HOUR").cast("timestamp")
    return table(spark, d, "orders").select("o_orderkey", S.local_date(at, _zone()).cast("string").alias("day"))


@query("scl_40_buckets", "SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts)::TIMESTAMP AS m5, time_bucket(INTERVAL 1 HOUR, ts)::TIMESTAMP AS h1 FROM events")
def buckets(spark, d):
    at = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select("event_id", S.bucket_of(at, 300).cast("timestamp_ntz").alias("m5"), S.bucket_of(at, 3600).cast("timestamp_ntz").alias("h1"))


@query("scl_43_heat", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN least(1.0, (l_discount - 0.05) / 0.03) WHEN l_discount < 0.05 THEN -least(1.0, (0.05 - l_discount) / 0.03) ELSE 0.0 END::DOUBLE AS heat FROM lineitem WHERE l_discount <> 0.05")
def heat(spark, d):
    return table(spark, d, "lineitem").filter("l_discount != 0.05D").select("l_orderkey", "l_linenumber", S.heat(F.col("l_discount") - 0.05, 0.03).alias("heat"))


@query("scl_45_margins", "SELECT o_custkey, sum(o_orderkey) / sum(round(o_totalprice * 100)::BIGINT) * 100 AS margin FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def margins(spark, d):
    """Null, and no row here, where there is no revenue."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    sums = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))).alias("net"), F.coalesce(F.sum(F.when(F.col("o_orderstatus") != "P", cents)), F.lit(0)).alias("revenue"))
    return sums.select("o_custkey", S.margin(F.col("net"), F.col("revenue")).alias("margin")).filter("margin IS NOT NULL")
