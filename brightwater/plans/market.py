"""Time-series queries: bars, markers, ranges, gaps, rescales, indexes, heat and folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling, series
from .feed import windows_sql
from .registry import query, table

_HISTORY = "h AS (SELECT l_partkey AS symbol, l_shipdate::DATE::VARCHAR AS day, max(l_extendedprice) AS close FROM lineitem GROUP BY ALL)"


def history(spark, d):
    """Daily closes of a symbol."""
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").cast("string").alias("day")).agg(F.max("l_extendedprice").alias("close"))


@query("agg_18_minute_bars", """
    SELECT user_id, date_trunc('minute', ts) AS bar_ts, arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close FROM events GROUP BY ALL""")
def minute_bars(spark, d):
    return series.ohlc(table(spark, d, "events"), ["user_id"], F.date_trunc("minute", "ts").cast("timestamp_ntz"), "value", ["ts", "event_id"])


@query("jon_21_as_of_markers", """
    WITH a AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'), c AS (SELECT user_id, ts AS cts, min(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY ALL),
    f AS (SELECT user_id, min(cts) AS first_ts FROM c GROUP BY 1)
    SELECT a.user_id, a.ts, a.event_id, c.cts AS candle_ts, c.v AS candle_value FROM a JOIN f ON a.user_id = f.user_id AND a.ts >= f.first_ts ASOF JOIN c ON a.user_id = c.user_id AND a.ts <= c.cts""")
def as_of_markers(spark, d):
    e = table(spark, d, "events")
    c = e.filter("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.min("value").alias("value"))
    return series.as_of_forward(e.filter("event_type = 'signup'").select("user_id", "ts", "event_id"), c, ["user_id"], "ts", "value")


@query("jon_19_session_flag", """
    WITH s AS (SELECT ts::DATE AS day, min(ts) AS opens, max(ts) AS closes FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING day(min(ts)) % 3 <> 0)
    SELECT event_id, coalesce(ts < opens OR ts >= closes, false) AS is_extended FROM events LEFT JOIN s ON ts::DATE = day""")
def session_flag(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    s = e.filter("event_type = 'purchase'").groupBy("day").agg(F.min("ts").alias("opens"), F.max("ts").alias("closes")).filter(F.dayofmonth("opens") % 3 != 0)
    return series.out_of_session(e, s, "day", "ts").select("event_id", "is_extended")


@query("jon_22_gap_bands", """
    SELECT user_id, ts AS gap_start, nxt AS gap_end FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events) WHERE epoch(nxt)::BIGINT - epoch(ts)::BIGINT > 36000""")
def gap_bands(spark, d):
    return series.gaps(table(spark, d, "events").select("user_id", "ts"), ["user_id"], "ts", 36000)


@query("win_11_merged_ranges", """
    WITH r AS (SELECT l_partkey AS symbol, l_shipdate::DATE AS a, (l_shipdate::DATE + (l_quantity::INT * 3)) AS b FROM lineitem),
    m AS (SELECT *, CASE WHEN a > max(b) OVER w THEN 1 WHEN max(b) OVER w IS NULL THEN 1 ELSE 0 END AS f FROM r WINDOW w AS (PARTITION BY symbol ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    i AS (SELECT *, sum(f) OVER (PARTITION BY symbol ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM m)
    SELECT symbol, min(a)::VARCHAR AS range_start, max(b)::VARCHAR AS range_end FROM i GROUP BY symbol, g""")
def merged_ranges(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_partkey").alias("symbol"), F.to_date("l_shipdate").alias("range_start"), F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int") * 3).alias("range_end"))
    return series.merged_ranges(r, ["symbol"], "range_start", "range_end").select("symbol", F.col("range_start").cast("string"), F.col("range_end").cast("string"))


@query("win_12_slices", """
    SELECT p_partkey, w::DATE::VARCHAR AS window_start, least(w::DATE + 7, a + p_size)::VARCHAR AS window_end FROM (SELECT p_partkey, p_size, DATE '2024-01-01' AS a FROM part),
    LATERAL (SELECT unnest(generate_series(a::TIMESTAMP, (a + p_size - 1)::TIMESTAMP, INTERVAL 7 DAY)) AS w)""")
def slices(spark, d):
    r = table(spark, d, "part").select("p_partkey", F.lit("2024-01-01").cast("date").alias("a"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("b"))
    return series.sliced(r, "a", "b", 7).select("p_partkey", F.col("window_start").cast("string"), F.col("window_end").cast("string"))


@query("win_05_last_rows", f"WITH {_HISTORY} SELECT symbol, day, close FROM h QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY day DESC) <= 5")
def last_rows(spark, d):
    return series.last_rows(history(spark, d), ["symbol"], [F.desc("day")], 5)


@query("win_08_index_100", f"WITH {_HISTORY} SELECT symbol, day, close, close * 100 / nullif(first_value(close) OVER (PARTITION BY symbol ORDER BY day), 0) AS indexed FROM h")
def index_100(spark, d):
    return series.index_to_100(history(spark, d), ["symbol"], "day", "close", most=None)  # a row a day


@query("win_09_changes", f"""WITH {_HISTORY}, l AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS prev FROM h)
    SELECT symbol, day, close, prev, close - prev AS change, (close - prev) / nullif(prev, 0) * 100 AS change_pct FROM l""")
def changes(spark, d):
    return series.changes(history(spark, d), ["symbol"], "day", "close", most=None)  # a row a day


@query("mrg_23_rescale", """
    WITH s AS (SELECT user_id, list(CASE event_id % 3 WHEN 0 THEN 32 WHEN 1 THEN 21 ELSE 25 END::HUGEINT ORDER BY ts, CASE event_id % 3 WHEN 0 THEN 15 WHEN 1 THEN 20 ELSE 4 END) AS codes,
                      list(ts ORDER BY ts, CASE event_id % 3 WHEN 0 THEN 15 WHEN 1 THEN 20 ELSE 4 END) AS at FROM events WHERE event_type = 'signup' AND event_id % 7 <> 0 GROUP BY 1),
    b AS (SELECT e.event_id, (round(e.value * 100)::HUGEINT * 10000000000) AS p, e.event_id::HUGEINT AS v,
                 CASE WHEN e.event_type = 'click' THEN [] ELSE coalesce(list_filter(s.codes, lambda x, i: s.at[i] > e.ts), []) END::HUGEINT[] AS c FROM events e LEFT JOIN s USING (user_id))
    SELECT event_id, (list_reduce(list_prepend(p, c), lambda a, r: (a * (r % 10) * 2 + r // 10) // (2 * (r // 10)))::DECIMAL(38,0) / 1e12)::DOUBLE AS price,
           list_reduce(list_prepend(v, c), lambda a, r: a * (r // 10) // (r % 10))::BIGINT AS volume FROM b""")
def rescale(spark, d):
    """Bars before a split, over splits of 3:2, 2:1 and 2:5 in turn, some of no ratio; daily bars (clicks) stay as they are."""
    e, k = table(spark, d, "events"), F.col("event_id")
    ratio = F.when(k % 7 == 0, 0.0).when(k % 3 == 0, 1.5).when(k % 3 == 1, 2.0).otherwise(0.4)
    s = e.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("boundary"), ratio.cast("decimal(20,10)").alias("ratio"))
    bars = e.select("event_id", "user_id", F.col("ts").alias("ts_utc"), F.col("value").alias("price"), k.alias("volume"), F.when(F.col("event_type") == "click", "1d").otherwise("5m").alias("bar_interval"))
    return series.rescaled(bars, s, "user_id", ["price"], "volume", interval="bar_interval").select("event_id", F.col("price").cast("double").alias("price"), "volume")


@query("agg_25_per_day_axis", """
    SELECT day::DATE::VARCHAR AS day, count(event_id) AS n FROM generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-01-08', INTERVAL 1 DAY) g(day)
    LEFT JOIN events ON ts::DATE = day::DATE AND event_type = 'purchase' GROUP BY 1""")
def per_day_axis(spark, d):
    """A ten-day axis on which empty days show as 0."""
    axis = spark.sql("SELECT explode(sequence(date'2023-12-30', date'2024-01-08')) AS day")
    n = table(spark, d, "events").filter("event_type = 'purchase'").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return axis.join(n, "day", "left").fillna(0).select(F.col("day").cast("string"), "n")


@query("agg_27_tail_fold", """
    WITH s AS (SELECT p_brand AS name, sum(p_size)::BIGINT AS total FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY total DESC, name) AS rn FROM s)
    SELECT name, total FROM r WHERE rn < 6 UNION ALL SELECT 'Other (' || count(*) || ')', sum(total)::BIGINT FROM r WHERE rn >= 6 HAVING count(*) > 0""")
def tail_fold(spark, d):
    s = table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.sum("p_size").alias("total"))
    return series.tail_folded(s, "name", "total", 6)


@query("uia_03_financial_pivot", """
    WITH y AS (SELECT l_suppkey, year(l_shipdate)::INT AS yr, sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(28,2) AS revenue FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, (max(revenue) FILTER (yr = 1996))::DOUBLE AS y1996, (max(revenue) FILTER (yr = 1997))::DOUBLE AS y1997, (max(revenue) FILTER (yr = 1998))::DOUBLE AS y1998 FROM y GROUP BY 1""")
def financial_pivot(spark, d):
    li = table(spark, d, "lineitem").withColumn("yr", F.year("l_shipdate"))
    out = li.groupBy("l_suppkey").pivot("yr", [1996, 1997, 1998]).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"))
    return out.withColumnsRenamed({"1996": "y1996", "1997": "y1997", "1998": "y1998"})


@query("win_15_hour_sample", windows_sql("user_id, event_type", 2))
def hour_sample(spark, d):
    """At most two rejects for a symbol and reason in an hour that begins with the first of them: the batch form, by pointer jumping."""
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return sampling.sampled(e, ["user_id", "event_type"], "ts", ["event_id"], 2).select("user_id", "event_type", "window_start", "event_id", "seen")


@query("win_15_hour_sample_by_reason", windows_sql("event_type", 2))
def hour_sample_by_reason(spark, d):
    """The same rows as the stream keeps (STR-12)."""
    e = table(spark, d, "events").select("event_type", "event_id", "ts")
    return sampling.sampled(e, ["event_type"], "ts", ["event_id"], 2).select("event_type", "window_start", "event_id", "seen")
