"""Open gaps, fetched windows, ledgers and membership splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge, series
from .registry import query, table

_GAPS = """g AS (SELECT user_id, ts AS gap_start, nxt AS gap_end FROM (SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events) WHERE epoch(nxt)::BIGINT - epoch(ts)::BIGINT > 36000)"""


def _open(spark, d):
    return series.gaps(table(spark, d, "events").select("user_id", "ts"), ["user_id"], "ts", 36000)


@query("jon_20_gaps_in_windows", f"""WITH {_GAPS}, w AS (SELECT c_custkey AS user_id, TIMESTAMP '2024-01-01' + to_days(((c_custkey + 7 * k) % 20)::INT) AS a FROM customer, range(2) r(k))
    SELECT user_id, gap_start FROM g WHERE EXISTS (SELECT 1 FROM w WHERE w.user_id = g.user_id AND gap_start >= a AND gap_start < a + INTERVAL 5 DAY)""")
def gaps_in_windows(spark, d):
    """A gap is closed if a fetched window of its symbol holds its start. Windows overlap; no pairs of gaps and windows are made."""
    start = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast((c_custkey + 7 * k) % 20 as int))")
    w = table(spark, d, "customer").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).select(F.col("c_custkey").alias("user_id"), start.alias("a"))
    return series.inside(_open(spark, d), w.withColumn("b", F.expr("a + INTERVAL 5 DAYS")), ["user_id"], "gap_start", "a", "b").select("user_id", "gap_start")


@query("agg_20_gap_summary", f"""WITH {_GAPS} SELECT user_id, count(*) AS n, count(*) FILTER (gap_end - gap_start > INTERVAL 1 DAY) AS long_ones, min(gap_start) AS oldest FROM g GROUP BY 1""")
def gap_summary(spark, d):
    long = F.col("gap_end") - F.col("gap_start") > F.expr("INTERVAL 1 DAY")
    return _open(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(long).alias("long_ones"), F.min("gap_start").alias("oldest"))


@query("jon_23_missing_minutes", """
    SELECT DISTINCT user_id, date_trunc('hour', ts) AS slot FROM events WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM events b WHERE b.event_type = 'view' AND b.user_id = events.user_id AND date_trunc('hour', b.ts) = date_trunc('hour', events.ts))""")
def missing_minutes(spark, d):
    e = table(spark, d, "events").withColumn("slot", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    of = lambda k: e.filter(F.col("event_type") == k).select("user_id", "slot").distinct()
    return of("click").join(of("view"), ["user_id", "slot"], "left_anti")


@query("jon_29_requested_split", """
    WITH q AS (SELECT DISTINCT o_custkey * 2 AS k FROM orders WHERE o_orderpriority = '1-URGENT') SELECT k, EXISTS (SELECT 1 FROM customer WHERE c_custkey = k) AS accepted FROM q""")
def requested_split(spark, d):
    """Requested symbols against the universe: those unknown are refused by name, not dropped."""
    q = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select((F.col("o_custkey") * 2).alias("k")).distinct()
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k")).distinct().withColumn("_in", F.lit(True))
    return q.join(c, "k", "left").select("k", F.col("_in").isNotNull().alias("accepted"))


@query("set_03_vanished_keys", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N'")
def vanished_keys(spark, d):
    li = table(spark, d, "lineitem")
    of = lambda f: li.filter(F.col("l_returnflag") == f).select("l_orderkey", "l_linenumber")
    return of("R").join(of("N"), ["l_orderkey", "l_linenumber"], "left_anti").distinct()


@query("mrg_26_unseeded_splits", """
    SELECT count(*) AS unseeded FROM events WHERE event_type = 'signup' AND ts > (SELECT min(ts) FROM events WHERE event_type = 'purchase') AND event_id % 3 <> 0""")
def unseeded_splits(spark, d):
    e = table(spark, d, "events")
    first = e.filter("event_type = 'purchase'").agg(F.min("ts").alias("first_bar"))
    s = e.filter("event_type = 'signup' AND event_id % 3 != 0").crossJoin(F.broadcast(first))  # one row
    return s.filter("ts > first_bar").agg(F.count(F.lit(1)).alias("unseeded"))


@query("mrg_29_gap_close", f"""WITH {_GAPS}, k AS (SELECT DISTINCT user_id, gap_start FROM g), s AS (SELECT user_id, gap_start, gap_end - INTERVAL 1 HOUR AS gap_end, CASE WHEN gap_end < TIMESTAMP '2024-01-10' THEN gap_end END AS resolved_at FROM g WHERE day(gap_start) < 20)
    SELECT g.user_id, g.gap_start, g.gap_end, CASE WHEN extract(hour FROM g.gap_start) < 12 THEN TIMESTAMP '2024-02-01' ELSE s.resolved_at END AS resolved_at FROM g LEFT JOIN s USING (user_id, gap_start)""")
def gap_close(spark, d):
    """Two upserts into one table that share no column but the key: found gaps set their end and never whether they are resolved, closed ones set when they were and nothing else."""
    g = _open(spark, d)
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    stored = g.filter(F.dayofmonth("gap_start") < 20).select("user_id", "gap_start", F.expr("gap_end - INTERVAL 1 HOUR").alias("gap_end"), F.when(F.col("gap_end") < at("2024-01-10"), F.col("gap_end")).alias("resolved_at"))
    found = merge.merge(stored, g, merge.WriteSpec("bar_gaps", ["user_id", "gap_start"], update=["gap_end"]))
    closed = g.filter(F.hour("gap_start") < 12).select("user_id", "gap_start", at("2024-02-01").alias("resolved_at"))
    return merge.merge(found, closed, merge.WriteSpec("bar_gaps", ["user_id", "gap_start"], update=["resolved_at"]))


@query("agg_17_least_watermark", """
    SELECT c_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 3 THEN min(newest) END AS resume_at FROM customer LEFT JOIN
    (SELECT o_custkey, o_orderstatus, max(o_orderdate) AS newest FROM orders GROUP BY ALL) ON o_custkey = c_custkey GROUP BY 1""")
def least_watermark(spark, d):
    """The least of three watermarks, null if any of them is missing."""
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus").agg(F.max("o_orderdate").alias("newest"))
    n = n.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("k"), F.min("newest").alias("newest"))
    return table(spark, d, "customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.when(F.col("k") == 3, F.col("newest")).alias("resume_at"))
