"""Planning and upkeep: connection plans, ledgers, gaps, streaks, orphan runs, counters and limits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .registry import query, table


@query("src_11_plan_diff", """
    WITH a AS (SELECT c_custkey AS k, c_mktsegment AS x FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 = 1 THEN 'MOVED' ELSE c_mktsegment END AS x FROM customer WHERE c_custkey % 4 <> 0)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'add' WHEN b.k IS NULL THEN 'remove' ELSE 'move' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE a.x IS DISTINCT FROM b.x""")
def plan_diff(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    now = c.filter(k % 3 != 0).select(k.alias("k"), F.col("c_mktsegment").alias("x"), F.lit(True).alias("in_a"))
    want = c.filter(k % 4 != 0).select(k.alias("k"), F.when(k % 10 == 1, "MOVED").otherwise(F.col("c_mktsegment")).alias("y"), F.lit(True).alias("in_b"))
    both = now.join(want, "k", "full").filter(~F.col("x").eqNullSafe(F.col("y")))
    return both.select("k", F.when(F.col("in_a").isNull(), "add").when(F.col("in_b").isNull(), "remove").otherwise("move").alias("change"))


@query("snk_07_topics", "SELECT DISTINCT 'ticks.' || regexp_replace(coalesce(nullif(trim(upper(c_mktsegment)), ''), 'unknown'), '[^A-Za-z0-9._-]', '_', 'g') AS topic FROM customer")
def topics(spark, d):
    return table(spark, d, "customer").select(S.topic("ticks.", F.col("c_mktsegment")).alias("topic")).distinct()


@query("mrg_25_pending_splits", """
    WITH s AS (SELECT user_id, ts FROM events WHERE event_type = 'signup'), l AS (SELECT user_id, ts FROM events WHERE event_type = 'signup' AND event_id % 3 = 0), b AS (SELECT user_id, min(ts) AS first_bar FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT s.user_id, s.ts FROM s JOIN b USING (user_id) WHERE s.ts > first_bar AND NOT EXISTS (SELECT 1 FROM l WHERE l.user_id = s.user_id AND l.ts = s.ts)""")
def pending_splits(spark, d):
    """Not in the ledger, and after the symbol's first bar."""
    e = table(spark, d, "events")
    s = e.filter("event_type = 'signup'").select("user_id", "ts")
    ledger = e.filter("event_type = 'signup' AND event_id % 3 = 0").select("user_id", "ts")
    first = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_bar"))
    return s.join(first, "user_id").filter("ts > first_bar").join(ledger, ["user_id", "ts"], "left_anti").select("user_id", "ts")


@query("mrg_31_close_orphan_runs", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN 'failed' ELSE o_orderstatus END AS status FROM orders""")
def close_orphan_runs(spark, d):
    dead = table(spark, d, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("dead"))
    closes = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")) & F.col("dead").isNotNull()
    return table(spark, d, "orders").join(dead, "o_custkey", "left").select("o_orderkey", F.when(closes, "failed").otherwise(F.col("o_orderstatus")).alias("status"))


@query("win_02_latest_by_scope", """
    SELECT scope, scheduled, o_orderkey FROM (SELECT o_orderpriority AS scope, o_orderstatus = 'F' AS scheduled, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_by_scope(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("scope"), (F.col("o_orderstatus") == "F").alias("scheduled"))
    return o.agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("b")).select("scope", "scheduled", "b.o_orderkey")


@query("win_16_streaks", """
    WITH x AS (SELECT user_id, event_id, event_type = 'view' AS unknown, sum(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events)
    SELECT user_id, max(n) AS longest, max(n) >= 3 AS deactivate FROM (SELECT user_id, island, count(*) FILTER (unknown) AS n FROM x GROUP BY ALL) GROUP BY 1""")
def streaks(spark, d):
    """The longest run of unknown answers; three in a row deactivate."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    unknown = F.col("event_type") == "view"
    x = table(spark, d, "events").withColumn("unknown", unknown).withColumn("island", F.sum(F.when(unknown, 0).otherwise(1)).over(w))
    runs = x.groupBy("user_id", "island").agg(F.count_if("unknown").alias("n"))
    return runs.groupBy("user_id").agg(F.max("n").alias("longest"), (F.max("n") >= 3).alias("deactivate"))


@query("agg_08_by_run_and_status", "SELECT l_orderkey AS run_id, coalesce(nullif(l_returnflag, 'R'), 'other') AS kind, count(*) AS n FROM lineitem GROUP BY ALL")
def by_run_and_status(spark, d):
    kind = F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("R")), F.lit("other"))
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("run_id"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_28_additive_upsert", """
    SELECT user_id, day, sum(n)::BIGINT AS n, bool_or(estimated) AS estimated FROM (SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS n, false AS estimated FROM events WHERE event_id % 2 = 0 GROUP BY ALL
    UNION ALL SELECT user_id, ts::DATE::VARCHAR, count(*), bool_or(event_type = 'click') FROM events WHERE event_id % 2 = 1 GROUP BY ALL) GROUP BY ALL""")
def additive_upsert(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts").cast("string"))
    stored = e.filter("event_id % 2 = 0").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"), F.lit(False).alias("estimated"))
    flushed = e.filter("event_id % 2 = 1").groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("event_type") == "click").alias("estimated"))
    return stored.unionByName(flushed).groupBy("user_id", "day").agg(F.sum("n").alias("n"), F.bool_or("estimated").alias("estimated"))


@query("agg_31_lag", "SELECT count(*) AS unpublished, (epoch(TIMESTAMP '2024-02-01') - floor(epoch(min(ts))))::BIGINT AS oldest_s FROM events WHERE event_id > 9000")
def lag(spark, d):
    age = F.unix_timestamp(F.lit("2024-02-01").cast("timestamp")) - F.unix_timestamp(F.min("ts").cast("timestamp"))
    return table(spark, d, "events").filter("event_id > 9000").agg(F.count(F.lit(1)).alias("unpublished"), age.alias("oldest_s"))


@query("str_24_fixed_window_limit", """
    SELECT event_id, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) <= 2 AS allowed FROM events""")
def fixed_window_limit(spark, d):
    w = Window.partitionBy("user_id", F.date_trunc("day", "ts")).orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", (F.row_number().over(w) <= 2).alias("allowed"))


@query("srt_09_eligible_pool", """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > -500 ORDER BY CASE WHEN c_acctbal > 5000 THEN 0 WHEN c_acctbal < 0 THEN 2 ELSE 1 END, c_acctbal NULLS LAST, c_custkey LIMIT 30""")
def eligible_pool(spark, d):
    health = F.when(F.col("c_acctbal") > 5000, 0).when(F.col("c_acctbal") < 0, 2).otherwise(1)
    return table(spark, d, "customer").filter("c_acctbal > -500").orderBy(health, F.col("c_acctbal").asc_nulls_last(), "c_custkey").limit(30).select("c_custkey", "c_acctbal")
