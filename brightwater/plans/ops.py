"""Operational queries: audit, freshness, counters, lag. ``now`` is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query, table

# Rank of an item's status, the worst highest.
STATUS_RANK = {"A": 3, "N": 1, "R": 2}


def _items(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_partkey").alias("symbol"), F.col("l_suppkey").alias("dataset"), F.col("l_returnflag").alias("status"), "l_quantity")
    rank = F.create_map(*[F.lit(x) for kv in STATUS_RANK.items() for x in kv])
    return li.withColumn("rank", rank[F.col("status")])


@query("agg_01_run_counts", """
    SELECT l_orderkey AS run_id, count(*) AS n, coalesce(sum(CASE WHEN l_returnflag = 'A' THEN 1 END), 0)::BIGINT AS failed, coalesce(sum(CASE WHEN l_returnflag = 'N' THEN 1 END), 0)::BIGINT AS ok,
           coalesce(sum(CASE WHEN l_returnflag = 'R' THEN 1 END), 0)::BIGINT AS skipped FROM lineitem GROUP BY 1""")
def run_counts(spark, d):
    of = lambda s: F.count_if(F.col("status") == s)
    return _items(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), of("A").alias("failed"), of("N").alias("ok"), of("R").alias("skipped"))


@query("agg_02_resolved", "SELECT count(*) AS resolved FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) = 0)")
def resolved(spark, d):
    return _items(spark, d).groupBy("symbol").agg(F.count_if(F.col("status") == "A").alias("bad")).filter("bad = 0").agg(F.count(F.lit(1)).alias("resolved"))


@query("agg_03_coverage", "SELECT l_suppkey AS dataset, count(DISTINCT l_partkey) AS covered, (SELECT count(*) FROM part) - count(DISTINCT l_partkey) AS missing FROM lineitem GROUP BY 1")
def coverage(spark, d):
    expected = table(spark, d, "part").agg(F.count(F.lit(1)).alias("expected"))
    out = _items(spark, d).groupBy("dataset").agg(F.countDistinct("symbol").alias("covered"))
    return out.crossJoin(F.broadcast(expected)).select("dataset", "covered", (F.col("expected") - F.col("covered")).alias("missing"))  # one row


_FRESH = """WITH w AS (SELECT l_orderkey AS run_id, l_partkey AS symbol, l_suppkey AS dataset, max(CASE l_returnflag WHEN 'A' THEN 3 WHEN 'R' THEN 2 ELSE 1 END)::INT AS worst FROM lineitem GROUP BY ALL)
    SELECT w.symbol, w.dataset, arg_max(worst, run_id)::INT AS latest, max(o_orderdate) FILTER (worst < 3) AS fresh_at FROM w JOIN orders ON o_orderkey = run_id GROUP BY ALL"""


@query("agg_04_freshness", _FRESH)
def freshness(spark, d):
    """Worst status per run and cell, then the newest run's. Both are hash aggregates that map tasks begin; a run's start joins what the first one leaves."""
    runs = table(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started"))
    worst = _items(spark, d).groupBy("symbol", "dataset", "run_id").agg(F.max("rank").alias("worst")).join(runs, "run_id")
    return worst.groupBy("symbol", "dataset").agg(F.max_by("worst", "run_id").alias("latest"), F.max(F.when(F.col("worst") < 3, F.col("started"))).alias("fresh_at"))


@query("agg_06_stale_cells", f"WITH f AS ({_FRESH}) SELECT dataset, count(*) FILTER (fresh_at IS NULL OR fresh_at < TIMESTAMP '1998-01-01') AS stale, count(*) AS cells FROM f GROUP BY 1")
def stale_cells(spark, d):
    old = F.col("fresh_at").isNull() | (F.col("fresh_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return freshness(spark, d).groupBy("dataset").agg(F.count_if(old).alias("stale"), F.count(F.lit(1)).alias("cells"))


@query("agg_09_by_state", "SELECT CASE WHEN c_acctbal < 0 THEN 'dead' WHEN c_acctbal < 1000 THEN 'cooldown' ELSE 'healthy' END AS state, count(*) AS n FROM customer GROUP BY 1")
def by_state(spark, d):
    state = F.when(F.col("c_acctbal") < 0, "dead").when(F.col("c_acctbal") < 1000, "cooldown").otherwise("healthy")
    return table(spark, d, "customer").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_10_oldest_open", """
    SELECT o_orderpriority AS reason, count(*) AS open, (epoch(TIMESTAMP '2002-01-01') - epoch(min(o_orderdate)))::BIGINT AS oldest_s FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""")
def oldest_open(spark, d):
    age = F.unix_timestamp(F.lit("2002-01-01").cast("timestamp")) - F.unix_timestamp(F.min("o_orderdate").cast("timestamp"))
    return table(spark, d, "orders").filter("o_orderstatus = 'O'").groupBy(F.col("o_orderpriority").alias("reason")).agg(F.count(F.lit(1)).alias("open"), age.alias("oldest_s"))


@query("agg_12_zero_when_empty", "SELECT coalesce(max(value), 0)::DOUBLE AS most, count(*) AS n FROM events WHERE event_type = 'no such type'")
def zero_when_empty(spark, d):
    return table(spark, d, "events").filter("event_type = 'no such type'").agg(F.coalesce(F.max("value"), F.lit(0.0)).alias("most"), F.count(F.lit(1)).alias("n"))


@query("agg_13_latest_day_usage", "SELECT event_type, count(*) AS n FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) GROUP BY 1")
def latest_day_usage(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return e.join(F.broadcast(e.agg(F.max("day").alias("day"))), "day").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))  # one row


@query("agg_16_watermarks", "SELECT l_partkey AS symbol, max(l_shipdate) AS newest, min(l_shipdate) AS oldest, count(*) AS n FROM lineitem GROUP BY 1")
def watermarks(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("symbol")).agg(F.max("l_shipdate").alias("newest"), F.min("l_shipdate").alias("oldest"), F.count(F.lit(1)).alias("n"))


@query("agg_19_by_exchange", "SELECT c_mktsegment, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def by_exchange(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(spark, d, "customer").join(n, "c_nationkey").groupBy("c_mktsegment", "n_name").agg(F.count(F.lit(1)).alias("n"))


@query("agg_29_exit_codes", """
    SELECT l_orderkey AS run_id, CASE WHEN count(*) FILTER (l_returnflag = 'A') = 0 THEN 0 WHEN count(*) FILTER (l_returnflag = 'N') > 0 THEN 2 ELSE 1 END::INT AS exit_code FROM lineitem GROUP BY 1""")
def exit_codes(spark, d):
    c = run_counts(spark, d)
    return c.select("run_id", F.when(F.col("failed") == 0, 0).when(F.col("ok") > 0, 2).otherwise(1).alias("exit_code"))


@query("agg_30_ratios", "SELECT l_suppkey AS dataset, (count(*) FILTER (l_returnflag = 'A') / greatest(count(*), 1))::DOUBLE AS failure_ratio FROM lineitem GROUP BY 1")
def ratios(spark, d):
    return _items(spark, d).groupBy("dataset").agg((F.count_if(F.col("status") == "A") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("failure_ratio"))
