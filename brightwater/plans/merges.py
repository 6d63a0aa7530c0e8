"""Merges, gates and retention over deterministic splits of the test tables into stored and incoming rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates, merge
from .registry import query, table

_STORED = "s AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price, o_orderdate AS at FROM orders WHERE o_orderkey % 3 <> 0)"
_INCOMING = """i AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS status, o_totalprice + (o_orderkey % 5 - 2) AS price,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS at FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 7 = 0)"""


def _sides(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    stored = o.filter(k % 3 != 0).select(k.alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("at"))
    incoming = o.filter((k % 2 == 0) | (k % 7 == 0)).select(
        k.alias("k"), F.when(k % 4 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"), (F.col("o_totalprice") + (k % 5 - 2)).alias("price"),
        F.when(k % 2 == 0, F.expr("o_orderdate + INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")).alias("at"))
    return stored, incoming


@query("mrg_01_last_wins", """
    WITH r AS (SELECT *, (l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax) AS seq FROM lineitem)
    SELECT l_orderkey, l_linenumber, arg_max(l_partkey, seq) AS l_partkey, arg_max(l_suppkey, seq) AS l_suppkey, arg_max(l_quantity, seq) AS l_quantity,
           arg_max(l_tax, seq) FILTER (l_returnflag <> 'N') AS l_tax, max(l_discount) AS l_discount FROM r GROUP BY ALL""")
def last_wins(spark, d):
    """Later rows overlay earlier ones field by field: a row of flag N has no tax of its own to lay over another's. The discount only grows."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_discount", "l_returnflag")
    out = merge.last_wins(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax"], monotonic=["l_discount"],
                          present={"l_tax": F.col("l_returnflag") != "N"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount")


@query("mrg_02_guarded_dedupe", """
    WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 37 <> 0 THEN value END AS value, ts FROM events),
    n AS (SELECT user_id, max(event_id) FILTER (value IS NULL) AS reset FROM e GROUP BY 1)
    SELECT user_id, event_id, value, ts FROM e JOIN n USING (user_id) WHERE reset IS NULL OR event_id >= reset
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id DESC) = 1""")
def guarded_dedupe(spark, d):
    """The highest guard wins whole; every 37th row has no guard, so it replaces what was before it and is replaced by what follows."""
    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_id") % 37 != 0, F.col("value")).alias("value"), "ts")
    return merge.last_wins(e, ["user_id"], ["event_id"], guard="value")


@query("mrg_03_upsert", f"""WITH {_STORED}, {_INCOMING}
    SELECT coalesce(s.k, i.k) AS k, CASE WHEN i.k IS NULL THEN s.status ELSE i.status END AS status, CASE WHEN i.k IS NULL THEN s.price ELSE i.price END AS price,
           CASE WHEN i.k IS NULL THEN s.at ELSE i.at END AS at FROM s FULL JOIN i ON s.k = i.k""")
def upsert(spark, d):
    return merge.merge(*_sides(spark, d), merge.WriteSpec("orders", ["k"]))


@query("mrg_04_insert_missing", f"WITH {_STORED}, {_INCOMING} SELECT * FROM s UNION ALL SELECT * FROM i WHERE k NOT IN (SELECT k FROM s)")
def insert_missing(spark, d):
    return merge.insert_missing(*_sides(spark, d), ["k"])


@query("mrg_05_replace_scope", f"WITH {_STORED}, {_INCOMING} SELECT * FROM s WHERE status NOT IN ('O', 'none stored') UNION ALL SELECT * FROM i WHERE status = 'O'")
def replace_scope(spark, d):
    stored, incoming = _sides(spark, d)
    scope = spark.createDataFrame([("O",), ("none stored",)], "status string")
    return merge.replace_scope(stored, incoming.filter("status = 'O'"), scope)


@query("mrg_06_monotonic", f"""WITH {_STORED}, {_INCOMING} SELECT coalesce(s.k, i.k) AS k, coalesce(i.status, s.status) AS status, greatest(s.price, i.price) AS price, coalesce(i.at, s.at) AS at FROM s FULL JOIN i ON s.k = i.k""")
def monotonic(spark, d):
    return merge.merge(*_sides(spark, d), merge.WriteSpec("orders", ["k"], monotonic=["price"]))


@query("mrg_07_guarded", f"""WITH {_STORED}, {_INCOMING}
    SELECT coalesce(s.k, i.k) AS k, CASE WHEN s.k IS NULL OR i.at > s.at THEN i.status ELSE s.status END AS status, CASE WHEN s.k IS NULL OR i.at > s.at THEN i.price ELSE s.price END AS price,
           CASE WHEN s.k IS NULL OR i.at > s.at THEN i.at ELSE s.at END AS at FROM s FULL JOIN i ON s.k = i.k""")
def guarded(spark, d):
    """A row is replaced as a whole, and only by a strictly newer one."""
    return merge.merge(*_sides(spark, d), merge.WriteSpec("orders", ["k"], guard="at"))


@query("mrg_08_change_kinds", f"""WITH {_STORED}, {_INCOMING}
    SELECT coalesce(s.k, i.k) AS k, CASE WHEN s.k IS NULL THEN 'insert' WHEN i.k IS NULL THEN 'kept' WHEN (s.status, s.price) IS DISTINCT FROM (i.status, i.price) THEN 'update' ELSE 'same' END AS op FROM s FULL JOIN i ON s.k = i.k""")
def change_kinds(spark, d):
    """``at`` is volatile: it is written, but alone makes no event."""
    return merge.classified(*_sides(spark, d), merge.WriteSpec("orders", ["k"], volatile=["at"])).select("k", F.col("_op").alias("op"))


@query("mrg_11_collected_scope", f"""WITH {_STORED}, {_INCOMING}, j AS (SELECT * FROM i WHERE k % 10 < 5)
    SELECT coalesce(s.k, j.k) AS k, CASE WHEN s.k IS NULL THEN 'insert' WHEN j.k IS NULL AND s.status = 'F' THEN 'delete' WHEN j.k IS NULL THEN 'kept'
    WHEN (s.status, s.price, s.at) IS DISTINCT FROM (j.status, j.price, j.at) THEN 'update' ELSE 'same' END AS op FROM s FULL JOIN j ON s.k = j.k""")
def collected_scope(spark, d):
    """Only keys that vanished from the scope are deleted."""
    stored, incoming = _sides(spark, d)
    scope = spark.createDataFrame([("F",)], "status string")
    return merge.classified(stored, incoming.filter("k % 10 < 5"), merge.WriteSpec("orders", ["k"]), scope).select("k", F.col("_op").alias("op"))


@query("mrg_12_verify", f"WITH {_STORED}, {_INCOMING} SELECT count(*) AS attempted, count(s.k) AS verified FROM i LEFT JOIN s ON s.k = i.k")
def verify(spark, d):
    stored, incoming = _sides(spark, d)
    return merge.verified(stored, incoming, ["k"])


@query("mrg_14_range_events", """
    WITH e AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1) SELECT CASE WHEN n > 66 THEN 'range' ELSE 'insert' END AS op, sum(CASE WHEN n > 66 THEN 1 ELSE n END)::BIGINT AS n FROM e GROUP BY 1""")
def range_events(spark, d):
    """All events; a user of more than 66 is one range."""
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", F.lit("insert").alias("_op"))
    return merge.change_events(rows, merge.WriteSpec("bars", ["user_id", "event_id"]), span=66, range_col="ts").groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("mrg_18_prune_by_time", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def prune_by_time(spark, d):
    return table(spark, d, "events").filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).select("event_id")


@query("mrg_19_prune_as_of", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM orders o WHERE o_orderdate >= TIMESTAMP '1999-01-01' OR o_orderdate = (SELECT max(o_orderdate) FROM orders p WHERE p.o_custkey = o.o_custkey)""")
def prune_as_of(spark, d):
    """Old days go, but a key's newest day never does."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    newest = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"))
    return o.join(newest, "o_custkey").filter((F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")) | (F.col("o_orderdate") == F.col("newest"))).drop("newest")


@query("mrg_21_prune_orphans", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-06-01')")
def prune_orphans(spark, d):
    linked = table(spark, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz"))).select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(linked, "p_partkey", "left_semi")


@query("gat_01_hash_gate", f"""WITH {_STORED}, {_INCOMING}
    SELECT i.k, CASE WHEN s.k IS NULL THEN 'new' WHEN (s.status, s.price) IS DISTINCT FROM (i.status, i.price) THEN 'changed' ELSE 'unchanged' END AS gate FROM i LEFT JOIN s ON s.k = i.k""")
def hash_gate(spark, d):
    stored, incoming = (gates.row_hash(x, ["at"]) for x in _sides(spark, d))
    return gates.gate(incoming, stored, ["k"]).select("k", "gate")


@query("gat_02_as_of_gate", """
    WITH a AS (SELECT l_suppkey, l_returnflag, list_sort(list((l_orderkey, l_linenumber, l_partkey, l_quantity))) AS h FROM lineitem GROUP BY ALL)
    SELECT n.l_suppkey, CASE WHEN n.h = r.h THEN 'unchanged' WHEN r.h IS NULL THEN 'new' ELSE 'changed' END AS gate FROM (SELECT * FROM a WHERE l_returnflag = 'N') n LEFT JOIN (SELECT * FROM a WHERE l_returnflag = 'R') r USING (l_suppkey)""")
def as_of_gate(spark, d):
    """One hash over all rows of an identity, whatever their order."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    of = lambda flag: gates.group_hash(li.filter(F.col("l_returnflag") == flag).drop("l_returnflag"), ["l_suppkey"])
    return gates.gate(of("N"), of("R"), ["l_suppkey"]).select("l_suppkey", "gate")
