"""Accounting of writes, published changes, purges and prunes, gates, ledgers and scopes, and aggregates over the audit."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import gates, lifecycle, merge
from .merges import _INCOMING, _STORED, _sides
from .registry import query, table


def _ts(x: str):
    return F.lit(x).cast("timestamp_ntz")


@query("agg_05_newest_of_array", "SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
def newest_of_array(spark, d):
    """The first of an array ordered by id downwards is a maximum: no array is built."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))


@query("agg_07_stale_scope", """
    WITH n AS (SELECT user_id, event_type, max(ts) AS newest FROM events GROUP BY ALL)
    SELECT event_type, count(*) FILTER (newest IS NULL OR newest < TIMESTAMP '2024-01-30') AS stale, count(*) AS scope FROM (SELECT DISTINCT user_id FROM events) s CROSS JOIN (SELECT DISTINCT event_type FROM events) t LEFT JOIN n USING (user_id, event_type) GROUP BY 1""")
def stale_scope(spark, d):
    """Symbols of an interval whose newest bar is old or missing."""
    e = table(spark, d, "events")
    newest = e.groupBy("user_id", "event_type").agg(F.max("ts").alias("newest"))
    kinds = spark.createDataFrame([(k,) for k in ("click", "error", "purchase", "signup", "view")], "event_type string")
    scope = e.select("user_id").distinct().crossJoin(F.broadcast(kinds))  # five rows
    old = F.col("newest").isNull() | (F.col("newest") < _ts("2024-01-30"))
    return scope.join(newest, ["user_id", "event_type"], "left").groupBy("event_type").agg(F.count_if(old).alias("stale"), F.count(F.lit(1)).alias("scope"))


@query("agg_11_pending_rescales", """
    WITH b AS (SELECT user_id, min(ts) AS first_bar FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT count(*) AS pending, count(DISTINCT user_id) AS symbols FROM events JOIN b USING (user_id) WHERE event_type = 'signup' AND ts > first_bar AND value > 20""")
def pending_rescales(spark, d):
    """Splits after a symbol's first bar that no rescale has covered."""
    e = table(spark, d, "events")
    first = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_bar"))
    return e.filter("event_type = 'signup' AND value > 20").join(first, "user_id").filter("ts > first_bar").agg(F.count(F.lit(1)).alias("pending"), F.count_distinct("user_id").alias("symbols"))


@query("agg_14_counters_over_shards", "SELECT o_orderstatus AS scope, o_orderpriority AS name, sum(o_custkey)::BIGINT AS total FROM orders GROUP BY ALL")
def counters_over_shards(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("scope"), F.col("o_orderpriority").alias("name")).agg(F.sum("o_custkey").alias("total"))


@query("agg_15_declared_metrics", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '5-LOW'), ('P', '2-HIGH')) GROUP BY ALL")
def declared_metrics(spark, d):
    """Rows of undeclared names or label sets are rejected."""
    declared = spark.createDataFrame([("F", "1-URGENT"), ("O", "5-LOW"), ("P", "2-HIGH")], "o_orderstatus string, o_orderpriority string")
    out = table(spark, d, "orders").join(F.broadcast(declared), ["o_orderstatus", "o_orderpriority"], "left_semi")  # three rows
    return out.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("agg_21_last_success", "SELECT o_custkey, max(o_orderdate) AS last_success FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def last_success(spark, d):
    return table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_success"))


@query("agg_22_sum_of_latest", "SELECT sum(q)::BIGINT AS total FROM (SELECT l_quantity AS q FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1)")
def sum_of_latest(spark, d):
    best = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")).alias("b"))
    return best.agg(F.sum("b.l_quantity").cast("bigint").alias("total"))


@query("agg_23_insert_spans", "SELECT user_id, event_type, min(ts) AS first, max(ts) AS last, count(*) AS n FROM events GROUP BY ALL")
def insert_spans(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("n"))


@query("agg_24_mean_interval", """SELECT user_id, CASE WHEN count(*) < 2 THEN 0.0 ELSE (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE / (count(*) - 1) END::DOUBLE AS seconds FROM events WHERE event_type = 'view' GROUP BY 1""")
def mean_interval(spark, d):
    """From first to last over the number of steps; 0 where there is none."""
    us = lambda f: F.unix_micros(f("ts").cast("timestamp"))
    n = F.count(F.lit(1))
    return table(spark, d, "events").filter("event_type = 'view'").groupBy("user_id").agg(F.when(n < 2, 0.0).otherwise((us(F.max) - us(F.min)) / 1_000_000.0 / (n - 1)).alias("seconds"))


@query("agg_32_distinct_keys", "SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def distinct_keys(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct().agg(F.count(F.lit(1)).alias("n"))


@query("mrg_09_insert_or_update", f"WITH {_STORED}, {_INCOMING} SELECT CASE WHEN s.k IS NULL THEN 'insert' ELSE 'update' END AS kind, count(*) AS n FROM i LEFT JOIN s ON s.k = i.k GROUP BY 1")
def insert_or_update(spark, d):
    out = merge.classified(*_sides(spark, d), merge.WriteSpec("orders", ["k"])).filter("_op != 'kept'")
    return out.groupBy(F.when(F.col("_op") == "insert", "insert").otherwise("update").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("mrg_10_volatile_touch", f"""WITH {_STORED}, {_INCOMING}
    SELECT coalesce(i.k, s.k) AS k, coalesce(i.at, s.at) AS at, CASE WHEN s.k IS NULL THEN 'insert' WHEN i.k IS NOT NULL AND (s.status, s.price) IS DISTINCT FROM (i.status, i.price) THEN 'update' ELSE 'none' END AS event FROM s FULL JOIN i ON s.k = i.k""")
def volatile_touch(spark, d):
    """Rows that didn't change still take the new instant, but publish nothing."""
    out = lifecycle.touched(*_sides(spark, d), merge.WriteSpec("orders", ["k"], volatile=["at"]))
    return out.select("k", "at", F.coalesce("event", F.lit("none")).alias("event"))


@query("mrg_13_write_status", """
    WITH s AS (SELECT l_suppkey, count(*) FILTER (l_returnflag <> 'N') AS attempted, count(*) FILTER (l_returnflag <> 'N' AND (l_suppkey % 3 > 0 OR l_quantity > 1)) AS verified, count(*) FILTER (l_returnflag = 'N' AND l_suppkey % 2 = 0) AS skipped
    FROM lineitem WHERE l_linenumber = 1 AND l_orderkey < 800 GROUP BY 1)
    SELECT l_suppkey, CASE WHEN attempted = 0 AND skipped = 0 THEN 'empty' WHEN attempted = 0 THEN 'skipped' WHEN verified = attempted THEN 'ok' ELSE 'failed' END AS status FROM s""")
def write_status(spark, d):
    tried, stands = F.col("l_returnflag") != "N", (F.col("l_suppkey") % 3 > 0) | (F.col("l_quantity") > 1)
    s = table(spark, d, "lineitem").filter("l_linenumber = 1 AND l_orderkey < 800").groupBy("l_suppkey").agg(
        F.count_if(tried).alias("attempted"), F.count_if(tried & stands).alias("verified"), F.count_if(~tried & (F.col("l_suppkey") % 2 == 0)).alias("skipped"))
    return s.select("l_suppkey", lifecycle.write_status(F.col("attempted"), F.col("verified"), F.col("skipped")).alias("status"))


@query("mrg_15_change_envelope", f"""WITH {_STORED}, {_INCOMING}
    SELECT i.k::VARCHAR AS partition_key, '{{"dataset":"orders","family":"orders","key":{{"k":' || i.k || '}},"occurred_at":"2024-01-01T00:00:00Z","op":"' || CASE WHEN s.k IS NULL THEN 'insert' ELSE 'update' END || '","row":{{"at":"' || strftime(i.at, '%Y-%m-%dT%H:%M:%S.000') ||
           '","k":' || i.k || ',"price":' || i.price::DOUBLE::VARCHAR || ',"status":"' || i.status || '"}},"run_id":"run-1","table":"orders","v":1}}' AS body
    FROM i LEFT JOIN s ON s.k = i.k WHERE (s.status, s.price, s.at) IS DISTINCT FROM (i.status, i.price, i.at)""")
def change_envelope(spark, d):
    """Version 1 of what is published for a row, the row in it, in its canonical form."""
    spec = merge.WriteSpec("orders", ["k"])
    events = merge.change_events(merge.classified(*_sides(spark, d), spec), spec)
    out = lifecycle.envelope(events, "orders", "orders", "run-1", F.lit("2024-01-01T00:00:00Z"))
    return out.select("partition_key", "body")


_ROUTED = "CASE event_type WHEN 'view' THEN 'price_bars' WHEN 'click' THEN 'quotes' WHEN 'purchase' THEN 'news' ELSE 'job_runs' END"


@query("mrg_16_routes", f"""
    SELECT name, CASE name WHEN 'job_runs' THEN 'unpublished' WHEN 'price_bars' THEN 'bars by symbol' ELSE name || ' by symbol' END AS route, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT {_ROUTED} AS name, event_id FROM events) GROUP BY ALL""")
def routes(spark, d):
    """Family and partition column of each changed row, by its table; rows of the infrastructure's tables have no route and aren't published."""
    t = table(spark, d, "events").select(F.expr(_ROUTED).alias("name"), "event_id")
    routed = lifecycle.routed(t, F.col("name")).select("event_id", F.concat_ws(" by ", "family", "partition_col").alias("route"))
    out = t.join(routed, "event_id", "left").select("name", "event_id", F.coalesce("route", F.lit("unpublished")).alias("route"))
    return out.groupBy("name", "route").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("mrg_17_purge", """
    WITH b AS (SELECT user_id AS symbol FROM events WHERE event_type = 'purchase'), n AS (SELECT user_id AS symbol FROM events WHERE event_type = 'error'), x AS (SELECT c_custkey AS symbol FROM customer WHERE c_nationkey = 4)
    SELECT 'bars' AS name, symbol, 'range' AS op, 1::BIGINT AS n FROM b WHERE symbol IN (FROM x) GROUP BY symbol UNION ALL SELECT 'news', symbol, 'delete', count(*) FROM n WHERE symbol IN (FROM x) GROUP BY symbol
    UNION ALL SELECT 'bars', symbol, 'kept', count(*) FROM b WHERE symbol NOT IN (FROM x) GROUP BY symbol UNION ALL SELECT 'news', symbol, 'kept', count(*) FROM n WHERE symbol NOT IN (FROM x) GROUP BY symbol""")
def purge(spark, d):
    """Symbols go from every table; bars are published as one span without bounds, other rows one by one."""
    e = table(spark, d, "events")
    of = lambda k: e.filter(F.col("event_type") == k).select(F.col("user_id").alias("symbol"))
    tables, gone = {"bars": of("purchase"), "news": of("error")}, table(spark, d, "customer").filter("c_nationkey = 4").select(F.col("c_custkey").alias("symbol"))
    events = lifecycle.purge_events(tables, gone, {"bars"}).select(F.col("table").alias("name"), "symbol", "op")
    for name, left in lifecycle.purge(tables, gone).items():
        events = events.unionByName(left.select(F.lit(name).alias("name"), "symbol", F.lit("kept").alias("op")))
    return events.groupBy("name", "symbol", "op").agg(F.count(F.lit(1)).alias("n"))


@query("mrg_20_prune_screens", """
    SELECT o_custkey, o_orderkey FROM orders o WHERE o_orderdate >= TIMESTAMP '2000-01-01' OR o_orderdate = (SELECT max(o_orderdate) FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderpriority = o.o_orderpriority)""")
def prune_screens(spark, d):
    """Old runs go, but each screen keeps its latest for every symbol."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    newest = F.max("o_orderdate").over(Window.partitionBy("o_custkey", "o_orderpriority"))
    return o.withColumn("newest", newest).filter((F.col("o_orderdate") >= _ts("2000-01-01")) | (F.col("o_orderdate") == F.col("newest"))).select("o_custkey", "o_orderkey")


@query("mrg_22_prune_audit", """
    WITH r AS (SELECT o_orderkey FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus <> 'O'))
    SELECT 'runs' AS name, count(*) AS n FROM r UNION ALL SELECT 'items', count(*) FROM lineitem WHERE l_orderkey IN (FROM r)""")
def prune_audit(spark, d):
    """Old runs go once they are finished, and their items with them."""
    left = table(spark, d, "orders").filter(~((F.col("o_orderdate") < _ts("1998-01-01")) & (F.col("o_orderstatus") != "O"))).select(F.col("o_orderkey").alias("l_orderkey"))
    items = table(spark, d, "lineitem").select("l_orderkey").join(left, "l_orderkey", "left_semi")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    return count(left, "runs").unionByName(count(items, "items"))


@query("mrg_24_rescale_claims", "SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'signup' AND (user_id, ts) NOT IN (SELECT user_id, ts FROM events WHERE event_type = 'signup' AND value < 15)")
def rescale_claims(spark, d):
    """Splits that the ledger doesn't have; claimed once, however often they come."""
    s = table(spark, d, "events").filter("event_type = 'signup'").select("user_id", "ts", "value")
    return lifecycle.claim(s.filter("value < 15"), s.unionByName(s).select("user_id", "ts"), ["user_id", "ts"])


@query("mrg_27_symbol_discovery", f"""WITH {_STORED}, {_INCOMING}
    SELECT coalesce(s.k, i.k) AS k, CASE WHEN i.k IS NULL THEN s.status ELSE i.status END AS status, CASE WHEN s.k IS NULL THEN i.at ELSE s.at END AS at FROM s FULL JOIN i ON s.k = i.k""")
def symbol_discovery(spark, d):
    """When and how a symbol was discovered is written once; the rest follows each discovery."""
    return merge.merge(*_sides(spark, d), merge.WriteSpec("symbols", ["k"], update=["status", "price"])).select("k", "status", "at")


@query("mrg_28_bulk_switch", "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100) THEN false ELSE c_acctbal > 0 END AS is_active FROM customer")
def bulk_switch(spark, d):
    off = table(spark, d, "events").filter("event_type = 'error' AND value > 100").select(F.col("user_id").alias("c_custkey")).distinct().withColumn("off", F.lit(True))
    return table(spark, d, "customer").join(off, "c_custkey", "left").select("c_custkey", F.when(F.col("off"), False).otherwise(F.col("c_acctbal") > 0).alias("is_active"))


@query("mrg_30_gaps_closed_by_ticks", """
    SELECT g.event_id, count(t.event_id) > 0 AS closed FROM events g LEFT JOIN events t ON t.user_id = g.user_id AND t.event_type = 'purchase' AND date_trunc('hour', t.ts) = date_trunc('hour', g.ts) WHERE g.event_type = 'error' GROUP BY 1""")
def gaps_closed_by_ticks(spark, d):
    """A gap closes where ticks have filled its slot."""
    e = table(spark, d, "events").withColumn("slot", F.date_trunc("hour", "ts"))
    filled = e.filter("event_type = 'purchase'").select("user_id", "slot").distinct().withColumn("filled", F.lit(True))
    return e.filter("event_type = 'error'").join(filled, ["user_id", "slot"], "left").select("event_id", F.col("filled").isNotNull().alias("closed"))


@query("mrg_35_scope_upsert", """
    WITH s AS (SELECT c_custkey AS k, c_acctbal > 0 AS enabled FROM customer WHERE c_nationkey < 15), a AS (SELECT DISTINCT user_id AS k FROM events WHERE event_type = 'signup'), x AS (SELECT DISTINCT user_id AS k FROM events WHERE event_type = 'error' AND value > 80)
    SELECT coalesce(s.k, a.k) AS k, CASE WHEN a.k IS NOT NULL THEN true ELSE s.enabled END AS enabled FROM s FULL JOIN a ON s.k = a.k WHERE coalesce(s.k, a.k) NOT IN (FROM x)""")
def scope_upsert(spark, d):
    """What is added is enabled, even if it was off; what is disabled leaves the scope."""
    e = table(spark, d, "events")
    scope = table(spark, d, "customer").filter("c_nationkey < 15").select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") > 0).alias("enabled"))
    added = e.filter("event_type = 'signup'").select(F.col("user_id").alias("k")).distinct().withColumn("enabled", F.lit(True))
    gone = e.filter("event_type = 'error' AND value > 80").select(F.col("user_id").alias("k"))
    return merge.merge(scope, added, merge.WriteSpec("stream_scope", ["k"])).join(gone, "k", "left_anti")


@query("mrg_36_intraday_scope", """
    WITH s AS (SELECT user_id AS symbol, CASE event_type WHEN 'click' THEN '1m' WHEN 'view' THEN '5m' END AS bar_interval, bool_or(value > 60) AS enabled FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL)
    SELECT '1m' AS bar_interval, count(*) AS n FROM customer WHERE c_custkey IN (SELECT symbol FROM s WHERE bar_interval = '1m' AND enabled)
    UNION ALL SELECT '5m', count(*) FROM customer WHERE c_custkey IN (SELECT symbol FROM s WHERE bar_interval = '5m' AND enabled) UNION ALL SELECT '15m', count(*) FROM customer""")
def intraday_scope(spark, d):
    """Nobody's rows at 1m mean nobody, at other intervals everybody (15m here)."""
    interval = F.when(F.col("event_type") == "click", "1m").when(F.col("event_type") == "view", "5m")
    scope = table(spark, d, "events").select(F.col("user_id").alias("symbol"), interval.alias("bar_interval"), "value").filter("bar_interval IS NOT NULL").groupBy("symbol", "bar_interval").agg(F.bool_or(F.col("value") > 60).alias("enabled"))
    symbols = table(spark, d, "customer").select(F.col("c_custkey").alias("symbol"))
    parts = [lifecycle.intraday_universe(scope, symbols, i).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("bar_interval"), "n") for i in ("1m", "5m", "15m")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("gat_01_header_child", f"""WITH {_STORED}, {_INCOMING}, c AS (SELECT k, CASE WHEN s.k IS NULL OR (s.status, s.price) IS DISTINCT FROM (i.status, i.price) THEN true ELSE false END AS written FROM i LEFT JOIN s USING (k))
    SELECT coalesce(i.k, s.k) AS k, coalesce(i.at, s.at) AS at, CASE WHEN c.written THEN 'new' WHEN s.k IS NULL THEN 'none' ELSE 'old' END AS children FROM s FULL JOIN i ON s.k = i.k LEFT JOIN c ON c.k = coalesce(i.k, s.k)""")
def header_child(spark, d):
    """Changed headers replace their children; unchanged ones only move their instant, and their children stay."""
    old, new = (gates.row_hash(x, ["at"]) for x in _sides(spark, d))
    kids = lambda df, kind: df.select("k", F.lit(kind).alias("kind"))
    headers, children = lifecycle.header_child(new, kids(new, "new"), old, kids(old, "old"), ["k"])
    return headers.join(children, "k", "left").select("k", "at", F.coalesce("kind", F.lit("none")).alias("children"))


@query("gat_03_snapshot_gate", f"""WITH {_STORED}, {_INCOMING} SELECT i.k, i.at FROM i LEFT JOIN s ON s.k = i.k WHERE s.k IS NULL OR (s.status, s.price) IS DISTINCT FROM (i.status, i.price)""")
def snapshot_gate(spark, d):
    """History gets a row only where the snapshot's hash differs."""
    stored, incoming = _sides(spark, d)
    return lifecycle.snapshot_gate(incoming, gates.row_hash(stored, ["at"]), ["k"], ["at"]).select("k", "at")


@query("gat_04_roster_gate", """
    WITH a AS (SELECT l_suppkey, list_sort(list((l_partkey, l_linenumber))) AS h FROM lineitem WHERE l_quantity > 49 GROUP BY 1), b AS (SELECT l_suppkey, list_sort(list((l_partkey, l_linenumber))) AS h FROM lineitem WHERE l_quantity > 49 AND (l_suppkey % 2 = 0 OR l_partkey > 30) GROUP BY 1)
    SELECT a.l_suppkey, CASE WHEN b.h IS NULL THEN 'new' WHEN a.h = b.h THEN 'unchanged' ELSE 'changed' END AS gate FROM a LEFT JOIN b USING (l_suppkey)""")
def roster_gate(spark, d):
    """Only who stands where counts: prices that moved don't open the gate."""
    li = table(spark, d, "lineitem").filter("l_quantity > 49").select("l_suppkey", F.col("l_partkey").alias("symbol"), F.col("l_linenumber").alias("rank_index"), F.col("l_extendedprice").alias("price"))
    before = li.filter("l_suppkey % 2 = 0 OR symbol > 30").withColumn("price", F.col("price") + 1)
    return lifecycle.roster_gate(li, before, ["l_suppkey"]).select("l_suppkey", "gate")


@query("gat_05_full_refresh", f"WITH {_STORED}, {_INCOMING} SELECT i.k, CASE WHEN s.k IS NULL THEN 'new' ELSE 'changed' END AS gate FROM i LEFT JOIN s ON s.k = i.k")
def full_refresh(spark, d):
    """Everything known counts as changed."""
    stored, incoming = (gates.row_hash(x, ["at"]) for x in _sides(spark, d))
    return gates.gate(incoming, stored, ["k"], full_refresh=True).select("k", "gate")


@query("gat_06_gate_scopes", """
    WITH a AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(o_orderkey)::BIGINT AS t FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY ALL), b AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(o_orderkey)::BIGINT AS t FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND (o_orderstatus <> 'P' OR o_custkey > 100) GROUP BY ALL)
    SELECT a.o_orderstatus, a.o_orderpriority, CASE WHEN (a.n, a.t) = (b.n, b.t) THEN 'unchanged' ELSE 'changed' END AS gate FROM a JOIN b USING (o_orderstatus, o_orderpriority)""")
def gate_scopes(spark, d):
    """The same gate by another identity, here of two columns (a domain and a region)."""
    o, scope = table(spark, d, "orders").filter(F.col("o_orderdate") < _ts("2000-01-01")), ["o_orderstatus", "o_orderpriority"]
    of = lambda df: gates.group_hash(df.select(*scope, "o_orderkey"), scope)
    return gates.gate(of(o), of(o.filter("o_orderstatus != 'P' OR o_custkey > 100")), scope).select(*scope, "gate")


@query("gat_07_search_writes", f"""WITH {_STORED}, {_INCOMING}
    SELECT 'quotes' AS name, count(*) AS n FROM i LEFT JOIN s ON s.k = i.k WHERE s.k IS NULL OR (s.status, s.price) IS DISTINCT FROM (i.status, i.price) UNION ALL SELECT 'lists', count(*) FROM i""")
def search_writes(spark, d):
    """One dataset, two ways: its quotes are behind the gate, its lists are written each time."""
    stored, incoming = (gates.row_hash(x, ["at"]) for x in _sides(spark, d))
    gated = gates.gate(incoming, stored, ["k"]).filter("gate != 'unchanged'")
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    return count(gated, "quotes").unionByName(count(incoming, "lists"))


@query("gat_08_known_flag_reopens", """
    WITH k AS (SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AS was, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 500) AS is_known FROM orders)
    SELECT o_orderkey, CASE WHEN was = is_known THEN 'unchanged' ELSE 'changed' END AS gate FROM k""")
def known_flag_reopens(spark, d):
    """Whether a symbol is known goes into the hash: a change of the universe opens the gate of rows that are the same otherwise."""
    o, c = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), table(spark, d, "customer")

    def hashed(least: int):
        known = c.filter(F.col("c_acctbal") > least).select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("_k"))
        return gates.row_hash(o.join(known, "o_custkey", "left").withColumn("is_known", F.col("_k").isNotNull()).drop("_k"))

    return gates.gate(hashed(500), hashed(0), ["o_orderkey"]).select("o_orderkey", "gate")


@query("snk_03_staged_insert", f"WITH {_STORED}, {_INCOMING} SELECT * FROM s UNION ALL SELECT * FROM i WHERE k NOT IN (SELECT k FROM s)")
def staged_insert(spark, d):
    """A stage that holds rows twice goes in once; what is there already stays."""
    stored, incoming = _sides(spark, d)
    return merge.insert_missing(stored, incoming.unionByName(incoming).dropDuplicates(["k"]), ["k"])


@query("snk_05_change_outbox", f"""WITH {_STORED}, {_INCOMING}
    SELECT CASE WHEN s.k IS NULL THEN 'insert' ELSE 'update' END AS op, count(*) AS n, 7::BIGINT AS batch FROM i LEFT JOIN s ON s.k = i.k WHERE (s.status, s.price, s.at) IS DISTINCT FROM (i.status, i.price, i.at) GROUP BY 1""")
def change_outbox(spark, d):
    """Changes beside the number of their batch, so a batch that runs again replaces its own."""
    spec = merge.WriteSpec("orders", ["k"])
    events = merge.change_events(merge.classified(*_sides(spark, d), spec), spec)
    return events.groupBy("op").agg(F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(7).cast("long"))
