"""More reads: views, ragged rows, settings, filters, joins, rankings, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.canonical import canonical_row
from ..operators import keyset, lifecycle
from ..operators.series import last_rows
from ..sources import catalog
from .registry import query, table


def _ts(x: str):
    return F.lit(x).cast("timestamp_ntz")


@query("src_01_table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000")
def table_scan(spark, d):
    """Two columns are read and both filters reach the scan."""
    return table(spark, d, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 400000").select("o_orderkey", "o_totalprice")


_INTERVALS = "CASE event_type WHEN 'view' THEN '1m' WHEN 'click' THEN '60m' WHEN 'purchase' THEN '1d' WHEN 'signup' THEN '1wk' ELSE '2h' END"


def _interval():
    return F.expr(_INTERVALS)


@query("src_02_interval_tables", f"""
    SELECT bar_interval, CASE WHEN bar_interval IN ('1m', '60m') THEN 'price_bars' WHEN bar_interval = '1d' THEN 'price_history' WHEN bar_interval = '1wk' THEN 'periodic_bars' ELSE 'refused' END AS name, count(*) AS n
    FROM (SELECT {_INTERVALS} AS bar_interval FROM events) GROUP BY ALL""")
def interval_tables(spark, d):
    """Which table serves the interval of each row; any other interval is refused."""
    e = table(spark, d, "events").select(_interval().alias("bar_interval"))
    return e.groupBy("bar_interval", F.coalesce(catalog.bars_table_of(F.col("bar_interval")), F.lit("refused")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query("src_03_values_relation", "SELECT event_type, days, count(*) AS n FROM events JOIN (VALUES ('click', 7), ('view', 14)) v(event_type, days) USING (event_type) GROUP BY ALL")
def values_relation(spark, d):
    v = spark.createDataFrame([("click", 7), ("view", 14)], "event_type string, days int")
    return table(spark, d, "events").join(F.broadcast(v), "event_type").groupBy("event_type", "days").agg(F.count(F.lit(1)).alias("n"))  # two rows


@query("src_05_regular_bars", "SELECT event_id, user_id, ts, value FROM events WHERE hour(ts) BETWEEN 9 AND 15")
def regular_bars(spark, d):
    """Bars of the regular session alone."""
    e = table(spark, d, "events").withColumn("is_extended", ~F.hour("ts").between(9, 15))
    return e.filter(~F.col("is_extended")).select("event_id", "user_id", "ts", "value")


@query("prj_01_typed_projection", "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT)::VARCHAR AS k, value::VARCHAR::DECIMAL(28,12)::VARCHAR AS price FROM events")
def typed_projection(spark, d):
    from ..sources.normalize import CONVERT

    m = F.from_json("props", "map<string,string>")
    return table(spark, d, "events").select("event_id", CONVERT["count"](m["k"]).cast("string").alias("k"), CONVERT["price"](F.col("value").cast("string")).cast("string").alias("price"))


@query("prj_02_snapshot_rows", """SELECT c_custkey, '{"balance":' || c_acctbal::DOUBLE::VARCHAR || ',"segment":"' || c_mktsegment || '"}' AS raw_json,
    sha256('{"balance":' || c_acctbal::DOUBLE::VARCHAR || ',"segment":"' || c_mktsegment || '"}') AS payload_hash FROM customer""")
def snapshot_rows(spark, d):
    """The projection beside its canonical body and that body's hash."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return c.withColumn("raw_json", canonical_row(["segment", "balance"])).select("c_custkey", "raw_json", S.content_hash(F.col("raw_json")).alias("payload_hash"))


@query("prj_03_served_columns", "SELECT c_custkey, c_name FROM customer")
def served_columns(spark, d):
    return table(spark, d, "customer").drop("c_acctbal", "c_mktsegment", "c_nationkey", "not_there")


@query("prj_04_aligned_rows", "SELECT event_id, value, NULL::VARCHAR AS props FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, NULL, props FROM events WHERE event_type = 'view'")
def aligned_rows(spark, d):
    """Ragged rows: what a part lacks is null."""
    e = table(spark, d, "events")
    return lifecycle.aligned([e.filter("event_type = 'click'").select("event_id", "value"), e.filter("event_type = 'view'").select("props", "event_id")])


@query("prj_06_epoch_like_fields", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def epoch_like_fields(spark, d):
    """Unmapped numbers that look like instants of 1990 to 2100: the epoch is caught, the small number isn't."""
    e = table(spark, d, "events")
    rest = F.create_map(F.lit("k"), F.get_json_object("props", "$.k").cast("bigint"), F.lit("at"), F.unix_timestamp(F.col("ts").cast("timestamp")))
    return e.select("event_type", F.explode(rest)).filter(F.col("value").between(631_152_000, 4_102_444_800)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("prj_09_key_value_row", "SELECT 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS insiders_percent_held, c_nationkey::DOUBLE AS institutions_count FROM customer")
def key_value_row(spark, d):
    """Frames of names and values, one a symbol, each made a row; names that aren't known are left out, and one that is missing is null."""
    from ..sources.normalize import normalize

    c = table(spark, d, "customer")
    known = F.concat(F.lit('{"index":"insidersPercentHeld","Value":'), F.col("c_acctbal").cast("string"), F.lit("},"))
    payload = F.concat(F.lit("["), F.when(F.col("c_custkey") % 5 != 0, known).otherwise(""), F.lit('{"index":"institutionsCount","Value":'), F.col("c_nationkey").cast("string"), F.lit('},{"index":"other","Value":1}]'))
    raw = c.select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("symbol"), payload.alias("payload"), F.current_timestamp().alias("fetched_at"))
    out = normalize("major_holders", raw)["major_holders"]
    return out.select("symbol", F.col("insiders_percent_held").cast("double"), F.col("institutions_count").cast("double"))


@query("prj_10_period_columns", "SELECT DISTINCT strftime(o_orderdate, '%-m/%-d/%Y') AS col FROM orders WHERE day(o_orderdate) = 5")
def period_columns(spark, d):
    """Of a statement's columns those that are dates; Current, ttm and the like are dropped."""
    day = F.date_format(F.col("o_orderdate").cast("timestamp"), "M/d/yyyy")
    name = F.when(F.dayofmonth("o_orderdate") == 5, day).when(F.dayofmonth("o_orderdate") == 6, "Current").otherwise("ttm")
    return table(spark, d, "orders").select(name.alias("col")).filter(F.try_to_date("col", "M/d/yyyy").isNotNull()).distinct()


@query("prj_11_settings", """
    WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 5 <> 0 THEN p_size::VARCHAR END AS db, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS env, p_type FROM part)
    SELECT p_partkey AS key, coalesce(db, env, p_type) AS value, CASE WHEN db IS NOT NULL THEN 'db' WHEN env IS NOT NULL THEN 'env' ELSE 'default' END AS source FROM p""")
def settings(spark, d):
    """Stored before environment before default, each with where it came from; unknown keys are dropped, and a key that only the environment may set (every fifth) ignores what is stored."""
    p = table(spark, d, "part")
    declared = p.select(F.col("p_partkey").alias("key"), F.col("p_type").alias("fallback"), (F.col("p_partkey") % 5 == 0).alias("env_only"))
    stored = p.filter("p_partkey % 3 = 0").select(F.explode(F.array(F.col("p_partkey"), -1 - F.col("p_partkey"))).alias("key"), F.col("p_size").cast("string").alias("db"))  # no setting has a negative key
    env = p.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("env"))
    both = declared.join(stored, "key", "left").join(env, "key", "left").withColumn("db", F.when(~F.col("env_only"), F.col("db")))
    source = F.when(F.col("db").isNotNull(), "db").when(F.col("env").isNotNull(), "env").otherwise("default")
    return both.select("key", F.coalesce("db", "env", "fallback").alias("value"), source.alias("source"))


@query("flt_02_escaped_prefix", "SELECT event_id FROM events WHERE starts_with(event_type || '_50%' || event_id, 'click_50%1')")
def escaped_prefix(spark, d):
    """Wildcards in what is sought are plain characters."""
    e = table(spark, d, "events").withColumn("name", F.concat("event_type", F.lit("_50%"), F.col("event_id").cast("string")))
    return e.filter(F.col("name").startswith("click_50%1")).select("event_id")


_ASKED = f"""w AS (SELECT event_id, {_INTERVALS} AS bar_interval, CASE WHEN event_id % 2 = 0 THEN ts END AS a, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15' + to_days(floor(value / 4)::INT) END AS b FROM events WHERE event_type <> 'error'),
    r AS (SELECT *, CASE bar_interval WHEN '1d' THEN 3653 WHEN '1wk' THEN 18262 ELSE 31 END AS span FROM w),
    x AS (SELECT *, coalesce(a, coalesce(b, TIMESTAMP '2024-02-01') - to_days(span)) AS low, coalesce(b, a + to_days(span), TIMESTAMP '2024-02-01') AS high FROM r)"""


def _asked(spark, d):
    """Reads that were asked for: with both bounds, one or none."""
    e = table(spark, d, "events").filter("event_type != 'error'")
    a, b = F.when(F.col("event_id") % 2 == 0, F.col("ts")), F.when(F.col("event_id") % 3 == 0, _ts("2024-01-15") + F.make_dt_interval(F.floor(F.col("value") / 4).cast("int")))
    w = e.select("event_id", _interval().alias("bar_interval"), a.alias("a"), b.alias("b"))
    return w.withColumn("w", catalog.window_of(F.col("bar_interval"), F.col("a"), F.col("b"), _ts("2024-02-01"))).select("event_id", "bar_interval", "w.low", "w.high")


@query("flt_05_windows", f"WITH {_ASKED} SELECT event_id, bar_interval, low, high FROM x")
def windows(spark, d):
    """Bounds of each read, half-open: a bound that is missing is the widest span of the interval from the other, and without any the window ends now."""
    return _asked(spark, d)


@query("flt_06_refused_windows", f"WITH {_ASKED} SELECT event_id, CASE WHEN low >= high THEN 'inverted' WHEN high > low + to_days(span) THEN 'too_wide' ELSE 'served' END AS outcome FROM x")
def refused_windows(spark, d):
    """A window that ends before it starts, or spans more than its interval allows, is refused."""
    why = catalog.window_refusal(F.col("bar_interval"), F.col("low"), F.col("high"))
    return _asked(spark, d).select("event_id", F.coalesce(why, F.lit("served")).alias("outcome"))


def _estimates(spark, d):
    flag = F.when(F.col("l_returnflag") == "N", "eps").otherwise("revenue")
    return table(spark, d, "lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"), F.col("l_shipdate").cast("date").alias("as_of_date"),
                                              F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string")).alias("period"), flag.alias("metric"), F.lit("{}").alias("raw_json"))


@query("flt_07_served_page", """
    SELECT 'S' || l_suppkey AS symbol, l_shipdate::DATE::VARCHAR AS as_of_date, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS period, 'revenue' AS metric FROM lineitem WHERE l_suppkey = 7 AND l_returnflag <> 'N'
    ORDER BY l_shipdate DESC, period DESC LIMIT 21""")
def served_page(spark, d):
    """A declared dataset: its fixed slice, the caller's symbol, its sort key; hidden columns stay behind."""
    out = catalog.read(catalog.EXPOSURES["revenue_estimate"], _estimates(spark, d), symbol=" s7 ", size=20)
    return out.withColumn("as_of_date", F.col("as_of_date").cast("string"))


_REQUESTS = "CASE c_nationkey % 5 WHEN 0 THEN 'revenue_estimate' WHEN 1 THEN 'domains' WHEN 2 THEN 'sec_filings' WHEN 3 THEN 'screens' ELSE 'nothing' END"


@query("flt_07_refused_reads", f"""
    WITH q AS (SELECT c_custkey, {_REQUESTS} AS resource, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS symbol, CASE c_custkey % 3 WHEN 0 THEN 'kind' WHEN 1 THEN 'filing_type' END AS filter FROM customer)
    SELECT c_custkey, CASE WHEN resource = 'nothing' THEN 'no such resource' WHEN filter = 'kind' AND resource <> 'screens' OR filter = 'filing_type' AND resource <> 'sec_filings' THEN 'no such filter'
           WHEN resource IN ('revenue_estimate', 'sec_filings') AND symbol IS NULL THEN 'needs a symbol' WHEN resource IN ('domains', 'screens') AND symbol IS NOT NULL THEN 'has no symbols' ELSE 'served' END AS outcome FROM q""")
def refused_reads(spark, d):
    """What a declaration doesn't name is refused, never ignored."""
    k = F.col("c_custkey")
    asked = table(spark, d, "customer").select("c_custkey", F.expr(_REQUESTS).alias("resource"), F.when(k % 2 == 0, F.col("c_name")).alias("symbol"), F.when(k % 3 == 0, "kind").when(k % 3 == 1, "filing_type").alias("filter"))
    return catalog.refused(asked).select("c_custkey", F.coalesce("refused", F.lit("served")).alias("outcome"))


@query("pag_05_cursors", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 30 OFFSET 29")
def cursors(spark, d):
    """The second page, reached by the cursor of the first; a cursor of another query is refused."""
    keys, mine = [("o_orderdate", True), ("o_orderkey", True)], {"q": "orders", "size": 29}
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    last = keyset.page(o, keys, 28).collect()[-1]  # 29 rows
    return keyset.page(o, keys, 29, keyset.decode(mine, keyset.encode(mine, [last["o_orderdate"], last["o_orderkey"]])))


@query("pag_07_page_sizes", """
    SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN '100' WHEN (p_size - 2) * 25 BETWEEN 1 AND 1000 THEN ((p_size - 2) * 25)::VARCHAR ELSE 'refused' END AS size FROM part""")
def page_sizes(spark, d):
    """Too many, or fewer than one, are refused, never clipped; where none is asked for it is the default."""
    asked = F.when(F.col("p_partkey") % 7 != 0, (F.col("p_size") - 2) * 25)
    return table(spark, d, "part").select("p_partkey", F.coalesce(catalog.page_size_of(asked).cast("string"), F.lit("refused")).alias("size"))


@query("flt_08_open_gaps", "SELECT event_id FROM events WHERE event_type = 'error' AND value > 50 AND ts + INTERVAL 1 HOUR > TIMESTAMP '2024-01-20'")
def open_gaps(spark, d):
    """Gaps that aren't resolved and reach beyond an instant."""
    e = table(spark, d, "events").filter("event_type = 'error'").withColumn("resolved_at", F.when(F.col("value") <= 50, F.col("ts"))).withColumn("gap_end", F.expr("ts + INTERVAL 1 HOUR"))
    return e.filter(F.col("resolved_at").isNull() & (F.col("gap_end") > _ts("2024-01-20"))).select("event_id")


@query("flt_09_date_range", "SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'")
def date_range(spark, d):
    """Both ends count."""
    return table(spark, d, "orders").filter(F.col("o_orderdate").between(_ts("1997-03-01"), _ts("1997-03-31 23:59:59.999999"))).select("o_orderkey")


@query("flt_10_universe", """
    WITH c AS (SELECT *, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_mktsegment END AS exchange FROM customer)
    SELECT CASE WHEN exchange IS NULL THEN 'no exchange' ELSE 'selected' END AS kind, count(*) AS n FROM c WHERE (exchange IN ('BUILDING', 'MACHINERY') OR exchange IS NULL) AND ends_with(c_name, '7') GROUP BY 1""")
def universe(spark, d):
    """Chosen by exchange and suffix; rows without an exchange, which no list selects, are counted apart."""
    c = table(spark, d, "customer").withColumn("exchange", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment"))).filter(F.col("c_name").endswith("7"))
    kind = F.when(F.col("exchange").isNull(), "no exchange").when(F.col("exchange").isin("BUILDING", "MACHINERY"), "selected")
    return c.select(kind.alias("kind")).filter("kind IS NOT NULL").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("flt_11_text_filter", "SELECT p_partkey FROM part WHERE contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'ring brand#1')")
def text_filter(spark, d):
    return table(spark, d, "part").filter(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).contains("ring brand#1")).select("p_partkey")


@query("pag_02_keyset_page", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber, l_partkey) > (100, 3, 50) ORDER BY ALL LIMIT 31")
def keyset_page(spark, d):
    """Three columns in one direction."""
    return keyset.page(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), [("l_orderkey", False), ("l_linenumber", False), ("l_partkey", False)], 30, [100, 3, 50])


@query("pag_08_etags", """
    WITH h AS (SELECT o_orderstatus, sha256('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice::DOUBLE::VARCHAR || '}') AS x, o_orderdate FROM orders)
    SELECT o_orderstatus, count(*) AS n, CASE WHEN max(o_orderdate) < TIMESTAMP '2001-08-01' THEN 86400 ELSE 15 END::INT AS max_age,
           sha256(sum(('0x' || x[1:16])::UBIGINT::HUGEINT) || '|' || sum(('0x' || x[17:32])::UBIGINT::HUGEINT) || '|' || sum(('0x' || x[33:48])::UBIGINT::HUGEINT) || '|' || sum(('0x' || x[49:64])::UBIGINT::HUGEINT) || '|' || count(*)) AS etag FROM h GROUP BY 1""")
def etags(spark, d):
    """A response is settled, and may be kept for a day, where its newest row lies in the past; its tag is a hash over all its rows, whatever their order."""
    from ..operators.gates import group_hash

    o = table(spark, d, "orders")
    tags = group_hash(o.select("o_orderstatus", "o_orderkey", "o_totalprice"), ["o_orderstatus"])
    age = F.when(F.max("o_orderdate") < _ts("2001-08-01"), 86400).otherwise(15)
    out = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), age.alias("max_age")).join(tags, "o_orderstatus")
    return out.select("o_orderstatus", "n", "max_age", F.col("content_hash").alias("etag"))


@query("jon_04_gaps_with_zone", "SELECT event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'error' AND value > 20")
def gaps_with_zone(spark, d):
    e = table(spark, d, "events").filter("event_type = 'error' AND value > 20").select("event_id", F.col("user_id").alias("c_custkey"))
    return e.join(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey").select("event_id", "c_mktsegment")


@query("jon_05_enabled_scope", "SELECT DISTINCT user_id FROM events JOIN customer ON user_id = c_custkey WHERE event_type = 'signup' AND value > 10 AND c_acctbal > 0")
def enabled_scope(spark, d):
    """Enabled in the scope and active among the symbols."""
    scope = table(spark, d, "events").filter("event_type = 'signup' AND value > 10").select("user_id").distinct()
    active = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return scope.join(active, "user_id")


@query("jon_07_seed_ledger", """
    WITH l AS (SELECT user_id, ts::DATE AS day FROM events WHERE event_type = 'signup' AND value < 20), s AS (SELECT DISTINCT user_id, ts::DATE AS day FROM events WHERE event_type = 'signup')
    SELECT user_id, day::VARCHAR AS day, count(*) AS n FROM (SELECT DISTINCT * FROM l UNION ALL SELECT * FROM s WHERE (user_id, day) NOT IN (SELECT * FROM l)) GROUP BY ALL""")
def seed_ledger(spark, d):
    """What isn't in the ledger yet is appended, and nothing twice."""
    s = table(spark, d, "events").filter("event_type = 'signup'").select("user_id", F.col("ts").cast("date").alias("day"), "value")
    ledger = s.filter("value < 20").select("user_id", "day").distinct()
    out = ledger.unionByName(lifecycle.claim(ledger, s.select("user_id", "day"), ["user_id", "day"]))
    return out.groupBy("user_id", F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("jon_08_orphans", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_discount > 0.09)")
def orphans(spark, d):
    """Two NOT INs over keys that are never null are two anti joins, and here one over a union."""
    li = table(spark, d, "lineitem")
    used = li.filter("l_quantity > 49 OR l_returnflag = 'A' AND l_discount > 0.09").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(used, "p_partkey", "left_anti")


@query("jon_09_not_in_pairs", "SELECT o_custkey, o_orderkey FROM orders WHERE (o_custkey, o_orderdate) NOT IN (SELECT o_custkey, max(o_orderdate) FROM orders GROUP BY 1)")
def not_in_pairs(spark, d):
    """All but the rows of each key's newest day, by two columns."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return o.join(o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate")), ["o_custkey", "o_orderdate"], "left_anti").select("o_custkey", "o_orderkey")


@query("jon_12_items_with_runs", "SELECT l_orderkey, l_linenumber, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'")
def items_with_runs(spark, d):
    o = table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(o, "l_orderkey")


@query("jon_13_open_sessions", "SELECT event_id, c_custkey FROM events JOIN customer ON user_id = c_custkey AND c_acctbal > 5000 WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-25'")
def open_sessions(spark, d):
    e = table(spark, d, "events").filter((F.col("event_type") == "view") & (F.col("ts") >= _ts("2024-01-25"))).select("event_id", "user_id")
    return e.join(table(spark, d, "customer").select("c_custkey", "c_acctbal"), (F.col("user_id") == F.col("c_custkey")) & (F.col("c_acctbal") > 5000)).select("event_id", "c_custkey")


_LATEST = "SELECT o_custkey, max((o_orderdate, o_orderkey)) AS m FROM orders GROUP BY 1"


@query("jon_14_metrics_of_latest", f"WITH r AS ({_LATEST}) SELECT o_custkey, l_linenumber, count(*) AS n FROM r JOIN lineitem ON l_orderkey = m[2] GROUP BY ALL")
def metrics_of_latest(spark, d):
    """Metrics of each scope's latest run alone."""
    latest = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m")).select("o_custkey", F.col("m.o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(latest, "l_orderkey").groupBy("o_custkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))


@query("jon_15_share_of_latest", """
    WITH o AS (SELECT o_custkey, o_orderstatus, round(o_totalprice * 100)::BIGINT AS cents FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders))
    SELECT o_orderstatus, sum(cents) / (SELECT sum(cents) FROM o) AS share FROM o GROUP BY 1""")
def share_of_latest(spark, d):
    """Shares of the latest day's total; the total is one row."""
    o = table(spark, d, "orders").select("o_orderdate", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    last = o.agg(F.max("o_orderdate").alias("last"))
    day = o.join(F.broadcast(last), F.col("o_orderdate") == F.col("last"))  # one row
    total = day.agg(F.sum("cents").alias("total"))
    return day.groupBy("o_orderstatus").agg(F.sum("cents").alias("cents")).crossJoin(F.broadcast(total)).select("o_orderstatus", (F.col("cents") / F.col("total")).alias("share"))


@query("jon_16_screens_latest_run", f"WITH r AS ({_LATEST}) SELECT c_custkey, coalesce((m[2])::VARCHAR, 'none') AS run FROM customer LEFT JOIN r ON o_custkey = c_custkey")
def screens_latest_run(spark, d):
    latest = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("m"))
    return table(spark, d, "customer").select("c_custkey").join(latest, "c_custkey", "left").select("c_custkey", F.coalesce(F.col("m.o_orderkey").cast("string"), F.lit("none")).alias("run"))


@query("jon_18_known_split", "SELECT CASE WHEN c_custkey IS NULL THEN 'rejected' ELSE 'accepted' END AS outcome, count(*) AS n FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON user_id = c_custkey GROUP BY 1")
def known_split(spark, d):
    known = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.lit(True).alias("known"))
    return table(spark, d, "events").join(known, "user_id", "left").groupBy(F.when(F.col("known"), "accepted").otherwise("rejected").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("jon_24_outbox_exchange", "SELECT event_id, coalesce(c_mktsegment, 'unknown') AS exchange FROM events LEFT JOIN (SELECT * FROM customer WHERE c_nationkey > 5) ON user_id = c_custkey")
def outbox_exchange(spark, d):
    c = table(spark, d, "customer").filter("c_nationkey > 5").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return table(spark, d, "events").select("event_id", "user_id").join(c, "user_id", "left").select("event_id", F.coalesce("c_mktsegment", F.lit("unknown")).alias("exchange"))


@query("jon_26_volume_to_candle", """
    SELECT a.user_id, a.h, a.close, b.n AS volume FROM (SELECT user_id, date_trunc('hour', ts) AS h, arg_max(value, event_id) AS close FROM events WHERE event_type = 'purchase' GROUP BY ALL) a
    JOIN (SELECT user_id, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY ALL) b USING (user_id, h)""")
def volume_to_candle(spark, d):
    """Volume joins the candle of its instant; volume without a candle is dropped. Both come of one aggregate."""
    p = F.col("event_type") == "purchase"
    out = table(spark, d, "events").groupBy("user_id", F.date_trunc("hour", "ts").alias("h")).agg(F.max_by("value", F.when(p, F.col("event_id"))).alias("close"), F.count(F.lit(1)).alias("volume"))
    return out.filter("close IS NOT NULL").select("user_id", F.col("h").cast("timestamp_ntz").alias("h"), "close", "volume")


@query("jon_28_plan_limits", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 100 WHEN 'MACHINERY' THEN 500 ELSE 10 END::INT AS per_minute FROM customer")
def plan_limits(spark, d):
    """The limits of a client's plan, or the fallback where there is none."""
    plans = spark.createDataFrame([("BUILDING", 100), ("MACHINERY", 500)], "c_mktsegment string, per_minute int")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment").join(F.broadcast(plans), "c_mktsegment", "left")  # two rows
    return c.select("c_custkey", F.coalesce("per_minute", F.lit(10)).alias("per_minute"))


@query("win_01_latest_metrics", "SELECT l_suppkey, l_partkey, l_orderkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1")
def latest_metrics(spark, d):
    best = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")).alias("b"))
    return best.select("l_suppkey", "b.l_partkey", "b.l_orderkey")


@query("win_04_latest_run", "SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_run(spark, d):
    best = table(spark, d, "orders").groupBy("o_orderpriority").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("b"))
    return best.select("o_orderpriority", "b.o_orderkey")


@query("win_06_first_of_page", """
    WITH page AS (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 500) SELECT o_orderpriority, o_orderkey FROM page QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def first_of_page(spark, d):
    """The first row of each key of a page that is sorted already."""
    page = table(spark, d, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(500)
    return last_rows(page, ["o_orderpriority"], [F.desc("o_orderdate"), F.asc("o_orderkey")], 1).select("o_orderpriority", "o_orderkey")


@query("win_13_dense_rank_index", """
    WITH r AS (SELECT o_custkey, o_orderstatus, o_orderkey FROM orders WHERE o_totalprice > 100000 QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) = 1)
    SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INT AS rank_index FROM r""")
def dense_rank_index(spark, d):
    """Ranks count written rows alone: filtered and repeated ones leave no hole."""
    r = table(spark, d, "orders").filter("o_totalprice > 100000").groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("o_orderkey"))
    return r.select("o_custkey", "o_orderkey", (F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1).alias("rank_index"))


@query("srt_01_limit_plus_one", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 51")
def limit_plus_one(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(51)


@query("srt_02_newest_ticks", "SELECT event_id, ts FROM events ORDER BY date_trunc('hour', ts) DESC, sha256(event_id::VARCHAR) DESC LIMIT 40")
def newest_ticks(spark, d):
    """Ties go by payload hash."""
    return table(spark, d, "events").select("event_id", "ts").orderBy(F.date_trunc("hour", "ts").desc(), F.sha2(F.col("event_id").cast("string"), 256).desc()).limit(40)


@query("srt_03_typed_sort", """
    WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey::VARCHAR WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN o_orderpriority ELSE '' END AS v FROM orders)
    SELECT o_orderkey, v FROM t ORDER BY CASE WHEN v = '' THEN 3 WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 0 WHEN try_cast(v AS DATE) IS NOT NULL THEN 1 ELSE 2 END, try_cast(v AS DOUBLE), try_cast(v AS DATE), lower(v), o_orderkey
    LIMIT 50 OFFSET (SELECT count(*) // 4 - 25 FROM orders)""")
def typed_sort(spark, d):
    """Numbers as numbers, then dates by time, then text without case, empty cells last; a page from around the end of the numbers."""
    k, o = F.col("o_orderkey") % 4, table(spark, d, "orders")
    v = F.when(k == 0, F.col("o_custkey").cast("string")).when(k == 1, F.col("o_orderdate").cast("date").cast("string")).when(k == 2, F.col("o_orderpriority")).otherwise("")
    number, day = F.col("v").try_cast("double"), F.col("v").try_cast("date")
    kind = F.when(F.col("v") == "", 3).when(number.isNotNull(), 0).when(day.isNotNull(), 1).otherwise(2)
    half = o.count() // 4 - 25
    rows = o.select("o_orderkey", v.alias("v")).withColumns({"_kind": kind, "_number": number, "_day": day, "_text": F.lower("v")})
    return keyset.page_at(rows, ["_kind", "_number", "_day", "_text", "o_orderkey"], half, 50).select("o_orderkey", "v")


@query("srt_05_sorted_before_hash", "SELECT o_custkey, sha256(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR)) AS h FROM orders GROUP BY 1")
def sorted_before_hash(spark, d):
    """Rows in the order of their keys as text, so their hash doesn't depend on how they came. Orders of one customer are few."""
    keys = F.array_sort(F.collect_list(F.col("o_orderkey").cast("string")))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.sha2(F.array_join(keys, ","), 256).alias("h"))


@query("srt_07_top_stale", "SELECT l_partkey, count(*) FILTER (l_returnflag = 'A') AS stale FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'A') > 0 ORDER BY stale DESC, l_partkey LIMIT 25")
def top_stale(spark, d):
    out = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_if(F.col("l_returnflag") == "A").alias("stale")).filter("stale > 0")
    return out.orderBy(F.desc("stale"), "l_partkey").limit(25)


@query("srt_10_relative_periods", "SELECT p_partkey, '-' || (p_size % 12) || 'm' AS period FROM part ORDER BY -(p_size % 12), p_partkey LIMIT 60")
def relative_periods(spark, d):
    """-12m before -3m before 0m: by number, not by text."""
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("-"), (F.col("p_size") % 12).cast("string"), F.lit("m")).alias("period"))
    return p.orderBy(F.regexp_extract("period", r"^(-?\d+)m$", 1).try_cast("int"), "p_partkey").limit(60)


@query("set_01_union_all", "SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier UNION ALL SELECT p_partkey, 'part' FROM part")
def union_all(spark, d):
    one = lambda t, k: table(spark, d, t).select(F.col(k).alias("k"), F.lit(t).alias("kind"))
    return one("customer", "c_custkey").unionByName(one("supplier", "s_suppkey")).unionByName(one("part", "p_partkey"))


@query("set_04_missing_topics", "SELECT DISTINCT 'rows.' || lower(c_mktsegment) AS topic FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD')")
def missing_topics(spark, d):
    """Topics that routes ask for and the broker doesn't have."""
    there = spark.createDataFrame([("rows.building",), ("rows.household",), ("other",)], "topic string")
    return table(spark, d, "customer").select(F.concat(F.lit("rows."), F.lower("c_mktsegment")).alias("topic")).distinct().join(F.broadcast(there), "topic", "left_anti")  # three rows


@query("set_06_known_candidates", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT p_partkey FROM part WHERE p_size > 25")
def known_candidates(spark, d):
    known = table(spark, d, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    return table(spark, d, "lineitem").filter("l_returnflag = 'A'").select("l_partkey").intersect(known)


@query("set_07_last_of_index", "SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS at, max(event_id) AS event_id FROM events GROUP BY ALL")
def last_of_index(spark, d):
    """Of rows with one index the last stays."""
    return table(spark, d, "events").groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at")).agg(F.max("event_id").alias("event_id"))
