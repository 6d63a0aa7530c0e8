"""Reads: filters, ranked search, keyset pages, joins, set operations and projections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import keyset
from .registry import query, table


@query("src_04_actions_view", """
    SELECT user_id, ts, event_id, value, event_type AS kind FROM events WHERE event_type IN ('purchase', 'signup', 'click')""")
def actions_view(spark, d):
    """Union of three kinds of actions with the kind as a column."""
    e = table(spark, d, "events").filter(F.col("event_type").isin("purchase", "signup", "click"))
    return e.select("user_id", "ts", "event_id", "value", F.col("event_type").alias("kind"))


@query("flt_01_active_symbols", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AND starts_with(c_name, 'Customer#0000000')""")
def active_symbols(spark, d):
    c = table(spark, d, "customer")
    return c.filter((F.col("c_acctbal") > 0) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & F.col("c_name").startswith("Customer#0000000")).select("c_custkey", "c_name", "c_mktsegment")


@query("flt_03_ranked_search", """
    SELECT p_partkey, p_name, CASE WHEN lower(p_name) = 'part 12' THEN 0 WHEN starts_with(lower(p_name), 'part 12') THEN 1
           WHEN starts_with(p_partkey::VARCHAR, '12') THEN 2 ELSE 3 END::INT AS rank
    FROM part WHERE contains(lower(p_name), '12') OR starts_with(p_partkey::VARCHAR, '12') ORDER BY rank, length(p_name), p_partkey LIMIT 20""")
def ranked_search(spark, d):
    """Exact, then name prefix, then key prefix, then contained; shortest name first."""
    p, name, key = table(spark, d, "part"), F.lower("p_name"), F.col("p_partkey").cast("string")
    rank = F.when(name == "part 12", 0).when(name.startswith("part 12"), 1).when(key.startswith("12"), 2).otherwise(3)
    hit = p.filter(name.contains("12") | key.startswith("12")).withColumn("rank", rank)
    return hit.orderBy("rank", F.length("p_name"), "p_partkey").limit(20).select("p_partkey", "p_name", "rank")


@query("flt_04_time_window", """
    SELECT event_id, user_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08' AND event_type <> 'view'""")
def time_window(spark, d):
    """Half-open; the bounds reach the scan as pushed filters."""
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    e = table(spark, d, "events").filter((F.col("ts") >= at("2024-01-05")) & (F.col("ts") < at("2024-01-08")) & (F.col("event_type") != "view"))
    return e.select("event_id", "user_id", "ts", "value")


@query("pag_01_first_page", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 101")
def first_page(spark, d):
    return keyset.page(table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), [("o_orderdate", True), ("o_orderkey", True)], 100)


@query("pag_03_mixed_page", """
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderpriority < '3-MEDIUM' OR (o_orderpriority = '3-MEDIUM' AND o_orderkey > 500)
    ORDER BY o_orderpriority DESC, o_orderkey LIMIT 51""")
def mixed_page(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return keyset.page(o, [("o_orderpriority", True), ("o_orderkey", False)], 50, ["3-MEDIUM", 500])


@query("pag_04_row_value_page", "SELECT user_id, event_id, value FROM events WHERE (user_id, event_id) > (50, 3000) ORDER BY user_id, event_id LIMIT 41")
def row_value_page(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "value")
    return e.filter(F.struct("user_id", "event_id") > F.struct(F.lit(50).cast("long").alias("user_id"), F.lit(3000).cast("long").alias("event_id"))).orderBy("user_id", "event_id").limit(41)


@query("pag_06_offset_page", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 26 OFFSET 50")
def offset_page(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").offset(50).limit(26)


@query("prj_07_unpivot_facts", """
    WITH p AS (SELECT l_suppkey, year(l_shipdate)::INT AS fiscal_year, sum(l_quantity::DECIMAL(18,2))::DECIMAL(28,2) AS quantity,
               sum(l_extendedprice::DECIMAL(18,2))::DECIMAL(28,2) AS revenue, CASE WHEN count(*) > 3 THEN sum(l_tax::DECIMAL(18,2)) END::DECIMAL(28,2) AS tax FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, fiscal_year, item_key, item_value::DOUBLE AS item_value FROM p UNPIVOT (item_value FOR item_key IN (quantity, revenue, tax))""")
def unpivot_facts(spark, d):
    """Wide statement rows to one row per item; empty cells are dropped."""
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("decimal(28,2)")
    p = table(spark, d, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("fiscal_year")).agg(
        money("l_quantity").alias("quantity"), money("l_extendedprice").alias("revenue"), F.when(F.count(F.lit(1)) > 3, money("l_tax")).alias("tax"))
    return p.unpivot(["l_suppkey", "fiscal_year"], ["quantity", "revenue", "tax"], "item_key", "item_value").filter("item_value IS NOT NULL").withColumn("item_value", F.col("item_value").cast("double"))


@query("prj_08_pivot_labels", """
    SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'P') AS pending
    FROM orders GROUP BY o_custkey""")
def pivot_labels(spark, d):
    """Label rows to one row; the labels are known, so no job lists them first."""
    out = table(spark, d, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)
    return out.withColumnsRenamed({"F": "filled", "O": "open", "P": "pending"})


@query("prj_05_unmapped_keys", """SELECT event_id, json_extract_string(props, '$.k')::INT AS k,
    list_sort(list_filter(json_keys(props), lambda x: x <> 'k'))::VARCHAR AS unmapped FROM events""")
def unmapped_keys(spark, d):
    e = table(spark, d, "events")
    left = F.array_sort(F.array_except(F.json_object_keys("props"), F.array(F.lit("k"))))
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.concat(F.lit("["), F.array_join(left, ", "), F.lit("]")).alias("unmapped"))


@query("jon_01_facts_with_headers", """
    SELECT o.o_orderkey, l.l_linenumber, o.o_orderstatus, l.l_quantity FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderpriority = '1-URGENT'""")
def facts_with_headers(spark, d):
    o = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey"), "o_orderstatus")
    return table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").join(o, "o_orderkey").select("o_orderkey", "l_linenumber", "o_orderstatus", "l_quantity")


@query("jon_03_members_left_quotes", """
    WITH m AS (SELECT p_partkey FROM part WHERE p_size <= 5), q AS (SELECT l_partkey, max(l_shipdate) AS newest FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
    SELECT p_partkey, newest FROM m LEFT JOIN q ON p_partkey = l_partkey""")
def members_left_quotes(spark, d):
    """A roster keeps its length: members without a quote that day stay."""
    q = table(spark, d, "lineitem").filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_shipdate").alias("newest"))
    return table(spark, d, "part").filter("p_size <= 5").select("p_partkey").join(q, "p_partkey", "left")


@query("jon_06_not_in_ledger", """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '5-LOW')""")
def not_in_ledger(spark, d):
    o = table(spark, d, "orders").filter("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").select("c_custkey", "c_name").join(o, "c_custkey", "left_anti")


@query("jon_10_lateral_newest", """
    SELECT c_custkey, (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS newest FROM customer""")
def lateral_newest(spark, d):
    """A correlated maximum, decorrelated: aggregate once, then join."""
    newest = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("newest"))
    return table(spark, d, "customer").select("c_custkey").join(newest, "c_custkey", "left")


@query("jon_11_values_then_range", """
    SELECT event_type, count(*) AS expiring FROM events JOIN (VALUES ('click', 7), ('purchase', 20), ('view', 14)) v(event_type, days) USING (event_type)
    WHERE ts < TIMESTAMP '2024-01-31' - to_days(days::INT) GROUP BY event_type""")
def values_then_range(spark, d):
    v = spark.createDataFrame([("click", 7), ("purchase", 20), ("view", 14)], "event_type string, days int")
    e = table(spark, d, "events").join(F.broadcast(v), "event_type")  # three rows
    return e.filter(F.col("ts") < F.expr("timestamp_ntz'2024-01-31' - make_dt_interval(days)")).groupBy("event_type").agg(F.count(F.lit(1)).alias("expiring"))


@query("jon_17_known_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25), false) AS is_known FROM lineitem""")
def known_flag(spark, d):
    known = table(spark, d, "part").filter("p_size < 25").select(F.col("p_partkey").alias("l_partkey")).distinct().withColumn("_k", F.lit(True))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(known, "l_partkey", "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("_k").isNotNull().alias("is_known"))


@query("jon_25_taxonomy", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def taxonomy(spark, d):
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("jon_27_overlap_ratio", """
    WITH a AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag = 'N')
    SELECT s AS suppkey, (count(b.p) / count(*))::DOUBLE AS ratio FROM a LEFT JOIN b USING (s, p) GROUP BY s""")
def overlap_ratio(spark, d):
    """The share of one set that lies in another; one aggregate over flags instead of a join."""
    flags = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("suppkey"), "l_partkey").agg(
        F.bool_or(F.col("l_returnflag") == "A").alias("a"), F.bool_or(F.col("l_returnflag") == "N").alias("b"))
    return flags.filter("a").groupBy("suppkey").agg((F.count_if("b") / F.count(F.lit(1))).alias("ratio"))


@query("set_02_distinct_union", "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_partkey, max(l_suppkey) FROM lineitem GROUP BY 1")
def distinct_union(spark, d):
    li = table(spark, d, "lineitem")
    return li.filter("l_returnflag = 'R'").select("l_partkey", "l_suppkey").union(li.groupBy("l_partkey").agg(F.max("l_suppkey"))).distinct()


@query("set_05_departed", "SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02' EXCEPT SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-30'")
def departed(spark, d):
    e, at = table(spark, d, "events"), lambda x: F.lit(x).cast("timestamp_ntz")
    return e.filter(F.col("ts") < at("2024-01-02")).select("user_id").subtract(e.filter(F.col("ts") >= at("2024-01-30")).select("user_id"))


@query("set_08_tape_merge", """
    WITH u AS (SELECT 0 AS src, * FROM events WHERE event_type = 'click' UNION ALL SELECT 1, * FROM events WHERE event_type <> 'error')
    SELECT user_id, ts, event_id, src::INT AS src FROM u QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY src, event_id) = 1""")
def tape_merge(spark, d):
    """Live before archived: the first source wins for a symbol and instant."""
    e = table(spark, d, "events")
    u = e.filter("event_type = 'click'").withColumn("src", F.lit(0)).unionByName(e.filter("event_type != 'error'").withColumn("src", F.lit(1)))
    best = u.groupBy("user_id", "ts").agg(F.min(F.struct("src", "event_id")).alias("b"))
    return best.select("user_id", "ts", "b.event_id", "b.src")


@query("srt_04_top_holders", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def top_holders(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@query("scl_text_rules", """
    SELECT p_partkey, upper(trim(p_name)) AS symbol, sha256(p_name) AS content_hash, sha256(p_name)[1:16] AS short_hash, translate(lower(trim(p_type)), ' -', '__') AS slug,
           nullif(trim(p_brand), '') AS brand, CASE WHEN length(p_name) <= 9 THEN trim(p_name) END AS key_text,
           try_cast(regexp_extract(p_name, '(\\d+)', 1) AS BIGINT) AS number FROM part""")
def text_rules(spark, d):
    name = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", S.symbol(name).alias("symbol"), S.content_hash(name).alias("content_hash"), S.short_hash(name).alias("short_hash"),
                                          S.slug(F.col("p_type")).alias("slug"), S.blank_to_null(F.col("p_brand")).alias("brand"), S.key_text(name, 9).alias("key_text"),
                                          S.to_long(F.regexp_extract(name, r"(\d+)", 1)).alias("number"))


@query("scl_number_rules", """
    SELECT l_orderkey, l_linenumber, l_extendedprice::VARCHAR::DECIMAL(28,12)::VARCHAR AS price, trunc(l_extendedprice)::BIGINT AS whole,
           CASE WHEN l_extendedprice > 0 THEN l_quantity / l_extendedprice * 100 END AS margin, sign(l_discount - 0.05) * least(1.0, abs(l_discount - 0.05) / 0.05) AS heat FROM lineitem""")
def number_rules(spark, d):
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", S.to_price(price).cast("string").alias("price"), S.whole(price).alias("whole"),
                                              S.margin(F.col("l_quantity"), price).alias("margin"), S.heat(F.col("l_discount") - 0.05, 0.05).alias("heat"))


@query("scl_time_rules", """
    SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket, ((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')::DATE::VARCHAR AS ny_day, epoch_us(ts) // 1000 AS ms FROM events""")
def time_rules(spark, d):
    at = F.col("ts").cast("timestamp")
    return table(spark, d, "events").select("event_id", S.bucket_of(at, 900).cast("timestamp_ntz").alias("bucket"), S.local_date(at, "America/New_York").cast("string").alias("ny_day"), F.unix_millis(at).alias("ms"))


@query("win_03_latest_per_screen", "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_screen(spark, d):
    """The newest row of a key as an aggregate: no sort, and map tasks send one row a key."""
    best = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.struct("o_orderdate", "o_orderkey")).alias("b"))
    return best.select("o_custkey", "b.o_orderkey", "b.o_orderdate")
