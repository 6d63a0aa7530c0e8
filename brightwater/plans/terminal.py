"""What a terminal shows: candles, heat, comparisons, boards, predicate trees and rankings."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..operators import series
from .market import _HISTORY, history
from .registry import query, table

_COMPARE = {"eq": operator.eq, "gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}


def predicate(tree: list) -> Column:
    """A nested list such as ["and", ["eq", "region", "us"], ["gt", "price", 5]] as one column, so the scan sees its parts."""
    op, *args = tree
    if op in ("and", "or"):
        return reduce(operator.and_ if op == "and" else operator.or_, map(predicate, args))
    column, *values = args
    if op == "btwn":
        return F.col(column).between(*values)
    if op == "is-in":
        return F.col(column).isin(values)
    return _COMPARE[op](F.col(column), F.lit(values[0]))


@query("uia_01_candles", """
    SELECT user_id, ts, event_id, value FROM events WHERE value IS NOT NULL AND event_type <> 'view' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1""")
def candles(spark, d):
    """One per instant, the last wins; rows without a price are dropped."""
    e = table(spark, d, "events").filter("value IS NOT NULL AND event_type != 'view'")
    return e.groupBy("user_id", "ts").agg(F.max(F.struct("event_id", "value")).alias("b")).select("user_id", "ts", "b.event_id", "b.value")


@query("uia_05_sector_heat", """
    WITH x AS (SELECT r_name AS sector, o_orderdate, o_orderkey, o_totalprice AS cap FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 0)
    SELECT sector, o_orderkey, cap FROM x QUALIFY row_number() OVER (PARTITION BY sector ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def sector_heat(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("sector"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(n, "c_nationkey")
    x = table(spark, d, "orders").filter("o_totalprice > 0").join(c, "o_custkey")
    return x.groupBy("sector").agg(F.max(F.struct("o_orderdate", "o_orderkey", F.col("o_totalprice").alias("cap"))).alias("b")).select("sector", "b.o_orderkey", "b.cap")


@query("uia_12_watch_rows", f"""WITH {_HISTORY}, w AS (SELECT symbol, close, lag(close) OVER (PARTITION BY symbol ORDER BY day) AS prev, row_number() OVER (PARTITION BY symbol ORDER BY day DESC) AS rn FROM h),
    live AS (SELECT user_id AS symbol, arg_max(value, (ts, event_id)) AS price FROM events GROUP BY 1)
    SELECT w.symbol, coalesce(price, close) AS price, prev FROM w LEFT JOIN live USING (symbol) WHERE rn = 1""")
def watch_rows(spark, d):
    """The live price, else the archived close, beside the close before it."""
    two = series.last_rows(history(spark, d), ["symbol"], [F.desc("day")], 2)
    w = two.groupBy("symbol").agg(F.max_by("close", "day").alias("close"), F.min_by("close", "day").alias("prev"), F.count(F.lit(1)).alias("n"))
    live = table(spark, d, "events").groupBy(F.col("user_id").alias("symbol")).agg(F.max_by("value", F.struct("ts", "event_id")).alias("price"))
    return w.join(live, "symbol", "left").select("symbol", F.coalesce("price", "close").alias("price"), F.when(F.col("n") > 1, F.col("prev")).alias("prev"))


@query("uia_16_predicate_tree", """
    SELECT p_partkey, p_retailprice FROM part WHERE p_size BETWEEN 5 AND 30 AND (p_retailprice > 1200 OR p_brand IN ('Brand#11', 'Brand#12')) ORDER BY p_retailprice DESC, p_partkey LIMIT 25""")
def predicate_tree(spark, d):
    tree = ["and", ["btwn", "p_size", 5, 30], ["or", ["gt", "p_retailprice", 1200], ["is-in", "p_brand", "Brand#11", "Brand#12"]]]
    return table(spark, d, "part").filter(predicate(tree)).orderBy(F.desc("p_retailprice"), "p_partkey").limit(25).select("p_partkey", "p_retailprice")


@query("win_07_newest_date_only", "SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem l WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem m WHERE m.l_partkey = l.l_partkey)")
def newest_date_only(spark, d):
    newest = F.max("l_shipdate").over(Window.partitionBy("l_partkey"))
    return table(spark, d, "lineitem").withColumn("_n", newest).filter("l_shipdate = _n").select("l_partkey", "l_orderkey", "l_linenumber")


@query("win_10_trend", f"WITH {_HISTORY} SELECT symbol, arg_max(close, day) >= arg_min(close, day) AS rising FROM h GROUP BY symbol HAVING count(*) > 1")
def trend(spark, d):
    g = history(spark, d).groupBy("symbol").agg(F.max_by("close", "day").alias("last"), F.min_by("close", "day").alias("first"), F.count(F.lit(1)).alias("n"))
    return g.filter("n > 1").select("symbol", (F.col("last") >= F.col("first")).alias("rising"))


@query("jon_02_newest_links", "SELECT o_orderkey, c_name, o_orderdate FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 40")
def newest_links(spark, d):
    c = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return table(spark, d, "orders").join(c, "o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(40).select("o_orderkey", "c_name", "o_orderdate")


@query("agg_26_extent", "SELECT event_type, min(value) AS low, max(value) AS high FROM events WHERE isfinite(value) GROUP BY 1")
def extent(spark, d):
    ok = ~F.isnan("value") & (F.abs("value") < float("inf"))
    return table(spark, d, "events").filter(ok).groupBy("event_type").agg(F.min("value").alias("low"), F.max("value").alias("high"))
