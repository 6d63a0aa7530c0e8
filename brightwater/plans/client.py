"""What a client shows: flags, charts, boards, maps and label rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators.series import last_rows
from .registry import query, table


def _ts(x: str):
    return F.lit(x).cast("timestamp_ntz")


@query("uia_02_volume_colour", """
    SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS at, count(*) AS volume, CASE WHEN arg_max(value, (ts, event_id)) >= arg_min(value, (ts, event_id)) THEN 'up' ELSE 'down' END AS colour FROM events GROUP BY 1, 2""")
def volume_colour(spark, d):
    order = F.struct("ts", "event_id")
    out = table(spark, d, "events").groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("at")).agg(F.count(F.lit(1)).alias("volume"), F.max_by("value", order).alias("c"), F.min_by("value", order).alias("o"))
    return out.select("user_id", "at", "volume", F.when(F.col("c") >= F.col("o"), "up").otherwise("down").alias("colour"))


@query("uia_04_income_chart", """
    WITH p AS (SELECT l_suppkey, year(l_shipdate)::INT AS period, sum(round(l_extendedprice * 100)::BIGINT) FILTER (l_returnflag = 'A')::BIGINT AS revenue, coalesce(sum(round(l_extendedprice * 100)::BIGINT) FILTER (l_returnflag = 'N'), 0)::BIGINT AS income FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, period, revenue, income, (income / revenue * 100)::DOUBLE AS margin FROM p WHERE revenue IS NOT NULL""")
def income_chart(spark, d):
    """Revenue, income and margin by period; periods without a revenue row have no bar."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    of = lambda k: F.sum(F.when(F.col("l_returnflag") == k, cents))
    p = table(spark, d, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("period")).agg(of("A").alias("revenue"), F.coalesce(of("N"), F.lit(0)).alias("income")).filter("revenue IS NOT NULL")
    return p.withColumn("margin", F.col("income") / F.col("revenue") * 100)


@query("uia_06_screen_heat", """
    WITH q AS (SELECT l_partkey AS k, sum(l_quantity)::DOUBLE AS cap, max(l_discount) AS pct FROM lineitem GROUP BY 1) SELECT p_partkey, p_brand, cap, pct FROM part JOIN q ON k = p_partkey WHERE cap > 0 AND p_size < 20""")
def screen_heat(spark, d):
    """A roster with its quotes; members without a market value aren't drawn, percents stand as they are."""
    q = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("cap"), F.max("l_discount").alias("pct"))
    return table(spark, d, "part").filter("p_size < 20").select("p_partkey", "p_brand").join(q, "p_partkey").filter("cap > 0")


def folded_cells(rows, group: str, key: str, value: str, most: int = 400):
    """group, cell, cap: the cells of each group's map. Of more than ``most`` the largest stay and one cell holds all others, named by how many they are.

    Values that aren't above 0 aren't drawn. The largest are picked within each task before any row travels, and the others are only summed.
    """
    usable = rows.filter(F.col(value) > 0).select(group, F.col(key).cast("string").alias("cell"), F.col(value).cast("decimal(28,6)").alias("cap"), F.col(key).alias("_k"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("cap"), F.asc("_k")))
    top = usable.withColumn("_n", rank).filter(F.col("_n") <= most)
    held = top.groupBy(group).agg(F.count_if(F.col("_n") < most).alias("_kept"), F.sum(F.when(F.col("_n") < most, F.col("cap"))).alias("_sum"))
    rest = usable.groupBy(group).agg(F.count(F.lit(1)).alias("_all"), F.sum("cap").alias("_total")).filter(F.col("_all") > most).join(held, group)
    other = rest.select(group, F.concat(F.lit("Other ("), (F.col("_all") - F.col("_kept")).cast("string"), F.lit(")")).alias("cell"), (F.col("_total") - F.col("_sum")).alias("cap"))
    kept = top.join(rest.select(group, F.lit(True).alias("_more")), group, "left").filter((F.col("_n") < most) | F.col("_more").isNull())
    return kept.select(group, "cell", "cap").unionByName(other)


def squarify(sizes: list[float], x: float, y: float, w: float, h: float) -> list[tuple[float, float, float, float]]:
    """Rectangles of a treemap in the order of descending sizes: rows along the shorter side, closed where another member would make them less square."""
    total, out, at = sum(sizes), [], 0
    scale = w * h / total if total else 0.0
    areas = [s * scale for s in sizes]
    while at < len(areas):
        side, n, held, best = min(w, h), 0, 0.0, float("inf")
        for a in areas[at:]:
            s = held + a
            worst = max(side * side * areas[at] / (s * s), s * s / (side * side * a)) if s and side else float("inf")  # the first of a row is its largest, the one that comes its least
            if n and worst > best:
                break
            n, held, best = n + 1, s, worst
        thick, along = (held / side if side else 0.0), 0.0
        for a in areas[at:at + n]:
            length = a / thick if thick else 0.0
            out.append((x, y + along, thick, length) if w >= h else (x + along, y, length, thick))
            along += length
        if w >= h:
            x, w = x + thick, w - thick
        else:
            y, h = y + thick, h - thick
        at += n
    return out


_WORST = "greatest(least(w, h) ** 2 * rem[1] / list_sum(rem[1:{k}]) ** 2, list_sum(rem[1:{k}]) ** 2 / (least(w, h) ** 2 * rem[{k}]))"
_ROW = f"coalesce(list_filter(range(1, len(rem)), lambda k: {_WORST.format(k='(k + 1)')} > {_WORST.format(k='k')})[1], len(rem))"


@query("uia_07_treemap", f"""
    WITH RECURSIVE c AS (SELECT p_brand, p_partkey, p_retailprice::DECIMAL(28,6) AS cap, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn, count(*) OVER (PARTITION BY p_brand) AS n FROM part WHERE p_retailprice > 0),
    k AS (SELECT p_brand, p_partkey::VARCHAR AS cell, cap FROM c WHERE n <= 60 OR rn < 60 UNION ALL SELECT p_brand, 'Other (' || count(*) || ')', sum(cap) FROM c WHERE n > 60 AND rn >= 60 GROUP BY 1),
    g AS (SELECT p_brand, list(cell ORDER BY cap DESC, cell) AS cells, list(cap::DOUBLE ORDER BY cap DESC, cell) AS caps, sum(cap)::DOUBLE AS total FROM k GROUP BY 1),
    t AS (SELECT p_brand, cells, list_transform(caps, lambda v: v * (6000.0::DOUBLE / total)) AS rem, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y, 100.0::DOUBLE AS w, 60.0::DOUBLE AS h FROM g
          UNION ALL SELECT p_brand, cells[n + 1:], rem[n + 1:], CASE WHEN w >= h THEN x + thick ELSE x END, CASE WHEN w >= h THEN y ELSE y + thick END, CASE WHEN w >= h THEN w - thick ELSE w END, CASE WHEN w >= h THEN h ELSE h - thick END
          FROM (SELECT *, list_sum(rem[1:n]) / least(w, h) AS thick FROM (SELECT *, {_ROW} AS n FROM t WHERE len(rem) > 0))),
    r AS (SELECT *, list_sum(rem[1:n]) / least(w, h) AS thick FROM (SELECT *, {_ROW} AS n FROM t WHERE len(rem) > 0)),
    b AS (SELECT *, coalesce(list_sum(rem[1:i - 1]), 0) / thick AS along, rem[i] / thick AS long FROM r, LATERAL (SELECT unnest(range(1, n + 1)) AS i))
    SELECT p_brand, cells[i] AS cell, round(CASE WHEN w >= h THEN x ELSE x + along END, 6) AS x, round(CASE WHEN w >= h THEN y + along ELSE y END, 6) AS y, round(CASE WHEN w >= h THEN thick ELSE long END, 6) AS width, round(CASE WHEN w >= h THEN long ELSE thick END, 6) AS height FROM b""")
def treemap(spark, d):
    """A map for each group: its 60 cells at most, folded before they meet, are laid out by one task."""
    import pandas as pd

    schema = T.StructType([T.StructField("p_brand", T.StringType()), T.StructField("cell", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in ("x", "y", "width", "height")]])

    def lay(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["cap", "cell"], ascending=[False, True])
        boxes = pd.DataFrame(squarify(frame["cap"].tolist(), 0.0, 0.0, 100.0, 60.0), columns=["x", "y", "width", "height"])
        return pd.concat([frame[["p_brand", "cell"]].reset_index(drop=True), boxes], axis=1)

    cells = folded_cells(table(spark, d, "part"), "p_brand", "p_partkey", "p_retailprice", most=60).withColumn("cap", F.col("cap").cast("double"))
    laid = cells.groupBy("p_brand").applyInPandas(lay, schema)
    return laid.select("p_brand", "cell", *[F.round(c, 6).alias(c) for c in ("x", "y", "width", "height")])


@query("uia_08_target_range", """
    WITH t AS (SELECT o_custkey, arg_max((o_totalprice * 0.8, o_totalprice, o_totalprice * CASE WHEN o_orderkey % 3 = 0 THEN 0.9 ELSE 1.2 END), (o_orderdate, o_orderkey)) AS t FROM orders GROUP BY 1)
    SELECT o_custkey, t[1]::DOUBLE AS low, t[2]::DOUBLE AS mean, t[3]::DOUBLE AS high FROM t WHERE t[1] <= t[2] AND t[2] <= t[3]""")
def target_range(spark, d):
    """The newest targets, where low, mean and high are there and in order."""
    price, order = F.col("o_totalprice"), F.struct("o_orderdate", "o_orderkey")
    high = price * F.when(F.col("o_orderkey") % 3 == 0, 0.9).otherwise(1.2)
    t = table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by(F.struct((price * 0.8).alias("low"), price.alias("mean"), high.alias("high")), order).alias("t"))
    return t.select("o_custkey", "t.*").filter("low <= mean AND mean <= high")


@query("uia_09_insider_flow", """
    WITH n AS (SELECT l_suppkey, arg_max((l_quantity, l_linenumber::DOUBLE, l_quantity - l_linenumber), (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS t FROM lineitem GROUP BY 1)
    SELECT l_suppkey, unnest(['purchases', 'sales', 'net']) AS kind, unnest([t[1], t[2], t[3]])::DOUBLE AS shares FROM n""")
def insider_flow(spark, d):
    """The newest row as bars."""
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    row = F.struct(F.col("l_quantity").alias("purchases"), F.col("l_linenumber").cast("double").alias("sales"), (F.col("l_quantity") - F.col("l_linenumber")).alias("net"))
    n = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.max_by(row, order).alias("t")).select("l_suppkey", "t.*")
    return n.unpivot(["l_suppkey"], ["purchases", "sales", "net"], "kind", "shares")


@query("uia_10_gainers", """
    WITH q AS (SELECT user_id, arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id)) AS change FROM events GROUP BY 1), g AS (SELECT * FROM q ORDER BY change DESC, user_id LIMIT 5),
    s AS (SELECT user_id, ts, event_id, value FROM events JOIN g USING (user_id) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 8)
    SELECT user_id, change, string_agg(round(value * 100)::BIGINT::VARCHAR, ' ' ORDER BY ts, event_id) AS spark FROM g JOIN s USING (user_id) GROUP BY ALL""")
def gainers(spark, d):
    """The roster's head with the last values of each member, oldest first."""
    e, order = table(spark, d, "events").select("user_id", "ts", "event_id", "value"), F.struct("ts", "event_id")
    head = e.groupBy("user_id").agg((F.max_by("value", order) - F.min_by("value", order)).alias("change")).orderBy(F.desc("change"), "user_id").limit(5)
    last = last_rows(e.join(F.broadcast(head), "user_id"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 8)  # five rows
    points = F.array_sort(F.collect_list(F.struct("ts", "event_id", F.round(F.col("value") * 100).cast("long").cast("string").alias("v"))))
    return last.groupBy("user_id", "change").agg(F.array_join(F.transform(points, lambda p: p["v"]), " ").alias("spark"))


@query("uia_11_calendar_horizon", """
    SELECT ts, 'earnings' AS kind, event_id FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
    UNION ALL SELECT ts, 'split', event_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' ORDER BY ts, kind, event_id LIMIT 100""")
def calendar_horizon(spark, d):
    """Several calendars as one, from now to ten days on, in order."""
    e = table(spark, d, "events").filter((F.col("ts") >= _ts("2024-01-10")) & (F.col("ts") < _ts("2024-01-20")))
    kind = F.when(F.col("event_type") == "signup", "earnings").when(F.col("event_type") == "error", "split")
    return e.select("ts", kind.alias("kind"), "event_id").filter("kind IS NOT NULL").orderBy("ts", "kind", "event_id").limit(100)


@query("uia_13_comparison", """
    WITH a AS (SELECT unnest([3, 5, 7, 100000]) AS user_id), b AS (SELECT user_id, event_id, value * 100 / nullif(first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS indexed FROM events WHERE user_id IN (FROM a))
    SELECT user_id, coalesce(event_id, -1) AS event_id, indexed, b.user_id IS NULL AS missing FROM a LEFT JOIN b USING (user_id)""")
def comparison(spark, d):
    """A few symbols on one scale, beside a list of those without data."""
    asked = [3, 5, 7, 100000]
    if len(asked) > 7:
        raise ValueError("seven symbols at most")
    a = spark.createDataFrame([(k,) for k in asked], "user_id long")
    first = F.first("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    b = table(spark, d, "events").filter(F.col("user_id").isin(asked)).select("user_id", "event_id", (F.col("value") * 100 / F.nullif(first, F.lit(0.0))).alias("indexed"), F.lit(True).alias("_there"))
    return a.join(b, "user_id", "left").select("user_id", F.coalesce("event_id", F.lit(-1)).alias("event_id"), "indexed", F.col("_there").isNull().alias("missing"))


@query("uia_14_match_count", "SELECT p_brand, count(*) AS total, CASE WHEN count(*) > 80 THEN '80 of ' || count(*) ELSE count(*)::VARCHAR END AS label FROM part GROUP BY 1")
def match_count(spark, d):
    """A cut is said, never hidden."""
    n = F.col("total").cast("string")
    return table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("total")).withColumn("label", F.when(F.col("total") > 80, F.concat(F.lit("80 of "), n)).otherwise(n))


@query("uia_15_default_columns", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size = 7")
def default_columns(spark, d):
    """A dataset's default columns, those of them that it has."""
    wanted = ["p_partkey", "p_name", "p_retailprice", "p_currency"]
    p = table(spark, d, "part").filter("p_size = 7")
    return p.select(*[c for c in wanted if c in p.columns])


@query("uia_17_recommendation_bars", """
    WITH n AS (SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY 1), r AS (SELECT o.o_custkey, o.o_orderpriority AS period, count(*) FILTER (o_orderstatus = 'F') AS buy, count(*) FILTER (o_orderstatus = 'O') AS hold, count(*) FILTER (o_orderstatus = 'P') AS sell
    FROM orders o JOIN n ON n.o_custkey = o.o_custkey AND o.o_orderdate > newest - INTERVAL 400 DAY GROUP BY ALL)
    SELECT o_custkey, period, unnest(['buy', 'hold', 'sell']) AS series, unnest([buy, hold, sell]) AS n FROM r""")
def recommendation_bars(spark, d):
    """The newest snapshot's periods as bars by series."""
    o = table(spark, d, "orders")
    newest = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("newest"))
    of = lambda k: F.count_if(F.col("o_orderstatus") == k)
    r = o.join(newest, "o_custkey").filter("o_orderdate > newest - INTERVAL 400 DAY").groupBy("o_custkey", F.col("o_orderpriority").alias("period")).agg(of("F").alias("buy"), of("O").alias("hold"), of("P").alias("sell"))
    return r.unpivot(["o_custkey", "period"], ["buy", "hold", "sell"], "series", "n")


@query("uia_18_market_board", """SELECT c_mktsegment AS market, c_custkey, upper(trim(c_name)) AS symbol, c_acctbal AS price, CASE WHEN c_acctbal > 0 THEN 'up' WHEN c_acctbal < 0 THEN 'down' ELSE 'flat' END AS direction FROM customer WHERE c_nationkey < 10""")
def market_board(spark, d):
    c = table(spark, d, "customer").filter("c_nationkey < 10")
    way = F.when(F.col("c_acctbal") > 0, "up").when(F.col("c_acctbal") < 0, "down").otherwise("flat")
    return c.select(F.col("c_mktsegment").alias("market"), "c_custkey", S.symbol(F.col("c_name")).alias("symbol"), F.col("c_acctbal").alias("price"), way.alias("direction"))
