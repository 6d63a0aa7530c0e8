"""Time series: bars, sessions, as-of markers, ranges, gaps, rescales and indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import MOST, cut, running


def order_key(rows: DataFrame, order: list[str]) -> Column:
    """A number that orders rows as ``order`` does: one or two columns of instants or whole numbers, the first one foremost. Null stands before all others.

    A struct orders too, but no hash aggregate keeps one in its buffers: rows would be sorted by key before they are combined.
    """
    def whole(c: str) -> Column:
        kind = rows.schema[c].dataType.typeName()
        if kind in ("timestamp", "timestamp_ntz"):
            return F.unix_micros(F.col(c).cast("timestamp"))
        if kind == "date":
            return F.unix_date(c).cast("long")
        if kind in ("byte", "short", "integer", "long"):
            return F.col(c).cast("long")
        raise ValueError(f"{c} is neither a whole number nor an instant")

    if len(order) == 1:
        return F.coalesce(whole(order[0]), F.lit(-(2**63)))
    first, second = order
    # 2**64 of the second for each of the first: 38 digits are enough for any instant up to the year 9999, and for numbers up to 5 * 10**18.
    foremost = F.coalesce(whole(first), F.lit(-5 * 10**18)).cast("decimal(19,0)")
    return foremost * F.lit(str(2**64)).cast("decimal(38,0)") + F.coalesce(whole(second), F.lit(-(2**63))).cast("decimal(38,0)")


def ohlc(ticks: DataFrame, key: list[str], bucket: Column, price: str, order: list[str]) -> DataFrame:
    """One hash aggregate, combined by the map tasks: first and last are ``min_by`` and ``max_by`` over a number that orders as ``order`` does."""
    at = order_key(ticks, order)
    return ticks.groupBy(*key, bucket.alias("bar_ts")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"))


#: Stands before everything that arrives.
_SEED = -(2**63)


def folded_candles(ticks: DataFrame, key: list[str], at: str, price: str, arrival: str, seconds: int, last: DataFrame | None = None, most: int | None = MOST) -> DataFrame:
    """key, bar_ts, open, high, low, close: the bars that ticks draw, one after the other in the order of ``arrival`` (a whole number).

    A tick of a later bucket than any before opens a bar at its price on all four legs, one of the same bucket extends the bar, and one of an older bucket is ignored,
    however many come: a bar that was left is closed. ``last``: the bar to go on from, of the same columns, at most one a key. Ticks without a price or an instant are ignored.
    Which bucket is reached is a running maximum, so order needs no state and a key's ticks are as many tasks' as they need.
    """
    instant = ticks.schema[at].dataType
    bucket = F.timestamp_seconds(F.floor(F.unix_timestamp(F.col(at).cast("timestamp")) / seconds) * seconds).cast(instant)
    legs = ["open", "high", "low", "close"]
    rows = ticks.filter(F.col(price).isNotNull() & F.col(at).isNotNull()).select(*key, F.col(arrival).cast("long").alias("_a"), bucket.alias("bar_ts"), *[F.col(price).alias(c) for c in legs])
    if last is not None:
        rows = rows.unionByName(last.select(*key, F.lit(_SEED).alias("_a"), "bar_ts", *legs))
    reached = running(cut(rows, key, ["_a"], most), key, ["_a"], _reach=("max", F.col("bar_ts")))
    drawn = reached.filter("_reach IS NULL OR bar_ts >= _reach")
    return drawn.groupBy(*key, "bar_ts").agg(F.min_by("open", "_a").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "_a").alias("close"))


def extended_sessions(ticks: DataFrame, key: list[str], at: str, price: str, arrival: str, last: DataFrame) -> DataFrame:
    """``last`` (key, bar_ts, open, high, low, close; one daily bar a key) brought up to date by the ticks of its own UTC day. Other ticks draw nothing, as a
    session's bar begins with the session and where the next one would begin isn't known. Ticks are summed up by key and day before they meet their bar."""
    rows = ticks.filter(F.col(price).isNotNull() & F.col(at).isNotNull())
    day = rows.groupBy(*key, F.to_date(at).alias("_d")).agg(F.max(price).alias("_h"), F.min(price).alias("_l"), F.max_by(price, F.col(arrival).cast("long")).alias("_c"))
    bars = last.withColumn("_d", F.to_date("bar_ts")).join(day, [*key, "_d"], "left")
    return bars.select(*key, "bar_ts", "open", F.greatest("high", "_h").alias("high"), F.least("low", "_l").alias("low"), F.coalesce("_c", "close").alias("close"))


def as_of_forward(actions: DataFrame, candles: DataFrame, key: list[str], at: str, value: str, most: int | None = MOST) -> DataFrame:
    """Each action with the first candle at or after it. Those before the first or after the last candle are dropped.

    Union and a two-level scan by key: no pairs of actions and candles are made, and a key's rows are as many tasks' as it needs. A key has one candle at an instant.
    """
    tagged = actions.withColumn("_c", F.lit(None).cast("struct<at:%s,value:%s>" % (candles.schema[at].dataType.simpleString(), candles.schema[value].dataType.simpleString()))).withColumn("_o", F.lit(0))
    marks = candles.select(*key, at, F.struct(F.col(at).alias("at"), F.col(value).alias("value")).alias("_c"), F.lit(1).alias("_o"))
    both = cut(tagged.unionByName(marks, allowMissingColumns=True), key, [at, "_o"], most)
    # At one instant the action stands before the candle, so the candle is behind it.
    out = running(both, key, [at, "_o"], backward=True, _n=("last", F.col("_c")))
    out = running(out, key, [at, "_o"], _s=("max", F.col("_o")))
    out = out.filter("_o = 0 AND _n IS NOT NULL").filter((F.col("_s") == 1) | (F.col("_n.at") == F.col(at)))
    return out.select(*actions.columns, F.col("_n.at").alias("candle_ts"), F.col("_n.value").alias("candle_value"))


def merged_ranges(ranges: DataFrame, key: list[str], start: str, end: str, most: int | None = MOST) -> DataFrame:
    """Overlapping or touching ranges become one. A key's ranges are as many tasks' as it needs: what is handed on is how far those before reach."""
    rows = cut(ranges.select(*key, start, end), key, [start, end], most)
    reached = running(rows, key, [start, end], _reach=("max", F.col(end)))
    marked = reached.withColumn("_new", F.coalesce((F.col(start) > F.col("_reach")).cast("int"), F.lit(1)))
    island = running(marked, key, [start, end], _i=("sum", F.col("_new"))).withColumn("_i", F.coalesce("_i", F.lit(0)) + F.col("_new"))
    return island.groupBy(*key, "_i").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_i")


def inside(points: DataFrame, windows: DataFrame, key: list[str], at: str, start: str, end: str, most: int | None = MOST) -> DataFrame:
    """Rows of ``points`` whose instant lies in a half-open window of their key, each once. Windows may overlap and be empty.

    Windows are merged first; the last one to have begun tells then, which is a scan and no join: time grows with points and windows, not with their pairs.
    """
    whole = merged_ranges(windows.filter(F.col(start) < F.col(end)), key, start, end, most)
    marks = whole.select(*key, F.col(start).alias("_p"), F.lit(0).alias("_o"), F.col(end).alias("_e"))
    tagged = points.withColumns({"_p": F.col(at), "_o": F.lit(1), "_e": F.lit(None).cast(windows.schema[end].dataType)}).filter(F.col(at).isNotNull())
    both = running(cut(tagged.unionByName(marks, allowMissingColumns=True), key, ["_p", "_o"], most), key, ["_p", "_o"], _until=("last", F.col("_e")))
    return both.filter("_o = 1 AND _p < _until").select(*points.columns)


def sliced(ranges: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Half-open day ranges in windows of at most ``days`` days."""
    firsts = F.sequence(F.col(start), F.date_sub(F.col(end), 1), F.expr(f"INTERVAL {days} DAYS"))
    out = ranges.filter(F.col(start) < F.col(end)).withColumn("window_start", F.explode(firsts))
    return out.withColumn("window_end", F.least(F.date_add("window_start", days), F.col(end)))


def out_of_session(bars: DataFrame, sessions: DataFrame, day: str, ts: str) -> DataFrame:
    """Adds ``is_extended``; a day without a session counts as regular. sessions: day, opens, closes."""
    out = bars.join(sessions, day, "left")
    return out.withColumn("is_extended", F.coalesce((F.col(ts) < F.col("opens")) | (F.col(ts) >= F.col("closes")), F.lit(False))).drop("opens", "closes")


def gaps(ticks: DataFrame, key: list[str], ts: str, seconds: int, most: int | None = MOST) -> DataFrame:
    """(key, gap_start, gap_end) where two neighbours are further apart, each instant taken to its nearest whole second (halves to the even one)."""
    rows = cut(ticks.select(*key, ts), key, [ts], most)
    nxt = running(rows, key, [ts], backward=True, gap_end=("last", F.col(ts))).withColumnRenamed(ts, "gap_start")
    whole = lambda c: F.rint(F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000).cast("long")
    return nxt.filter(whole("gap_end") - whole("gap_start") > seconds).select(*key, "gap_start", "gap_end")


def last_rows(rows: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def index_to_100(rows: DataFrame, key: list[str], at: str, value: str, most: int | None = MOST) -> DataFrame:
    """Adds ``indexed``: 100 at the first row of a key; null where that is 0."""
    boxed = F.struct(F.col(value).alias("v"))  # a first value that is null is one too
    out = running(cut(rows, key, [at], most), key, [at], _first=("first", boxed))
    first = F.coalesce("_first", boxed)["v"]
    return out.withColumn("indexed", F.col(value) * 100 / F.nullif(first, F.lit(0.0))).select(*rows.columns, "indexed")


def changes(rows: DataFrame, key: list[str], at: str, value: str, most: int | None = MOST) -> DataFrame:
    """Adds the value before, and the change from it, as a number and in per cent."""
    out = running(cut(rows, key, [at], most), key, [at], _prev=("last", F.struct(F.col(value).alias("v")))).withColumn("prev", F.col("_prev.v"))
    out = out.withColumn("change", F.col(value) - F.col("prev")).withColumn("change_pct", (F.col(value) - F.col("prev")) / F.nullif(F.col("prev"), F.lit(0.0)) * 100)
    return out.select(*rows.columns, "prev", "change", "change_pct")


#: Intervals whose stored bars a split rescales; longer ones come adjusted.
INTRADAY = ("1m", "5m", "15m", "60m")


def rescaled(bars: DataFrame, splits: DataFrame, key: str, prices: list[str], volume: str, at: str = "ts_utc", interval: str | None = None) -> DataFrame:
    """Bars before a split's boundary: prices over its ratio, volume times its ratio, rounded down; one split after the other.

    splits: key, boundary (of the type of ``at``), ratio (a decimal; those of 0 or less are passed over). Prices are decimals of twelve places, and each
    split rounds as a stored row would. Only intraday bars change where ``interval`` is named. A key's splits travel as one short list, not as pairs with its bars.
    """
    lists = splits.filter("ratio > 0").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("boundary", F.col("ratio").cast("decimal(20,10)").alias("ratio")))).alias("_s"))
    mine = F.filter("_s", lambda s: s["boundary"] > F.col(at))
    if interval:
        mine = F.when(F.col(interval).isin(*INTRADAY), mine)
    out = bars.join(lists, key, "left").withColumn("_s", F.coalesce(mine, F.filter("_s", lambda s: F.lit(False)), F.array().cast(lists.schema["_s"].dataType)))
    over = lambda c: F.aggregate("_s", F.col(c).cast("decimal(28,12)"), lambda a, s: (a / s["ratio"]).cast("decimal(28,12)"))
    times = F.aggregate("_s", F.col(volume).cast("decimal(18,0)"), lambda a, s: F.floor(a * s["ratio"]).cast("decimal(18,0)"))
    return out.withColumns({**{c: over(c) for c in prices}, volume: times.cast("bigint")}).drop("_s")


def tail_folded(rows: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The n - 1 largest and one row for all others. Only the top is ranked, so no window spans the table."""
    top = rows.orderBy(F.col(value).desc(), F.col(key).asc()).limit(n - 1)
    rest = rows.join(top.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("_k"), F.sum(value).alias(value)).filter("_k > 0")
    return top.select(key, value).unionByName(rest.select(F.concat(F.lit("Other ("), F.col("_k").cast("string"), F.lit(")")).alias(key), value))
