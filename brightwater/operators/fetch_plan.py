"""Which ranges of bars to fetch: first fills, continued ones, explicit ranges, open gaps, and what can no longer be had.

One plan over all (symbol, interval) rows. A source answers only so many days a request, and only so many days back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import MOST
from .series import merged_ranges

# Interval, days a request may span, days back that are still to be had; None: no bound.
LIMITS = {"1m": (8, 29), "5m": (59, 59), "15m": (59, 59), "60m": (729, 729), "1wk": (None, None), "1mo": (None, None)}


def _limit(interval: Column, at: int) -> Column:
    pairs = [x for name, bounds in LIMITS.items() if bounds[at] is not None for x in (F.lit(name), F.lit(bounds[at]))]
    return F.element_at(F.create_map(*pairs), interval)  # null where there is no bound


def plan_fetches(scopes: DataFrame, open_gaps: DataFrame, overlap_days: int = 2, most: int | None = MOST) -> DataFrame:
    """symbol, bar_interval, kind, range_start, range_end (instants; the end is exclusive).

    scopes: symbol, bar_interval, watermark (an instant, null: nothing is stored), today (a date), from_day and to_day (dates, null where not asked for); one row for a symbol and
    interval. open_gaps: symbol, bar_interval, gap_start, gap_end (instants).

    kind ``window``: a request, no longer than the interval allows. ``expired``: from the watermark to the first day that is still to be had,
    never to be fetched. ``all``: a first fill of an interval without bounds, both ends null.
    An explicit range ignores watermark, depth and gaps; a bound that is missing is ``overlap_days`` ago, or today. Without a watermark everything
    still to be had is asked for. Otherwise it goes on ``overlap_days`` before the watermark, and open gaps whose first day is still to be had are ranges of their own,
    their last day included, so that an old gap doesn't fetch all days since. Ranges that overlap or touch are one before they are sliced.
    Rows of an unknown interval are refused. Null symbols have no plan; an empty table has none.
    """
    unknown = F.raise_error(F.concat(F.lit("unknown interval: "), F.coalesce("bar_interval", F.lit("null"))))
    known = F.when(F.col("bar_interval").isin(*LIMITS), F.col("bar_interval")).otherwise(unknown)
    rows = scopes.filter("symbol IS NOT NULL").withColumn("bar_interval", known)
    rows = rows.withColumn("_per", _limit(F.col("bar_interval"), 0)).withColumn("_earliest", F.date_sub("today", _limit(F.col("bar_interval"), 1)))
    explicit = F.col("from_day").isNotNull() | F.col("to_day").isNotNull()
    back = F.date_sub(F.to_date("watermark"), overlap_days)
    late = F.coalesce(back < F.col("_earliest"), F.lit(False))
    mode = F.when(explicit, "explicit").when(F.col("watermark").isNotNull(), "on").when(F.col("_earliest").isNull(), "all").otherwise("first")
    start = (F.when(explicit, F.coalesce("from_day", F.date_sub("today", overlap_days))).when(mode == "first", F.col("_earliest")).when(late, F.col("_earliest")).otherwise(back))
    rows = rows.withColumns({"_mode": mode, "_start": start, "_end": F.when(explicit, F.coalesce("to_day", "today")).otherwise(F.col("today")), "_late": late})

    key = ["symbol", "bar_interval"]
    asked = rows.filter("_mode != 'all'").select(*key, F.col("_start").alias("a"), F.col("_end").alias("b"))
    on = rows.filter("_mode = 'on'").select(*key, "today", "_earliest")
    gaps = open_gaps.join(on, key).select(*key, F.to_date("gap_start").alias("a"), F.least(F.date_add(F.to_date("gap_end"), 1), F.col("today")).alias("b"), "_earliest")
    gaps = gaps.filter("_earliest IS NULL OR a >= _earliest").drop("_earliest")
    merged = merged_ranges(asked.unionByName(gaps).filter("a < b"), key, "a", "b", most)

    per = _limit(F.col("bar_interval"), 0)
    first = F.when(per.isNull(), F.array("a")).otherwise(F.transform(F.sequence(F.lit(0), F.floor((F.date_diff("b", "a") - 1) / per).cast("int")), lambda k: F.date_add(F.col("a"), k * per)))
    slices = merged.withColumn("w", F.explode(first))
    instant = lambda c: c.cast("timestamp_ntz")
    windows = slices.select(*key, F.lit("window").alias("kind"), instant(F.col("w")).alias("range_start"), instant(F.when(per.isNull(), F.col("b")).otherwise(F.least(F.date_add("w", per), F.col("b")))).alias("range_end"))
    lost = rows.filter("_mode = 'on' AND _late").select(*key, F.lit("expired").alias("kind"), instant(F.col("watermark")).alias("range_start"), instant(F.col("_earliest")).alias("range_end"))
    none = F.lit(None).cast("timestamp_ntz")
    whole = rows.filter("_mode = 'all'").select(*key, F.lit("all").alias("kind"), none.alias("range_start"), none.alias("range_end"))
    return windows.unionByName(lost).unionByName(whole)
