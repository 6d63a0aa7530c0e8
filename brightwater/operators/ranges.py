"""Scans along a key's rows in two levels, so that a key of any size is many tasks' work.

Rows are cut into ranges of (key, order); a window runs within a key's range, and what the ranges before hand on, one
row for each key and range, is worked out apart and joined. Where no key is large nothing is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Rows of a key that one task takes.
MOST = 1_000_000


def cut(rows: DataFrame, key: list[str], order: list[str], most: int | None = MOST) -> DataFrame:
    """``rows`` with ``_range``, where a key has more than ``most`` rows: ranges of (key, order) with about half of that each.

    Without ``most`` a key's rows are known to be few.
    """
    if most is None:
        return rows
    held = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    if (held["most"] or 0) <= most:
        return rows
    parts = max(2, -(-2 * held["total"] // most))
    return materialize(rows.repartitionByRange(parts, *key, *order).withColumn("_range", F.spark_partition_id()), "ranges")


_KINDS = {"max": F.max, "sum": F.sum, "last": lambda c: F.last(c, ignorenulls=True), "first": lambda c: F.first(c, ignorenulls=True)}
_JOINED = {"max": F.greatest, "sum": lambda far, near: F.coalesce(far, F.lit(0)) + F.coalesce(near, F.lit(0)), "last": lambda far, near: F.coalesce(near, far), "first": F.coalesce}


def running(rows: DataFrame, key: list[str], order: list[str], backward: bool = False, **values: tuple[str, Column]) -> DataFrame:
    """``rows`` (as ``cut`` left them) with what holds over all rows of a key before each, not counting the row itself.

    values: for a new column its kind (max, sum, last, first; nulls are passed over) and what it is taken of.
    backward: over the rows behind instead. No two rows of a key may tie in ``order`` if that makes a difference.
    """
    side = [F.desc(c) if backward else F.asc(c) for c in order]
    ranged = "_range" in rows.columns
    own = rows.withColumns({f"_v_{name}": value for name, (_, value) in values.items()})
    w = Window.partitionBy(*key, *["_range"] * ranged).orderBy(*side).rowsBetween(Window.unboundedPreceding, -1)
    if not ranged:
        return own.withColumns({name: _KINDS[kind](f"_v_{name}").over(w) for name, (kind, _) in values.items()}).drop(*[f"_v_{n}" for n in values])
    # What a range hands on: its last or first value is that of the greatest or least place.
    place = F.struct(*order)
    ends = {"last": F.min_by if backward else F.max_by, "first": F.max_by if backward else F.min_by}
    per = own.groupBy(*key, "_range").agg(*[
        (ends[kind](f"_v_{name}", F.when(F.col(f"_v_{name}").isNotNull(), place)) if kind in ends else _KINDS[kind](f"_v_{name}")).alias(f"_p_{name}") for name, (kind, _) in values.items()])
    over = Window.partitionBy(*key).orderBy(F.desc("_range") if backward else F.asc("_range")).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    per = per.select(*[F.col(k).alias(f"_k_{k}") for k in [*key, "_range"]], *[_KINDS[kind](f"_p_{name}").over(over).alias(f"_f_{name}") for name, (kind, _) in values.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in [*key, "_range"]]
    out = own.join(per, same, "left")
    out = out.withColumns({name: _JOINED[kind](F.col(f"_f_{name}"), _KINDS[kind](f"_v_{name}").over(w)) for name, (kind, _) in values.items()})
    return out.select(*rows.columns, *values)
