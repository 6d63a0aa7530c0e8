"""Sampling of repeated rejects: so many rows of a key for each window, which begins with its first reject.

A window holds what comes within ``seconds`` of the reject that opened it; the first one later than that opens the next. So where a
window begins depends on all before it, and no clock hour tells.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .ranges import MOST, cut, running


def window_starts(rows: DataFrame, key: list[str], at: str, seconds: int = 3600, most: int | None = MOST) -> DataFrame:
    """key, ``at``: the instants that open a window, by pointer jumping over each key's sorted instants.

    Each instant points at the first one more than ``seconds`` later. An instant that follows a silence of more than that opens a
    window whatever came before. From these the starts are followed in doubling steps, so the rounds grow with the
    logarithm of the windows in a row; every round is a join by (key, instant), of which a key has as many as it has instants.
    Null keys are keys; null instants open nothing.
    """
    instants = rows.filter(F.col(at).isNotNull()).select(*key, F.col(at).alias("_at")).distinct()
    reach = F.col("_at") + F.expr(f"INTERVAL {int(seconds)} SECONDS")
    marks = instants.select(*key, F.col("_at").alias("_p"), F.lit(0).alias("_o"), F.col("_at").alias("_mark"), F.lit(None).cast(rows.schema[at].dataType).alias("_at"))
    both = cut(marks.unionByName(instants.select(*key, reach.alias("_p"), F.lit(1).alias("_o"), F.lit(None).cast(rows.schema[at].dataType).alias("_mark"), "_at")), key, ["_p", "_o"], most)
    # A mark stands before a probe of the same instant, so what is behind the probe is later.
    ahead = running(both, key, ["_p", "_o"], backward=True, _to=("last", F.col("_mark"))).filter("_o = 1").select(*key, "_at", "_to")
    quiet = running(cut(instants, key, ["_at"], most), key, ["_at"], _before=("last", F.col("_at")))
    first = quiet.filter(F.col("_before").isNull() | (F.col("_at") > F.col("_before") + F.expr(f"INTERVAL {int(seconds)} SECONDS"))).select(*key, "_at")

    def renamed(df: DataFrame, **names: str) -> DataFrame:
        """``df`` with its keys out of the way of another's."""
        return df.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(c).alias(n) for c, n in names.items()])

    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    jump, found = materialize(ahead.filter("_to IS NOT NULL"), "sample-jumps"), materialize(first, "sample-starts")
    while True:
        reached = found.join(renamed(jump, _at="_from", _to="_to"), [*same, F.col("_at") == F.col("_from")]).select(*key, F.col("_to").alias("_at")).distinct()
        new = materialize(reached.join(renamed(found, _at="_known"), [*same, F.col("_at") == F.col("_known")], "left_anti"), "sample-new")
        if not new.take(1):
            return found.withColumnRenamed("_at", at)
        found = materialize(found.unionByName(new), "sample-starts")
        jump = materialize(jump.join(renamed(jump, _at="_from", _to="_over"), [*same, F.col("_to") == F.col("_from")]).select(*key, "_at", F.col("_over").alias("_to")), "sample-jumps")


def sampled(rows: DataFrame, key: list[str], at: str, order: list[str], n: int, seconds: int = 3600, most: int | None = MOST) -> DataFrame:
    """The first ``n`` rows of every window, in the order of ``at`` and ``order``, with ``window_start`` and ``seen``, the rows of the window so far."""
    rows = rows.filter(F.col(at).isNotNull())
    starts = window_starts(rows, key, at, seconds, most).withColumn("_start", F.col(at)).withColumnsRenamed({c: f"_k_{c}" for c in [*key, at]})
    opened = rows.join(starts, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key] + [F.col(at) == F.col(f"_k_{at}")], "left").select(*rows.columns, "_start")
    placed = running(cut(opened, key, [at, *order], most), key, [at, *order], _last=("last", F.col("_start")))
    placed = placed.withColumn("window_start", F.coalesce("_start", "_last"))
    w = Window.partitionBy(*key, "window_start").orderBy(at, *order)
    return placed.withColumn("seen", F.row_number().over(w)).filter(F.col("seen") <= n).select(*rows.columns, "window_start", "seen")  # a task keeps n rows a window before they travel


def sampled_stream(rows: DataFrame, key: list[str], at: str, order: list[str], n: int, seconds: int = 3600) -> DataFrame:
    """The same rows of a stream whose rejects come in order: keyed state holds a window's start and count, whatever the number of batches between."""
    kinds = {f.name: f.dataType for f in rows.schema}
    out = T.StructType([*rows.schema.fields, T.StructField("window_start", kinds[at]), T.StructField("seen", T.IntegerType())])
    state = T.StructType([T.StructField("start_us", T.LongType()), T.StructField("seen", T.IntegerType())])
    span = pd.Timedelta(seconds=seconds)

    def step(_, parts: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        start, seen = held.get if held.exists else (None, 0)
        start = None if start is None else pd.Timestamp(start, unit="us")
        got = pd.concat(list(parts)).sort_values([at, *order], kind="stable")
        kept, starts, counts = [], [], []
        for i, now in enumerate(got[at]):
            if now is pd.NaT:
                continue
            if start is None or now - start > span:
                start, seen = now, 0
            if seen < n:
                seen += 1
                kept.append(i), starts.append(start), counts.append(seen)
        if start is not None:
            held.update((int(start.value // 1000), seen))
        yield got.iloc[kept].assign(window_start=pd.Series(starts, dtype="datetime64[ns]").values, seen=pd.Series(counts, dtype="int32").values)

    return rows.groupBy(*key).applyInPandasWithState(step, out, state, "append", "NoTimeout")
