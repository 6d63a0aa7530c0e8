"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow. Its documents are shuffled by a keyed digest and queue one behind the
other, pass after pass; a copy's virtual finish time is the words of its source up to and
including it, divided by the source's target. Ordering all copies by finish time serves the
sources side by side in proportion to their targets, and cutting that order where the budget
is used up leaves each source within about a document of its target.

No window ever spans a source or the whole table: running sums are made in two levels, over
digest ranges within a source and over ranges of finish time. Only DataFrame functions are used.

Nulls: a null text has size 0 and takes nothing; a null source is a source of its own, last in
code point order; a null id is shuffled as a value of its own. Repeated rows are documents of
their own. Sources without words get target 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD

#: Rows that a window's partition holds at most, about; there are 4096 ranges at least.
RANGE_ROWS = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """flow, source_size, target: ``share`` of all words dealt by weight, none above ``most`` times its source.

    Sources that meet their ceiling first are those of least size per weight. So one pass in
    that order decides each: it is full if the rate left for it would lift it above its ceiling.
    A row per source stands here, never a row per document.
    """
    per = sizes.groupBy("flow").agg(F.sum("size").alias("source_size"))
    ranked = Window.orderBy("flow")
    at = (F.row_number().over(ranked) - 1) % len(weights) + 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), at.cast("int")).cast("long"))
    by_ceiling = Window.orderBy(F.col("source_size") / F.col("weight"), "flow")
    before = by_ceiling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(share)
    left = budget - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("rate", left / weight_left).withColumn("ceiling", F.lit(most) * F.col("source_size"))
    per = per.withColumn("full", F.col("ceiling") <= F.col("weight") * F.col("rate"))
    # Once a source isn't full, none behind it is: all of them share the first such rate.
    rate = F.first(F.when(~F.col("full"), F.col("rate")), ignorenulls=True).over(
        by_ceiling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("full"), F.col("ceiling").cast("double")).otherwise(
        F.least(F.col("ceiling").cast("double"), F.col("weight") * rate))
    return per.select("flow", "source_size", target.cast("double").alias("target"))


def _running(df: DataFrame, groups: list[str], order: list) -> DataFrame:
    """Adds ``before``: the sum of sizes over the rows of the first group column that come earlier.

    The last group column is a range of the order; sums by range give each range its start.
    """
    sums = df.groupBy(*groups).agg(F.sum("size").alias("_s"))
    outer = Window.partitionBy(*groups[:-1]).orderBy(groups[-1]).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*groups, F.coalesce(F.sum("_s").over(outer), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, groups)
    return joined.withColumn("before", F.col("_start") + F.coalesce(F.sum("size").over(inner), F.lit(0))).drop("_start")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *more: Column) -> DataFrame:
    source, doc_id = F.col(f"`{source_col}`"), F.col(f"`{id_col}`")
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return docs.select(*more, doc_id.alias("id"), digest.alias("digest"), source.alias("source"),
                       # A flow's name sorts as its source does by code point, and null comes last.
                       F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source.cast("string"))).alias("flow"),
                       F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def fair_queue(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: str = "mix", few_ranges: int = 16) -> DataFrame:
    """A row per document and pass: id, source, size, source_size, target, pass, finish, served (boolean).

    Ordered by (finish, source, digest, id, pass), the served rows are the mix. ``weights``
    repeat over the sources in code point order. Up to 2**few_ranges ranges, what is decided of each is broadcast.
    """
    sizes = _sized(docs, id_col, text_col, source_col, seed, F.monotonically_increasing_id().alias("row_no"))
    sizes = materialize(sizes, "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, most), "mix-targets")
    # Leading hex digits are ranges of the shuffled order within each flow: 4096, and more where there are more rows.
    digits, n_rows = 3, sizes.count()
    while 16**digits * RANGE_ROWS < n_rows:
        digits += 1
    # All rows without an id share one digest: before, at and after it are ranges of their own, and at it one for each size; rows of size 0 may be split in any way.
    prefix, odd = F.substring("digest", 1, digits), F.md5(F.lit(f"{seed}|null").cast("binary"))
    split = F.concat(F.lpad(F.least("size", F.lit(4095)).cast("string"), 4, "0"), F.when(F.col("size") == 0, F.lpad(F.pmod(F.xxhash64("row_no"), F.lit(1024)).cast("string"), 4, "0")).otherwise(""))
    part = F.when(F.col("digest") == odd, F.concat(F.lit("1"), split)).when((prefix == F.substring(odd, 1, digits)) & (F.col("digest") > odd), "2").otherwise("0")
    queued = _running(sizes.withColumn("range", F.concat(prefix, part)), ["flow", "range"], ["digest", "id", "size", "row_no"])
    queued = materialize(queued.drop("range").join(targets, "flow"), "mix-queued")

    passes = [queued.withColumn("pass", F.lit(k)).withColumn("finish", (F.col("before") + F.col("size") + F.lit(k) * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0)))
              for k in range(most)]
    copies = passes[0]
    for p in passes[1:]:
        copies = copies.unionByName(p)
    copies = copies.drop("before")
    # Range-sorted by finish time: few copies share a slice, and a slice's start follows from sums.
    ranges = 16**digits
    copies = copies.withColumn("slice", F.least(F.floor(F.coalesce(F.col("finish"), F.lit(float(most + 1))) * ranges), F.lit(ranges * (most + 2))).cast("long"))
    budget = targets.agg(F.sum("target").alias("budget"))
    slices = copies.groupBy("slice").agg(F.sum("size").alias("s"))  # at most ranges * (most + 2) rows
    run = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("slice").alias("_slice"), F.coalesce(F.sum("s").over(run), F.lit(0)).alias("base"), "s")
    slices = slices.crossJoin(F.broadcast(budget))  # one row
    cut = slices.withColumn("state", F.when(F.col("base") + F.col("s") <= F.col("budget"), "all").when(F.col("base") > F.col("budget"), "none").otherwise("some"))
    cut = cut.select("_slice", "base", "budget", "state")
    # A row a slice: broadcast while that is a few thousand rows, otherwise the planner decides by size. Slices are even but for the two that hold
    # copies without a finish and all those far behind it: their rows meet a broadcast, so a shuffle is even too.
    far, same = [ranges * (most + 1), ranges * (most + 2)], copies["slice"] == cut["_slice"]
    joined = copies.join(F.broadcast(cut), same) if ranges <= 1 << few_ranges else copies.filter(~F.col("slice").isin(far)).join(cut, same).unionByName(
        copies.filter(F.col("slice").isin(far)).join(F.broadcast(cut.filter(F.col("_slice").isin(far))), same))  # two rows
    joined = joined.drop("_slice")
    inner = Window.partitionBy("slice").orderBy("finish", "flow", "digest", "id", "size", "row_no", "pass")
    edge = joined.filter("state = 'some'").withColumn("upto", F.col("base") + F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    edge = edge.withColumn("served", (F.col("upto") <= F.col("budget")) & (F.col("target") > 0)).drop("upto")
    sure = joined.filter("state != 'some'").withColumn("served", (F.col("state") == "all") & (F.col("target") > 0))
    return sure.unionByName(edge).drop("slice", "base", "budget", "state")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """A row per document: id, size, source_size, target, taken (words of it in the mix, repeats counted)."""
    copies = fair_queue(docs, id_col=id_col, **options)
    taken = F.sum(F.when(F.col("served"), F.col("size")).otherwise(F.lit(0)))
    firsts = [F.first(c).alias(c) for c in ("id", "size", "source_size", "target")]
    out = copies.groupBy("row_no").agg(*firsts, taken.cast("long").alias("taken"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def repeat_by_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **options) -> DataFrame:
    """The mix as documents: each row of ``docs`` as often as the mix takes it, with its own columns.

    In each pass, what is served of a source is a prefix of its shuffled order, so a row per
    source and pass says where the prefix ends, and texts need neither a shuffle nor a join by
    id. Rows alike in id and size are taken together.
    """
    copies = fair_queue(docs, id_col, text_col, source_col, seed=seed, **options)
    ends = copies.filter("served").groupBy("flow", "pass").agg(F.max(F.struct("digest", "id", "size")).alias("end"))
    ends = materialize(ends.groupBy("flow").agg(F.collect_list("end").alias("ends")), "mix-ends")
    rows = _sized(docs.select(F.struct("*").alias("doc"), *[docs[c] for c in {id_col, text_col, source_col}]), id_col, text_col, source_col, seed, F.col("doc"))
    own = F.struct("digest", "id", "size")
    # The ends of a source are as many as there are passes.
    times = F.size(F.filter("ends", lambda e: own <= e))
    taken = rows.join(ends, "flow").withColumn("times", times).filter("times > 0")
    return taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("again")).select("doc.*")
