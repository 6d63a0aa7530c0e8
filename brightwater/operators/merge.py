"""Idempotent merges as joins: dedupe, upsert, monotonic and guarded columns, scope replacement, change events.

A target and what comes in are DataFrames; a merge gives the new target, to be written beside the old
one and swapped in. Each needs one shuffle by key on either side, none of the target if that is bucketed by it (``layout``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WriteSpec:
    """How a table takes rows. update None: all columns that are no keys; [] : existing rows stay."""

    table: str
    keys: list[str]
    update: list[str] | None = None
    monotonic: list[str] = field(default_factory=list)
    guard: str | None = None
    volatile: list[str] = field(default_factory=list)


def last_wins(rows: DataFrame, keys: list[str], seq: list[str], monotonic: list[str] = (), guard: str | None = None, present: dict[str, Column] | None = None) -> DataFrame:
    """A row per key, as if each row of a key, in the order of ``seq``, were laid over what the key holds so far.

    Without a guard fields overlay one by one: a column named in ``present`` only by rows in which that holds (a null that is present
    counts), all other columns by every row; ``monotonic`` columns take the maximum. With a guard rows replace each other whole, unless the
    one that comes is known to be older: both guards are there and its own is less. So a row without a guard always replaces, and
    whatever follows replaces it; after the last of these, the highest guard wins, ties to the later.

    All of it is ``max_by``, which combines on the map side, so repeated keys don't travel.
    """
    others, at = [c for c in rows.columns if c not in keys], F.struct(*seq)
    if guard is None:
        def overlaid(c: str) -> Column:
            if c in monotonic:
                return F.max(c)
            held = F.max_by(F.struct(c), F.when(present[c], at) if present and c in present else at)  # a struct, so that nulls are taken too
            return held[c]

        return rows.groupBy(*keys).agg(*[overlaid(c).alias(c) for c in others]).select(*keys, *others)
    if rows.schema[guard].nullable:
        # Rows before a key's last one without a guard can't win.
        resets = rows.filter(F.col(guard).isNull()).groupBy(*keys).agg(F.max(at).alias("_reset")).withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        rows = rows.join(resets, same, "left").filter(F.col("_reset").isNull() | (at >= F.col("_reset"))).select(*keys, *others)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(guard, *seq)).alias("_r"))  # a null guard sorts first
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in others])


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(True))


def classified(target: DataFrame, incoming: DataFrame, spec: WriteSpec, scope: DataFrame | None = None) -> DataFrame:
    """Every row of the new target, and deleted ones, with ``_op``: insert, update, same, kept or delete.

    ``scope`` lists key prefixes that are replaced: their rows that don't come in are deleted, even if nothing comes in.
    """
    others = [c for c in target.columns if c not in spec.keys]
    update = [c for c in (others if spec.update is None else spec.update) if c in incoming.columns]
    old, new = target.withColumn("_old", F.lit(True)), incoming.withColumn("_new", F.lit(True))
    if scope is not None:
        old = old.join(scope.distinct().withColumn("_scoped", F.lit(True)), scope.columns, "left")
    else:
        old = old.withColumn("_scoped", F.lit(None).cast("boolean"))
    both = old.alias("t").join(new.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in spec.keys], "full")
    inside, arrived = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()
    applies = arrived if spec.guard is None else arrived & (F.coalesce(F.col(f"s.{spec.guard}") > F.col(f"t.{spec.guard}"), F.lit(False)) | ~inside)

    def merged(c: str) -> Column:
        mine, its = F.col(f"t.{c}"), F.col(f"s.{c}") if c in incoming.columns else F.lit(None).cast(target.schema[c].dataType)
        if c in spec.monotonic:
            return F.greatest(mine, its)
        taken = its if c in update else mine
        return F.when(~inside, its).when(applies, taken).otherwise(mine)

    compared = [c for c in update if c not in spec.volatile and c not in spec.monotonic]
    moved = reduce(lambda a, b: a | b, [F.coalesce(F.col(f"s.{c}") > F.col(f"t.{c}"), F.col(f"t.{c}").isNull() & F.col(f"s.{c}").isNotNull()) for c in spec.monotonic if c in incoming.columns], F.lit(False))
    op = (F.when(~inside, "insert").when(~arrived & F.col("t._scoped"), "delete").when(~arrived, "kept")
          .when(applies & (~_same("t", "s", compared) | moved), "update").otherwise("same"))
    return both.select(*[F.coalesce(f"t.{k}", f"s.{k}").alias(k) for k in spec.keys], *[merged(c).alias(c) for c in others], op.alias("_op"))


def merge(target: DataFrame, incoming: DataFrame, spec: WriteSpec, scope: DataFrame | None = None) -> DataFrame:
    return classified(target, incoming, spec, scope).filter("_op != 'delete'").select(*target.columns)


def insert_missing(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(incoming.join(target, keys, "left_anti"), allowMissingColumns=True)


def replace_scope(target: DataFrame, incoming: DataFrame, scope: DataFrame) -> DataFrame:
    """Everything in scope goes, even if nothing comes in."""
    return target.join(scope, scope.columns, "left_anti").select(*target.columns).unionByName(incoming)


def change_events(changes: DataFrame, spec: WriteSpec, span: int | None = None, range_col: str | None = None) -> DataFrame:
    """op, key, row (JSON text). More than ``span`` inserts of one leading key become a single range event."""
    rows = changes.filter(F.col("_op").isin("insert", "update", "delete"))
    as_row = lambda df: df.select(F.col("_op").alias("op"), F.to_json(F.struct(*spec.keys)).alias("key"),
                                  F.when(F.col("_op") != "delete", F.to_json(F.struct(*[c for c in changes.columns if c != "_op"]))).alias("row"))
    if span is None:
        return as_row(rows)
    lead = spec.keys[0]
    many = rows.filter("_op = 'insert'").groupBy(lead).agg(F.min(range_col).alias("first"), F.max(range_col).alias("last"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > span)
    ranges = many.select(F.lit("range").alias("op"), F.to_json(F.struct(lead)).alias("key"), F.to_json(F.struct("first", "last", "n")).alias("row"))
    few = rows.join(many.select(lead, F.lit("insert").alias("_op")), [lead, "_op"], "left_anti")
    return as_row(few).unionByName(ranges)


def verified(stored: DataFrame, attempted: DataFrame, keys: list[str]) -> DataFrame:
    """attempted, verified: distinct keys that were to be written, and those read back."""
    tried = attempted.select(*keys).distinct()
    seen = tried.join(stored.select(*keys).distinct().withColumn("_seen", F.lit(1)), keys, "left")
    return seen.agg(F.count(F.lit(1)).alias("attempted"), F.count("_seen").alias("verified"))
