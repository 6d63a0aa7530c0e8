"""Hash gates: what hasn't changed since it was last stored isn't written again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import canonical_text, canonical_value, flat_row


#: Kinds that the JVM writes as canonical JSON does.
_PLAIN = {"string", "byte", "short", "integer", "long", "boolean"}


def row_hash(df: DataFrame, volatile: list[str] = (), name: str = "content_hash", bodies: list[str] = ()) -> DataFrame:
    """Adds the hash of a row's canonical JSON without the ``volatile`` columns. ``bodies`` are columns of JSON text, of which the order of keys and the spacing don't count."""
    columns = [c for c in df.columns if c not in volatile]
    rows = df.withColumns({f"_b_{c}": canonical_text(F.col(f"`{c}`")) for c in bodies})
    of = {c: F.col(f"_b_{c}") if c in bodies else F.col(f"`{c}`") for c in sorted(columns)}
    kinds = {c: df.schema[c].dataType.typeName() for c in columns}
    numbers = [c for c in columns if kinds[c] in ("double", "float")]
    if not set(kinds.values()) <= _PLAIN | {"double", "float"}:
        text = canonical_value(F.struct(*[c.alias(n) for n, c in of.items()]))
    elif numbers:
        text = flat_row(numbers, [c for c in columns if c not in numbers], of)
    else:
        text = F.to_json(F.struct(*[c.alias(n) for n, c in of.items()]), {"ignoreNullFields": "false"})
    return rows.withColumn(name, F.sha2(text, 256)).drop(*[f"_b_{c}" for c in bodies])


def group_hash(rows: DataFrame, identity: list[str], volatile: list[str] = ()) -> DataFrame:
    """identity, content_hash over all rows of an identity, whatever their order.

    Rows are hashed and the hashes summed in slices of 64 bits, with their number: sums don't depend on the order, count repeats, and are taken before the
    only exchange, so an identity costs the same however many rows it has.
    """
    own = row_hash(rows, volatile, "_h")
    parts = [F.sum(F.conv(F.substring("_h", 16 * k + 1, 16), 16, 10).cast("decimal(20,0)")).cast("string") for k in range(4)]
    return own.groupBy(*identity).agg(F.sha2(F.concat_ws("|", *parts, F.count(F.lit(1))), 256).alias("content_hash"))


def gate(incoming: DataFrame, stored: DataFrame, identity: list[str], full_refresh: bool = False) -> DataFrame:
    """``incoming`` with ``gate``: new, changed or unchanged. Both sides have content_hash."""
    old = stored.select(*identity, F.col("content_hash").alias("_old"), F.lit(True).alias("_known"))
    out = incoming.join(old, identity, "left")
    state = F.when(F.col("_known").isNull(), "new").when(F.lit(full_refresh) | ~F.col("_old").eqNullSafe(F.col("content_hash")), "changed").otherwise("unchanged")
    return out.withColumn("gate", state).drop("_old", "_known")


def advance(stored: DataFrame, gated: DataFrame, identity: list[str]) -> DataFrame:
    """The gate table after a run: hashes as they came in, ``first_seen`` as it was, ``fetched_at`` moved on."""
    new = gated.select(*identity, F.col("content_hash").alias("_h"), F.col("fetched_at").alias("_f"))
    both = stored.join(new, identity, "full")
    return both.select(*identity, F.coalesce("_h", "content_hash").alias("content_hash"), F.coalesce("first_seen", "_f").alias("first_seen"),
                       F.greatest("fetched_at", "_f").alias("fetched_at"))
