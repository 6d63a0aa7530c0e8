"""Exact dedup over an extendible-hash index that lies on shared files.

The directory has a slot for each value of a key's leading bits. It starts with one bucket; a bucket
that holds more distinct keys than ``capacity`` is split by its next bit, and the directory doubles
for as long as a bucket is overfull, up to the bits of a key. Slots are contiguous key ranges. A
bucket is the unit of work: the task that owns it chains the texts of its keys, a link for
each distinct text, and every document is looked up through the directory: slot, bucket, key, then
the link of its own text.

Only DataFrame functions are used. What travels is a key, a digest and an id; texts are moved
for keys that occur at least twice, and then once for each distinct text and map task, and grouping by
the text compares all its bytes.

A text that a third of all rows share is one link; rows of such keys are looked up by broadcast and stay
where they are (``common.join_by_size``).

Nulls: a null text counts as empty; a null id ranks below all others (a group without any
id keeps all its rows, as none of them can be told apart). Rows that repeat both id and text
are one document listed twice: they stay or go together. An empty table gives no rows. Other
columns are never looked at, so any names may occur among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import KeyFilter, drop_matching, join_by_size, lower_ascii


def slot_of(key: Column, depth: int) -> Column:
    """A key's leading ``depth`` bits."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


#: What a bucket holds at least, and how many buckets there are about at most: beyond that they grow with the keys, so the directory can be broadcast at any size.
CAPACITY, MOST_BUCKETS = 200_000, 1 << 16


def build_directory(keys: DataFrame, capacity: int | None = None, hash_bits: int = 64) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for all slots of a directory, and how many bits a slot has.

    ``keys`` are distinct longs. A bucket's number is its first slot. The directory doubles until no bucket is overfull.
    """
    spark, n = keys.sparkSession, keys.count()
    capacity = capacity or max(CAPACITY, n // MOST_BUCKETS)
    depth = min(hash_bits, max(0, (n // capacity).bit_length()))
    while True:
        held = keys.groupBy(slot_of(F.col("key"), depth).alias("slot")).count()
        if depth >= hash_bits or not held.filter(F.col("count") > capacity).limit(1).count():
            break
        depth += 1
    # A slot's bucket is the shortest of its prefixes that is not overfull.
    prefixes = held.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"), "slot", "count")
    spread = F.lit(depth) - F.col("depth")
    prefix = F.call_function("shiftright", F.col("slot"), spread)
    per = prefixes.groupBy("depth", prefix.alias("prefix")).agg(F.sum("count").alias("count"))
    fits = (F.col("count") <= capacity) | (F.col("depth") == depth)
    slots = spark.range(1 << depth).select(F.col("id").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    slots = slots.withColumn("prefix", prefix).join(per, ["depth", "prefix"], "left")
    own = slots.filter(fits | F.col("count").isNull()).groupBy("slot").agg(F.min("depth").alias("depth"))
    bucket = F.call_function("shiftleft", prefix, spread)
    return materialize(own.select("slot", bucket.alias("bucket"), "depth"), "dedup-directory"), depth


def text_key(norm: Column, hash_bits: int = 64) -> Column:
    """The leading ``hash_bits`` of a 64-bit hash, kept in the high bits."""
    key = F.xxhash64(norm)
    return key if hash_bits >= 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - hash_bits), 64 - hash_bits)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None,
                hash_bits: int = 64) -> tuple[DataFrame, DataFrame, tuple[DataFrame, int]]:
    """(entries, index, directory). Entries: a row for each document. Index: a row for each key, with its chain of texts.

    The index is written by owner tasks, one bucket after the other, ordered by key.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), lower_ascii(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("norm"))
    rows = rows.withColumn("key", text_key(F.col("norm"), hash_bits))
    entries = materialize(rows.select("id", "key", F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-entries")
    keys = materialize(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep_id"),
                                                  F.min("sha").alias("sha")), "dedup-keys")
    directory, depth = build_directory(keys.select("key"), capacity, hash_bits)

    chained = keys.filter("n > 1").select("key")
    suspects = KeyFilter(chained, "key").maybe(rows, F.col("key"))
    # Grouping by the text itself compares bytes; the key only decides who is compared.
    links = suspects.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep_id"))
    links = links.select("key", F.unhex(F.sha2("norm", 256)).alias("sha"), "n", "keep_id")
    links = links.join(chained, "key", "left_semi")  # drops what only shared a bit
    links = keys.filter("n = 1").select("key", "sha", "n", "keep_id").unionByName(links)
    owned = links.withColumn("slot", slot_of(F.col("key"), depth)).join(F.broadcast(directory), "slot").repartition("bucket")  # MOST_BUCKETS
    chain = F.sort_array(F.collect_list(F.struct("sha", "n", "keep_id")))  # the distinct texts of one 64-bit key
    index = owned.groupBy("bucket", "key").agg(F.sum("n").alias("rows"), chain.alias("chain"))
    return entries, materialize(index, "dedup-index", sort_by=["bucket", "key"]), (directory, depth)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row for each document: id, keep_id, group_size, kept, text_sha256."""
    entries, index, (directory, depth) = build_index(docs, id_col, text_col, **options)
    probes = entries.withColumn("slot", slot_of(F.col("key"), depth)).join(F.broadcast(directory), "slot").drop("slot", "depth")
    out = join_by_size(probes, index, ["bucket", "key"], "rows")
    link = F.element_at(F.filter("chain", lambda x: x["sha"] == F.col("sha")), 1)
    out = out.withColumn("link", link).withColumn("keep", F.when(F.col("link.n") > 1, F.col("link.keep_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("link.n").cast("long").alias("group_size"),
                      F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    gone = exact_dedup(docs, id_col, text_col, **options).filter(~F.col("kept"))
    gone = materialize(gone.select(F.col(id_col).alias("gone_id"), F.col("text_sha256").alias("gone_sha")).distinct(), "dedup-gone")
    text = F.col(f"`{text_col}`")
    return drop_matching(docs, gone, gone_id=F.col(f"`{id_col}`"), gone_sha=F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256))
