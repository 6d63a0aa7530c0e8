"""Native column helpers that the operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column) -> Column:
    """Whether a document is of the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sampled(rows: DataFrame, share: float, *by: Column) -> DataFrame:
    """Rows whose 64-bit hash lies in the lowest ``share`` of all hashes: the same rows at every run, however small the share."""
    if share >= 1:
        return rows
    return rows.filter(F.xxhash64(*by) < F.lit(int(share * 2**64) - 2**63).cast("long"))


#: Bits of the smallest and the largest filter; 2**28 bits are 32 MB.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
#: Keys above this share of all rows are joined by broadcast; there are fewer than ``SHARES`` of them, whatever the input.
SHARES = 1024
#: A key of this many rows is no burden to a task, whatever its share.
FEW_ROWS = 10_000


class KeyFilter:
    """A bitmap of a column of longs, eight to sixteen bits a key, in front of an exact join.

    Two keys can share a bit, so it only saves work. Where so many keys are listed that the
    bitmap would outgrow ``MOST_BITS``, there is none: every row may match, and the exact join alone decides.
    """

    def __init__(self, keys: DataFrame, key: str):
        self.n = keys.count()
        self.bits = max(LEAST_BITS, 1 << (8 * self.n).bit_length())
        self.map = None
        if self.bits <= MOST_BITS:
            bit = F.pmod(F.col(key), F.lit(self.bits)) + 1
            self.map = keys.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bm_no")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bm"))

    def mark(self, df: DataFrame, key: Column) -> DataFrame:
        """Adds ``bm_hit``: whether the key may be listed."""
        if self.map is None or not self.n:
            return df.withColumn("bm_hit", F.lit(self.n > 0))
        probe = df.withColumn("bm_bit", F.pmod(key, F.lit(self.bits)) + 1).withColumn("bm_no", F.bitmap_bucket_number("bm_bit"))
        at = F.bitmap_bit_position("bm_bit")
        byte = F.conv(F.hex(F.substring(F.col("bm"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8 + 1).cast("int"))
        joined = probe.join(F.broadcast(self.map), "bm_no", "left")  # MOST_BITS at most
        return joined.withColumn("bm_hit", F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))).drop("bm_no", "bm_bit", "bm")

    def maybe(self, df: DataFrame, key: Column) -> DataFrame:
        """Rows of ``df`` whose key may be listed."""
        return self.mark(df, key).filter("bm_hit").drop("bm_hit")


def join_by_size(rows: DataFrame, per: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``per``, which has a row per key and in ``weight`` how many rows the key has.

    Keys that hold more than one part in ``SHARES`` of all rows (and ``FEW_ROWS``) are fewer than ``SHARES``: they
    are broadcast, so their rows stay where they are. The others are shuffled, and no task gets much
    of them. Keys are not null. ``rows`` is read twice, so it had better be a table.
    """
    held = per.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("total"), F.max(weight).alias("most")).first()
    least = max(FEW_ROWS, held["total"] // SHARES)
    if (held["most"] or 0) <= least:
        return rows.join(per, on, how)
    hot = per.filter(F.col(weight) > least)
    added = [c for c in per.columns if c not in on]
    by_hot = rows.join(F.broadcast(hot.select(*on, *added, F.lit(True).alias("_hot"))), on, "left")
    rest = by_hot.filter("_hot IS NULL").drop("_hot", *added)
    cold = rest.join(per.filter(F.col(weight) <= least), on, how)
    return by_hot.filter("_hot").drop("_hot").unionByName(cold)


def row_digest(text: Column) -> Column:
    """128 bits of a text from three hashes that run at memory speed; it tells texts of one id apart."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("x"), F.hash(text).alias("m"), F.length(text).alias("n"))


def drop_matching(docs: DataFrame, gone: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` without the rows whose ``keys`` are those of a row of ``gone``; null equals null.

    Each name is a column of ``gone``, each value the expression over ``docs`` that it is held against.
    Texts of documents that can't be listed aren't shuffled: a filter sized to the list
    sends only possible matches through the exact anti join.
    """
    rows = docs.select(F.struct("*").alias("doc"), *[v.alias("own_" + k) for k, v in keys.items()])
    listed = KeyFilter(gone.select(F.xxhash64(*keys).alias("k")), "k")
    marked = listed.mark(rows, F.xxhash64(*["own_" + k for k in keys]))
    near = marked.filter("bm_hit")
    on = reduce(lambda a, b: a & b, [near["own_" + k].eqNullSafe(gone[k]) for k in keys])
    left = near.join(gone, on, "left_anti").select("doc.*")
    return marked.filter(~F.col("bm_hit")).select("doc.*").unionByName(left)
