"""N-gram Jaccard self join by T-occurrence search (DivideSkip).

Where documents meet. Order all n-grams by how many documents have them, rare ones first (counts
come from a sketch over all documents, whose size follows their number; any order loses nothing, a good one
keeps passages that many documents share out of the way). The first n-gram of that order that two
linked sets of n and m elements share lies among the first n - T + 1 of one and m - T' + 1 of the
other, T being the overlap that a set's own size asks for. So a document signs with those
n-grams, and documents that share a signature are candidates. Sizes are in classes so narrow
that partners lie in the same or the next class; a document signs for both. No pair is lost.

Who is compared. Candidates of a signature aren't paired with each other: each is joined to the
least id of the signature (first within a map task, then across them, so a signature sent by a
third of all rows arrives once per task). Each such pivot is a query over the inverted lists of
its candidates, dealt in blocks. Two documents that meet are below the same pivot, at once or by their
tasks' pivots. Where links found so far hold together all that is below a pivot, nothing is left to find there.

What is left are families, the documents below a pivot, that don't hold together. Documents outside the family's largest component are
queries over blocks of its members; a link between two components has an end outside the largest, so none is lost. That costs a
member as many copies as there are blocks of queries, so it is done for ``MOST_BLOCKS`` of them at most. Families with more sign
again, in another exact way: n-grams are dealt to d + 1 parts by hash, d being the most n-grams in which linked sets of a size class
differ, so two linked sets agree in all of some part, and the digest of a part is a far rarer signature than an n-gram. Members
that share a part take the family's place. Tables of parity bits rule out most pairs that can't link before any set is sent.

How a query is answered. It needs documents that occur on at least T of its lists. The L
longest lists are set aside, the rest are heap-merged for documents that occur T - L times,
and those are probed for in the long lists by binary search.

Nulls and odd rows: a text without words has an empty set and links with nothing; fewer words
than n count as one n-gram of the whole sequence. Rows with a null id are returned with a null
component. Rows that share an id are one vertex; ids are whole numbers. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import KeyFilter, drop_matching, join_by_size, row_digest
from .components import components
from .words import FOLD, SPACE, Segments, batches, mix, ngrams

CHUNKS, SALTS = 64, 256
#: Signatures that a map task holds before it sends them, and members of a block.
FLUSH, BLOCK = 500_000, 512
#: Blocks of queries that the members of a family meet as a whole; families with more are split.
MOST_BLOCKS = 16
CANDIDATE, SAME, SIZE, MEET = 0, 1, 2, 3
_ROWS = "key long, a long, b long, kind int"


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, hashes, owner): each row's distinct n-grams, ordered by owner and hash."""
    for i, j, data, bounds in batches(texts):
        seg = Segments(FOLD[data], bounds, SPACE)
        hashes, per = seg.hashes(), seg.per_doc()
        at, grams = ngrams(hashes, seg.doc, words)
        owner = seg.doc[at]
        for short in range(1, words):
            if (per == short).any():
                at, h = ngrams(hashes, seg.doc, short)
                mine = per[seg.doc[at]] == short
                owner, grams = np.concatenate([owner, seg.doc[at][mine]]), np.concatenate([grams, h[mine]])
        order = np.lexsort((grams, owner))
        owner, grams = owner[order], grams[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        yield i, j, grams[new], owner[new]


def size_classes(largest: int, percent: int) -> np.ndarray:
    """Upper ends of the classes: a partner's size lies in the same or the next one."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array([*ends, max(ends[-1] + 1, ends[-1] * 100 // percent)], np.int64)


def counter_bits(n_rows: int) -> int:
    """The sketch has two to four counters a document, 2**20 at least and 2**24 at most (a byte each when broadcast).

    At the most, an n-gram still stands out if it makes up more than one part in 16 million of all occurrences.
    """
    return min(24, max(20, n_rows.bit_length() + 1))


def sketch_counts(rows: DataFrame, words: int, bits: int = 20) -> np.ndarray:
    """How many documents have n-grams of each of 2**bits hash ranges, as levels of an eighth of a power of two (a byte each).

    Tasks send their counters above 0; they are summed in two steps, so no task adds up those of all others.
    """
    counters, chunks = 1 << bits, CHUNKS
    width = counters // chunks

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.uint32)
        for b in it:
            for _, _, grams, _ in shingle_sets(b.column("text"), words):
                np.add.at(total, grams >> np.uint64(64 - bits), np.uint32(1))
        parts = [(c, np.flatnonzero(total[c * width:(c + 1) * width])) for c in range(chunks)] if total.any() else []
        salt = int(total.sum(dtype=np.int64) % SALTS)
        yield pa.RecordBatch.from_arrays([
            pa.array([c for c, _ in parts], pa.int32()), pa.array([salt] * len(parts), pa.int32()),
            pa.array([_packed(at) for _, at in parts], pa.binary()),
            pa.array([total[c * width + at].astype("<u4").tobytes() for c, at in parts], pa.binary())], ["chunk", "salt", "at", "n"])

    def add(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for b in tables:
            for at, n in zip(b.column("at").to_pylist(), b.column("n").to_pylist(), strict=True):
                total[_unpacked(at, len(n) // 4)] += np.frombuffer(n, "<u4")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([_packed(at)], pa.binary()),
            pa.array([np.minimum(total[at], 2**32 - 1).astype("<u4").tobytes()], pa.binary())], ["chunk", "salt", "at", "n"])

    schema = "chunk int, salt int, at binary, n binary"
    summed = rows.select("text").mapInArrow(count, schema).groupBy("chunk", "salt").applyInArrow(add, schema).groupBy("chunk").applyInArrow(add, schema)
    out = np.zeros(counters, np.uint8)
    for r in summed.collect():  # CHUNKS rows
        n = np.frombuffer(r["n"], "<u4").astype(np.float64)
        out[r["chunk"] * width + _unpacked(r["at"], len(n))] = np.minimum(255, np.round(8 * np.log2(1 + n)))
    return out


def _packed(at: np.ndarray) -> bytes:
    """Ascending places below 2**18, two bytes each where they are below 2**16."""
    return at.astype("<u2" if not len(at) or at[-1] < 1 << 16 else "<u4").tobytes()


def _unpacked(at: bytes, n: int) -> np.ndarray:
    return np.frombuffer(at, "<u2" if len(at) == 2 * n else "<u4").astype(np.int64)


def signatures(grams: np.ndarray, owner: np.ndarray, sizes: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, owner) for both size classes of every set. grams are ordered by owner and hash."""
    rarity = counts[grams >> np.uint64(65 - len(counts).bit_length())]
    order = np.argsort((owner.astype(np.uint64) << np.uint64(32)) | rarity, kind="stable")
    starts = np.cumsum(sizes) - sizes
    sent = sizes - -(-percent * sizes // 100) + 1
    order = order[np.arange(len(order)) - starts[owner] < sent[owner]]  # owner is ascending either way
    grams, owner = grams[order], owner[order]
    own = np.searchsorted(size_classes(int(sizes.max(initial=1)), percent), sizes)[owner].astype(np.uint64)
    return np.concatenate([mix(grams ^ mix(own + step)) for step in (np.uint64(1), np.uint64(2))]), np.concatenate([owner, owner])


def _stars(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows ordered by (key, id): their keys, ids, and the least id of each row's key."""
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    return key, ids, ids[np.flatnonzero(first)][np.cumsum(first) - 1] if len(key) else ids


def _batch(key, a, b, kind) -> pa.RecordBatch:
    as_long = lambda x: pa.array(x.astype(np.int64)) if x.dtype != np.uint64 else pa.array(x.view(np.int64))
    return pa.RecordBatch.from_arrays([as_long(key), a if isinstance(a, pa.Array) else as_long(a), as_long(b), pa.array(np.full(len(key), kind, np.int32))],
                                      ["key", "a", "b", "kind"])


def _pairs(pivot: np.ndarray, member: np.ndarray, kind: int) -> pa.RecordBatch:
    real = pivot != member
    pairs = np.unique(np.stack([pivot[real], member[real]]), axis=1) if real.any() else np.zeros((2, 0), np.int64)
    return _batch(mix(pairs[0].view(np.uint64) * np.uint64(31) + pairs[1].view(np.uint64)), pairs[0], pairs[1], kind)


def _sign(words: int, percent: int, known_counts):
    """Map side: SIZE rows, pairs found within the task, and each signature once with its least id (MEET)."""

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        ids, digest = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        base = np.cumsum([0, *[len(h[0]) for h in held]])
        sig, doc = np.concatenate([h[2] for h in held]), np.concatenate([h[3] + o for h, o in zip(held, base, strict=False)])
        _, member, pivot = _stars(digest, ids)
        yield _pairs(pivot, member, SAME)
        # By row, as an id may have other texts: whatever isn't of its digest's least id is a copy.
        kinds, place = np.unique(digest, return_inverse=True)
        least = np.full(len(kinds), np.iinfo(np.int64).max)
        np.minimum.at(least, place, ids)
        copies = ids != least[place]
        mine = ~copies[doc]
        key, member, pivot = _stars(sig[mine], ids[doc[mine]])
        yield _pairs(pivot, member, CANDIDATE)
        own = np.ones(len(key), bool)
        own[1:] = key[1:] != key[:-1]
        yield _batch(key[own], pivot[own], np.full(int(own.sum()), -1), MEET)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, counts = [], 0, known_counts.value
        for b in it:
            ids = b.column("id")
            for i, j, grams, owner in shingle_sets(b.column("text"), words):
                part = ids.slice(i, j - i)
                known = np.asarray(part.is_valid())
                own = np.asarray(part.fill_null(0)).astype(np.int64)
                sizes = np.bincount(owner, minlength=j - i)
                yield _batch(mix(own.view(np.uint64)), part.cast(pa.int64()), sizes, SIZE)
                sums = np.zeros(j - i, np.uint64)
                np.add.at(sums, owner, mix(grams))
                sig, doc = signatures(grams, owner, sizes, counts, percent)
                sig, doc = sig[known[doc]], doc[known[doc]]
                real = np.flatnonzero(known & (sizes > 0))
                place = np.full(j - i, -1)
                place[real] = np.arange(len(real))
                held.append((own[real], mix(sums[real] + sizes[real].astype(np.uint64)), sig, place[doc]))
                rows += len(sig)
                if rows >= FLUSH:
                    yield from flush(held)
                    held, rows = [], 0
        if held:
            yield from flush(held)

    return run


class InvertedLists:
    """Documents of a block by n-gram. Lists are ascending, as documents are added in order."""

    def __init__(self, sets: list[np.ndarray]):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        order = np.argsort(values, kind="stable")
        self.values, starts = np.unique(values[order], return_index=True)
        self.starts, self.owner = [*starts.tolist(), len(values)], owner[order]
        self.sizes = [len(s) for s in sets]

    def lists(self, query: np.ndarray) -> list[list[int]]:
        at = np.searchsorted(self.values, query)
        at = at[at < len(self.values)]
        at = np.unique(at[np.isin(self.values[at], query)])
        return [self.owner[self.starts[k]:self.starts[k + 1]].tolist() for k in at.tolist()]


def divide_skip(query: np.ndarray, index: InvertedLists, percent: int, mu: float = 0.0085) -> list[int]:
    """Documents of the index whose Jaccard similarity with ``query`` is at least ``percent``.

    T, the least overlap any partner can have, is percent of the query's size; a found document
    is then held to the overlap that its own size asks for.
    """
    need = -(-percent * len(query) // 100)
    lists = sorted(index.lists(query), key=len)
    if need == 0 or len(lists) < need:
        return []
    skip = min(need - 1, int(need / (mu * log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[:len(lists) - skip], lists[len(lists) - skip:]
    found, last, seen = [], -1, 0

    def judge(doc: int, count: int) -> None:
        overlap = -(-percent * (len(query) + index.sizes[doc]) // (100 + percent))
        left = len(long)
        for one in long:
            if count + left < overlap:
                return
            left -= 1
            at = bisect_left(one, doc)
            count += at < len(one) and one[at] == doc
        if 100 * count >= percent * (len(query) + index.sizes[doc] - count):
            found.append(doc)

    for doc in heapq.merge(*short):
        if doc == last:
            seen += 1
            continue
        if last >= 0 and seen >= need - skip:
            judge(last, seen)
        last, seen = doc, 1
    if last >= 0 and seen >= need - skip:
        judge(last, seen)
    return found


def _search_blocks(asked: DataFrame, sets: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (q, m) within each group of ``keys``. asked: keys, id, label, is_query.

    A query looks for members of another label, and one link to each such label is enough.
    """

    def run(table: pa.Table) -> pa.Table:
        ids, labels = table.column("id").to_pylist(), table.column("label").to_pylist()
        asks = table.column("is_query").to_pylist()
        values = table.column("grams").combine_chunks()
        flat, ends = np.asarray(values.values), np.asarray(values.offsets)
        one = lambda k: flat[ends[k]:ends[k + 1]]
        members = [k for k, q in enumerate(asks) if not q]
        index = InvertedLists([one(k) for k in members])
        out = {}
        for k in (k for k, q in enumerate(asks) if q):
            for m in divide_skip(one(k), index, percent):
                other = members[m]
                if labels[other] != labels[k] and ids[other] != ids[k]:
                    out.setdefault((ids[k], labels[other]), ids[other])
        return pa.table({"q": pa.array([q for q, _ in out], pa.int64()), "m": pa.array(list(out.values()), pa.int64())})

    return asked.join(sets, "id").groupBy(*keys).applyInArrow(run, "q long, m long")


def _of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows that may be of these ids. Joins behind it are exact."""
    listed = materialize(ids.select(F.xxhash64("id").alias("k")), "ngram-ids")
    return KeyFilter(listed, "k").maybe(rows.filter("id IS NOT NULL"), F.xxhash64("id"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def ngram_links(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(sizes, labels): every row's id and n-gram count, and (id, component) of ids that link."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counts = rows.sparkSession.sparkContext.broadcast(sketch_counts(rows, words, counter_bits(rows.count())))  # 16 MB at most
    signed = rows.mapInArrow(_sign(words, percent, counts), _ROWS)
    # The ids of a signature are joined to the least of them. Nearly all rows are of that kind (MEET); what rides along, a row or two
    # a document, would cost a second pass over all texts, or a table of all signatures, to keep apart.
    pivot = F.min("a").over(Window.partitionBy("kind", "key"))
    met = signed.withColumn("pivot", F.when(F.col("kind") == MEET, pivot)).filter((F.col("kind") != MEET) | (F.col("pivot") < F.col("a")))
    meets = F.col("kind") == MEET
    met = met.select(F.when(meets, F.col("pivot")).otherwise(F.col("a")).alias("a"), F.when(meets, F.col("a")).otherwise(F.col("b")).alias("b"), "kind")
    met = materialize(met, "ngram-met")
    sizes = met.filter(F.col("kind") == SIZE).select(F.col("a").alias("id"), F.col("b").alias("n_shingles"))
    edges = materialize(met.filter(F.col("kind") != SIZE).distinct(), "ngram-edges")
    maybe = materialize(edges.filter(F.col("kind") != SAME).select("a", "b").distinct(), "ngram-maybe")

    bits = materialize(_of(rows, _ends(maybe)).mapInArrow(_parities(words), "id long, n long, bits binary").distinct(), "ngram-bits")
    end = lambda c: bits.select(F.col("id").alias(c), F.col("n").alias("n" + c), F.col("bits").alias("bits" + c))
    # A pivot may have a third of all rows below it.
    pivots = materialize(maybe.groupBy("a").agg(F.count(F.lit(1)).alias("n_below")).join(end("a"), "a"), "ngram-pivots")
    near = join_by_size(maybe, pivots, ["a"], "n_below").drop("n_below").join(end("b"), "b").mapInArrow(_near(percent), "a long, b long").distinct()
    near = materialize(near, "ngram-near")
    sets = materialize(_of(rows, _ends(near)).mapInArrow(_sets(words), "id long, grams array<long>"), "ngram-sets")
    blocks = materialize(near.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("n_blocks")), "ngram-blocks")
    dealt = join_by_size(near, blocks, ["a"], "n").select("a", F.pmod(F.xxhash64("b"), F.col("n_blocks")).alias("block"), "b")
    members = dealt.select("a", "block", F.col("b").alias("id"), F.col("b").alias("label"), F.lit(False).alias("is_query"))
    pivots = blocks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block"),
                           F.col("a").alias("id"), F.col("a").alias("label"), F.lit(True).alias("is_query"))
    links = _search_blocks(members.unionByName(pivots), sets, ["a", "block"], percent)
    found = materialize(links.select(F.col("q").alias("a"), F.col("m").alias("b")), "ngram-links")
    same = edges.filter(F.col("kind") == SAME).select("a", "b")
    labels = materialize(components(found.unionByName(same)), "ngram-labels")
    return sizes, _search_rest(rows, words, edges, labels, bits, percent)


def parity(grams: np.ndarray) -> np.ndarray:
    """A bit for each place of a table: whether an odd number of n-grams falls there. Its halves fold into a table of half the size."""
    width = 1 << min(16, max(6, (len(grams) - 1).bit_length()))
    return np.packbits((np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(bool), bitorder="little")


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def may_link(n: int, bits: np.ndarray, sizes: np.ndarray, tables: np.ndarray, percent: int) -> np.ndarray:
    """Which of ``tables`` (rows of one width) may belong to sets that link with this one.

    Tables of two sets differ in no more places than the sets do, and linked sets of n and m
    elements differ in at most (n + m) (100 - p) / (100 + p).
    """
    width = min(len(bits), tables.shape[1])
    differ = np.bitwise_count(_fold(tables, width) ^ _fold(bits, width)).sum(axis=1)
    return ((100 + percent) * differ <= (100 - percent) * (sizes + n)) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n))


def _parities(words: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, grams, owner in shingle_sets(b.column("text"), words):
                ends = np.cumsum(np.bincount(owner, minlength=j - i)).tolist()
                tables = [parity(grams[x:y]).tobytes() for x, y in zip([0, *ends], ends, strict=False)]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), pa.array(np.diff([0, *ends])), pa.array(tables, pa.binary())], ["id", "n", "bits"])

    return run


def _near(percent: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            na, nb = (np.asarray(batch.column(c)) for c in ("na", "nb"))
            ok = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
            left, right = batch.column("bitsa"), batch.column("bitsb")
            for k in np.flatnonzero(ok).tolist():
                one, other = np.frombuffer(left[k].as_py(), np.uint8), np.frombuffer(right[k].as_py(), np.uint8)
                ok[k] = may_link(na[k], one, nb[k:k + 1], other[None, :], percent)[0]
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    return run


def _sets(words: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, grams, owner in shingle_sets(b.column("text"), words):
                offsets = np.zeros(j - i + 1, np.int32)
                np.cumsum(np.bincount(owner, minlength=j - i), out=offsets[1:])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(i, j - i), lists], ["id", "grams"])

    return run


_BLOCK_KEYS = ["part", "mb", "qb"]


def part_digests(grams: np.ndarray, owner: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(digest, owner) of all parts of each set, for both size classes that a set may have partners in.

    Sets of sizes up to n that link differ in at most d = 2 n (100 - p) / (100 + p) elements, so of d + 1 parts one has none of these.
    """
    ends = size_classes(int(sizes.max(initial=1)), percent)
    own = np.searchsorted(ends, sizes)
    out, of = [], []
    for step in (0, 1):
        parts = np.where(sizes > 0, 2 * ends[own + step] * (100 - percent) // (100 + percent) + 1, 0)
        first = np.cumsum(parts) - parts
        place = first[owner] + (((mix(grams) >> np.uint64(32)) * parts[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(sums, place, mix(grams + np.uint64(1)))
        doc = np.repeat(np.arange(len(sizes)), parts)
        no = np.arange(len(doc)) - first[doc]
        out.append(mix(sums ^ mix((no.astype(np.uint64) << np.uint64(20)) + (own[doc] + step).astype(np.uint64))))
        of.append(doc)
    return np.concatenate(out), np.concatenate(of)


def _part_rows(words: int, percent: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, grams, owner in shingle_sets(b.column("text"), words):
                digest, doc = part_digests(grams, owner, np.bincount(owner, minlength=j - i), percent)
                at = pa.array(doc + i)
                yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), *[b.column(c).take(at) for c in ("id", "label", "asks")]], ["part", "id", "label", "asks"])

    return run


def _in_blocks(own: DataFrame) -> DataFrame:
    """own: part, id, label, asks, told. Every asking row meets every told row of its part in one block (part, mb, qb)."""
    of = lambda c: F.ceil(F.sum(F.col(c).cast("int")) / BLOCK)
    per = own.groupBy("part").agg(F.count(F.lit(1)).alias("n"), of("told").alias("nm"), of("asks").alias("nq"), F.min("label").alias("l1"), F.max("label").alias("l2"))
    per = materialize(per.filter("nm > 0 AND nq > 0 AND l1 < l2").drop("l1", "l2"), "ngram-parts")
    own = join_by_size(own, per, ["part"], "n")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    cols = [*_BLOCK_KEYS, "id", "label", "is_query"]
    members = own.filter("told").withColumn("mb", block("nm")).withColumn("qb", upto("nq")).withColumn("is_query", F.lit(False)).select(*cols)
    return members.unionByName(own.filter("asks").withColumn("qb", block("nq")).withColumn("mb", upto("nm")).withColumn("is_query", F.lit(True)).select(*cols))


def _prune_blocks(dealt: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Rows of (part, id, label, asks, told) that may link with another label's, by their parity tables."""

    def run(table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("is_query"))
        sizes, labels = np.asarray(table.column("n")), np.asarray(table.column("label"))
        tables = [np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()]
        widths = np.array([len(x) for x in tables])
        kinds = {w: np.flatnonzero(~asks & (widths == w)) for w in np.unique(widths[~asks]).tolist()}
        stacked = {w: np.stack([tables[k] for k in at]) for w, at in kinds.items()}
        ask, told = np.zeros(len(asks), bool), np.zeros(len(asks), bool)
        for q in np.flatnonzero(asks).tolist():
            for w, at in kinds.items():
                if percent * w <= 200 * widths[q] and percent * widths[q] <= 200 * w:  # else sizes are too far apart
                    hit = at[may_link(sizes[q], tables[q], sizes[at], stacked[w], percent) & (labels[at] != labels[q])]
                    ask[q] |= len(hit) > 0
                    told[hit] = True
        keep = ask | told
        out = table.select(["part", "id", "label"]).filter(pa.array(keep))
        return out.append_column("asks", pa.array(ask[keep])).append_column("told", pa.array(told[keep]))

    left = dealt.join(bits, "id").groupBy(*_BLOCK_KEYS).applyInArrow(run, "part long, id long, label long, asks boolean, told boolean")
    return left.groupBy("part", "id", "label").agg(F.max("asks").alias("asks"), F.max("told").alias("told"))


def _search_rest(rows: DataFrame, words: int, edges: DataFrame, labels: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Searches what is below pivots and isn't held together by links so far; final (id, component)."""
    label_of = lambda df, col, to: df.join(labels.select(F.col("id").alias(col), F.col("component").alias("_l")), col, "left").withColumn(to, F.coalesce("_l", col)).drop("_l")
    # A task's pivot stands for its members where tasks meet, so their families hold its members too.
    local, across = edges.filter(F.col("kind") == CANDIDATE).select("a", "b"), edges.filter(F.col("kind") == MEET).select("a", "b")
    below = across.select(F.col("a").alias("top"), F.col("b").alias("a")).join(local, "a").select(F.col("top").alias("a"), "b")
    tops = local.unionByName(across).select("a", F.col("a").alias("b"))
    family = local.unionByName(across).unionByName(below).unionByName(tops).distinct()
    own = materialize(label_of(family.select(F.col("a").alias("family"), F.col("b").alias("id")), "id", "label"), "ngram-family")
    per = own.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n"))
    per = per.groupBy("family").agg(F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most"))
    per = materialize(per.filter("n > most AND n > 2").select("family", "n", "main", (F.col("n") - F.col("most") > BLOCK * MOST_BLOCKS).alias("large")), "ngram-open")
    if per.isEmpty():
        return labels
    left = join_by_size(own, per, ["family"], "n").select("family", "id", "label", (F.col("label") != F.col("main")).alias("asks"), "large")
    own = left.filter("NOT large").select(F.xxhash64("family").alias("part"), "id", "label", "asks")
    if not per.filter("large").isEmpty():
        split = materialize(left.filter("large").groupBy("id").agg(F.first("label").alias("label"), F.max("asks").alias("asks")), "ngram-left")
        own = own.unionByName(_of(rows, split.select("id")).join(split, "id").mapInArrow(_part_rows(words, percent), "part long, id long, label long, asks boolean"))
    own = materialize(own.withColumn("told", F.lit(True)), "ngram-own")
    own = materialize(_prune_blocks(_in_blocks(own), bits, percent), "ngram-rest")
    sets = materialize(_of(rows, own.select("id").distinct()).mapInArrow(_sets(words), "id long, grams array<long>"), "ngram-sets")
    more = _search_blocks(_in_blocks(own), sets, _BLOCK_KEYS, percent)
    more = label_of(label_of(more.select(F.col("q").alias("a"), F.col("m").alias("b")), "a", "la"), "b", "lb")
    joined = components(more.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    merged = joined.select(F.col("id").alias("component"), F.col("component").alias("final"))
    known = labels.join(merged, "component", "left").select("id", F.coalesce("final", "component").alias("component"))
    single = joined.join(labels, "id", "left_anti")
    return known.unionByName(single)


def ngram_join(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id, n_shingles, component_id (its own id where it links with nothing)."""
    sizes, labels = ngram_links(docs, words, percent, id_col, text_col)
    out = sizes.join(labels, "id", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))


def _vertices(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows with a column ``vertex``: a number for each id and text; what ids and digests the numbers of odd rows stand for).

    An id is its own vertex if it occurs once. Rows without an id, and those whose id occurs again, get numbers that no id has. Mostly there
    are none, and then nothing is shuffled but ids.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ids = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    odd = materialize(ids.filter("n > 1 OR id IS NULL").select("id"), "near-odd")
    if odd.isEmpty():
        return rows.withColumn("vertex", F.col("id")), None
    ends = rows.agg(F.max("id").alias("hi"), F.min("id").alias("lo")).first()
    base = (ends["hi"] or 0) + 1 if (ends["hi"] or 0) < 2**62 else ends["lo"] - 2**62
    listed = KeyFilter(odd.select(F.xxhash64("id").alias("k")), "k")
    marked = listed.mark(rows, F.xxhash64("id")).withColumn("digest", row_digest(F.col("text")))
    known = odd.select(F.col("id").alias("odd_id"), F.lit(True).alias("is_odd"))
    near = marked.filter("bm_hit").join(known, F.col("id").eqNullSafe(F.col("odd_id")), "left")
    named = near.filter("is_odd").select("id", "digest").distinct()
    named = materialize(named, "near-named").withColumn("vertex", F.lit(base) + F.monotonically_increasing_id())
    named = materialize(named, "near-numbers")
    of = named.select(F.col("id").alias("of_id"), F.col("digest").alias("of_digest"), "vertex")
    exact = near.join(of, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("digest") == F.col("of_digest")), "left")
    odd_rows = exact.select("id", "text", F.coalesce("vertex", "id").alias("vertex"))
    return marked.filter("NOT bm_hit").select("id", "text", F.col("id").alias("vertex")).unionByName(odd_rows), named


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each group of near copies left: that of the least id (rows without an id are the last choice).

    A document is an id with a text: another text of the same id is judged on its own. Rows that repeat both stay or go together.
    """
    rows, named = _vertices(docs, id_col, text_col)
    _, labels = ngram_links(rows, words, percent, "vertex", "text")
    if named is None:
        gone = materialize(labels.filter("id != component").select(F.col("id").alias("gone_id")), "ngram-gone")
        return drop_matching(docs, gone, gone_id=F.col(f"`{id_col}`"))
    labels = materialize(labels, "near-labels").withColumnRenamed("id", "vertex")
    full = labels.join(named, "vertex", "left").withColumn("own_id", F.when(F.col("digest").isNull(), F.col("vertex")).otherwise(F.col("id")))
    order = F.struct(F.col("own_id").isNull().alias("none"), "own_id", "vertex")
    stays = full.groupBy("component").agg(F.min_by("vertex", order).alias("vertex"))
    full = materialize(full.join(stays.select("vertex"), "vertex", "left_anti"), "ngram-gone")
    out = drop_matching(docs, full.filter("digest IS NULL").select(F.col("own_id").alias("gone_id")), gone_id=F.col(f"`{id_col}`"))
    gone = full.filter("digest IS NOT NULL").select(F.col("own_id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    return drop_matching(out, gone, gone_id=F.col(f"`{id_col}`"), gone_digest=row_digest(F.col(f"`{text_col}`")))
