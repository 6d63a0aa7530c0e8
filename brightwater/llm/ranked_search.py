"""Ranked lexical search by windowed bucket scoring.

The index has a row for each window: up to ``window`` documents of one input split, numbered from 0, with their ids, lengths and
the postings of its terms, each a run of (place, count). Where the queries' vocabulary is small enough to broadcast only its terms
are indexed; otherwise all are, so what is found is the same.

A search goes window by window. What each posting adds is worked out once; a query then adds its terms' postings
into an array that fits the cache, marks what it touched in an occupancy bitset, and harvests the marked places into a heap of the best
``k``, which goes on to the next window of the task. Queries are taken in blocks of a bounded number of terms, each block against all
windows. Only ``k`` rows a query leave a task.

A term: a maximal run of ASCII letters and digits and of all that is not ASCII, A-Z lower-cased. N: documents with a term; L: all their terms; n: a
document's terms; df, tf as usual. w = floor(1000 ln((2N + 2) / (2df + 1))); m = 25 + 75nN div L; a document's score is the sum over the query's
terms, repeats included, of w (10^9 tf div (1000 tf + 8m)), in 64-bit integers.

Nulls: a null text has no terms and is never found; as a query it finds nothing. A null id ranks before others of its score. Repeated rows are
documents, or queries, of their own. Equal scores rank by ascending id. Empty tables give no rows. Other columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .words import FOLD, NOT_ALNUM, Segments, batches

#: Documents and postings of a window at most, but for the postings of its last document. An array of 2**15 scores is 256 KB.
WINDOW, POSTINGS = 1 << 15, 1 << 20
#: Terms that a vocabulary may have to be broadcast (16 MB), and terms of the queries of a block.
VOCABULARY, BLOCK = 1 << 21, 1 << 17


def term_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every term."""
    words = Segments(FOLD[data], bounds, NOT_ALNUM)
    return words.doc, words.hashes()


class Vocabulary:
    """Numbers of listed hashes; a table of bits passes most others over."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.bits = np.uint64(max(1 << 12, 1 << (16 * len(hashes)).bit_length()) - 1)
        self.seen = np.zeros(int(self.bits) + 1, bool)
        self.seen[self.hashes & self.bits] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``h`` of listed hashes, their numbers)."""
        at = np.flatnonzero(self.seen[h & self.bits])
        no = np.minimum(np.searchsorted(self.hashes, h[at]), max(len(self.hashes) - 1, 0))
        hit = self.hashes[no] == h[at] if len(self.hashes) else np.zeros(len(at), bool)
        return at[hit], no[hit]


class _WindowOf:
    """A window that is being filled."""

    def __init__(self):
        self.ids, self.sizes, self.docs, self.terms, self.counts, self.n, self.postings, self.n_docs, self.n_terms = [], [], [], [], [], 0, 0, 0, 0

    def add(self, ids: pa.Array, sizes: np.ndarray, docs: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(ids), self.sizes.append(sizes), self.docs.append(docs + self.n), self.terms.append(terms), self.counts.append(counts)
        self.n += len(sizes)
        self.postings += len(docs)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        docs, terms, counts = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (self.docs, self.terms, self.counts))
        order = np.lexsort((docs, terms))
        own, first = np.unique(terms[order], return_index=True)
        ids = pa.concat_arrays(self.ids) if self.ids else pa.array([], schema.field("ids").type.value_type)
        one = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
        sizes = np.concatenate(self.sizes) if self.sizes else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([self.n_docs], pa.int64()), pa.array([self.n_terms], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(sizes, pa.int64()),
            one(own.view(np.int64), pa.int64()), one(np.diff(np.append(first, len(order))), pa.int64()), one(docs[order], pa.int32()), one(counts[order], pa.int64())], schema=schema)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, postings: int = POSTINGS) -> DataFrame:
    """A row for each window: n_docs and n_terms of all its documents, and of those with listed terms ids and sizes; its terms, how many postings each has, and all postings, term by term.

    vocabulary: hashes of the terms to index; None for all.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()), T.StructField("ids", T.ArrayType(kind)), T.StructField("sizes", longs), T.StructField("terms", longs),
                           T.StructField("df", longs), T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("counts", longs)])
    listed = None if vocabulary is None else rows.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))  # VOCABULARY

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = _WindowOf(), None
        for b in it:
            lists = pa.list_(pa.int64())
            out = out or pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(b.schema.field("id").type)), ("sizes", lists), ("terms", lists), ("df", lists), ("places", pa.list_(pa.int32())), ("counts", lists)])
            for i, j, data, bounds in batches(b.column("text")):
                doc, h = term_hashes(data, bounds)
                size = np.bincount(doc, minlength=j - i)
                now.n_docs += int((size > 0).sum())
                now.n_terms += len(doc)
                if listed is None:
                    names, no = np.unique(h, return_inverse=True)
                else:
                    at, no = listed.value.find(h)
                    doc, names = doc[at], listed.value.hashes
                pairs, counts = np.unique(doc * max(len(names), 1) + no, return_counts=True)
                of, term = pairs // max(len(names), 1), names[pairs % max(len(names), 1)]
                kept, place = np.unique(of, return_inverse=True)
                low = 0
                while low < len(kept):  # as many documents as still fit, one at least
                    upto = np.searchsorted(place, np.arange(low, len(kept) + 1))
                    room = int(np.searchsorted(upto - upto[0], max(postings - now.postings, 1), "right")) - 1
                    high = min(len(kept), low + max(1, min(room, window - now.n)))
                    cut = slice(upto[0], upto[high - low])
                    now.add(b.column("id").take(pa.array(kept[low:high] + i)), size[kept[low:high]], place[cut] - low, term[cut], counts[cut])
                    low = high
                    if now.n >= window or now.postings >= postings:
                        yield now.row(out)
                        now = _WindowOf()
        if out is not None and (now.n_docs or now.n):
            yield now.row(out)

    return materialize(rows.mapInArrow(run, schema), "search-index")


def read_queries(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item, terms): every row of ``queries`` with a number of its own and the hashes of its terms, repeats included."""
    rows = queries.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            terms: list[np.ndarray] = []
            for i, j, data, bounds in batches(b.column("text")):
                doc, h = term_hashes(data, bounds)
                terms += np.split(h.view(np.int64), np.searchsorted(doc, np.arange(1, j - i)))
            yield pa.RecordBatch.from_arrays([b.column("item"), pa.array(terms, pa.list_(pa.int64()))], ["item", "terms"])

    out = rows.mapInArrow(run, T.StructType([rows.schema["item"], T.StructField("terms", T.ArrayType(T.LongType()))]))
    return materialize(out.withColumn("query", F.monotonically_increasing_id()), "search-queries")


class Block:
    """Queries of a block: for each the numbers of its terms and how often it has them; and the terms' weights."""

    def __init__(self, queries: list[tuple[int, list[int]]], df: dict[int, int], n_docs: int, n_terms: int, k: int):
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k
        asked = [np.array(t, np.int64).view(np.uint64) for _, t in queries]
        self.vocabulary = Vocabulary(np.concatenate([np.array([h for h in df], np.int64).view(np.uint64)]))
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[h] + 1))) for h in self.vocabulary.hashes.view(np.int64).tolist()], np.int64)
        self.queries = [(q, *np.unique(self.vocabulary.find(t)[1], return_counts=True)) for (q, _), t in zip(queries, asked, strict=True)]


class Searcher:
    """The heaps of a block's queries, filled window by window."""

    def __init__(self, block: Block):
        self.block, self.heap = block, {}

    def window(self, ids: pa.Array, sizes: np.ndarray, terms: np.ndarray, df: np.ndarray, places: np.ndarray, counts: np.ndarray) -> None:
        b, n = self.block, len(sizes)
        at, no = b.vocabulary.find(terms)
        run = np.full(len(b.vocabulary.hashes), -1)
        run[no] = at
        stop = np.cumsum(df)
        start = stop - df
        weight = np.zeros(len(terms), np.int64)
        weight[at] = b.weight[no]
        m = 25 + (75 * sizes * b.n_docs) // b.n_terms
        gain = np.repeat(weight, df) * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[places]))
        # The occupancy bitset of each term: its bytes, and what to set in them.
        new = np.ones(len(places), bool)
        new[1:] = places[1:] >> 3 != places[:-1] >> 3
        new[start] = True
        first = np.flatnonzero(new)
        byte, bits = places[first] >> 3, np.bitwise_or.reduceat(np.left_shift(1, places & 7).astype(np.uint8), first) if len(first) else np.zeros(0, np.uint8)
        b_start, b_stop = np.searchsorted(first, start), np.searchsorted(first, stop)
        score, occupied = np.zeros(n, np.int64), np.zeros((n + 7) // 8, np.uint8)
        for q, numbers, times in b.queries:
            for r, t in zip(run[numbers].tolist(), times.tolist(), strict=True):
                if r >= 0:
                    s, e = start[r], stop[r]
                    score[places[s:e]] += gain[s:e] if t == 1 else t * gain[s:e]
                    s, e = b_start[r], b_stop[r]
                    occupied[byte[s:e]] |= bits[s:e]
            touched = np.flatnonzero(np.unpackbits(occupied, count=n, bitorder="little"))
            if len(touched):
                self._harvest(q, ids, touched, score[touched])
                score[touched] = 0
                occupied[:] = 0

    def _harvest(self, q: int, ids: pa.Array, touched: np.ndarray, values: np.ndarray) -> None:
        held = self.heap.get(q)
        least = max(1, int(held[0][-1]) if held and len(held[0]) == self.block.k else 1)
        keep = values >= least
        touched, values = touched[keep], values[keep]
        if not len(values):
            return
        if len(values) > self.block.k:
            keep = values >= np.partition(values, -self.block.k)[-self.block.k]
            touched, values = touched[keep], values[keep]
        found = pa.table({"score": values, "id": ids.take(pa.array(touched))})
        if held:
            found = pa.concat_tables([found, pa.table({"score": held[0], "id": held[1]})])
        order = pc.sort_indices(found, sort_keys=[("score", "descending"), ("id", "ascending")], null_placement="at_start")[:self.block.k]
        found = found.take(order).combine_chunks()
        self.heap[q] = (found.column("score").to_numpy(), found.column("id").combine_chunks())


def search(index: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of every row of ``read_queries``. Queries go against the index in blocks of about ``block`` terms."""
    spark = index.sparkSession
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
    df = materialize(index.select(F.inline(F.arrays_zip("terms", "df"))).groupBy("terms").agg(F.sum("df").alias("df")), "search-df")
    n_blocks = 1 + (queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0] // block)
    kind = index.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("score", T.LongType()), T.StructField("id", kind)])
    found = []
    for no in range(n_blocks):
        own = queries.filter(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == no)
        asked = [(r["query"], r["terms"]) for r in own.select("query", "terms").collect()]  # BLOCK
        known = df.join(own.select(F.explode("terms").alias("terms")).distinct(), "terms", "left_semi").collect()  # no more than the block's terms
        if not known:
            continue
        held = spark.sparkContext.broadcast(Block(asked, {r["terms"]: r["df"] for r in known}, total["docs"], total["terms"], k))

        def run(it: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            heaps = Searcher(held.value)
            for b in it:
                for r in range(len(b)):
                    value = lambda c, b=b, r=r: b.column(c)[r].values
                    number = lambda c: value(c).to_numpy(zero_copy_only=False)
                    heaps.window(value("ids"), number("sizes"), number("terms").view(np.uint64), number("df"), number("places"), number("counts"))
            for q, (scores, ids) in heaps.heap.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), q)), pa.array(scores), ids], ["query", "score", "id"])

        found.append(index.select("ids", "sizes", "terms", "df", "places", "counts").mapInArrow(run, schema))
    best = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        best = best.unionByName(more)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc("id")))).filter(F.col("rank") <= k)
    return best.join(queries.select("query", "item"), "query").select("item", "rank", "id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  most_terms: int = VOCABULARY, block: int = BLOCK, **options: int) -> DataFrame:
    """item, rank, id and score of the ``k`` best documents for each row of ``queries``."""
    asked = read_queries(queries, item_col, item_text)
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    listed = None
    if terms.count() <= most_terms:
        listed = np.array([r[0] for r in terms.collect()], np.int64).view(np.uint64)
    found = search(build_index(docs, listed, id_col, text_col, **options), asked, k, block)
    return found.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
