"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Words are ASCII letters and digits and all that is not ASCII, A-Z lower-cased. A benchmark item gives every run of ``n``
words as a window, an item of fewer words is one window. Each task hashes the windows of a document, looks them
up in the set, and holds the words of every hit against the window's own, byte by byte. Neither texts nor windows are shuffled.

The set is broadcast while its windows take at most ``most_bytes``; their size is summed before anything is fetched. Beyond that
only a bitmap of fixed size is broadcast: what passes it is joined to the benchmark's windows by hash and words
(``common.join_by_size``: a passage that a third of all documents hold stays where it is). Both ways give the same rows.

Nulls: a null text has no words, neither in documents nor in items; a null id of a document is returned, a null id of an
item is written ``null``. Items of one id are one item. Repeated rows are documents of their own. Empty tables give no rows, or no
hits. Other columns of documents are never looked at and stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import KeyFilter, drop_matching, join_by_size, row_digest
from .words import FOLD, NOT_ALNUM, Segments, batches, equal_runs, ngrams

#: Bytes of windows that are broadcast at most, and bits of the bitmap that is broadcast instead.
MOST_BYTES, BITMAP_BITS = 64 << 20, 1 << 28
SPAN = T.ArrayType(T.StructType([T.StructField("from_word", T.LongType()), T.StructField("to_word", T.LongType())]))


def words_of(data: np.ndarray, bounds: np.ndarray) -> Segments:
    return Segments(FOLD[data], bounds, NOT_ALNUM)


def item_windows(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(h, size, gram, item): the windows of every item, each once. ``gram`` is the words with a space between two."""
    rows = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")).alias("item"), F.col(f"`{text_col}`").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i, j, data, bounds in batches(b.column("text")):
                words = words_of(data, bounds)
                hashes, per = words.hashes(), words.per_doc()
                for size in sorted({int(min(k, n)) for k in per if k}):
                    at, h = ngrams(hashes, words.doc, size)
                    keep = per[words.doc[at]] == size if size < n else np.ones(len(at), bool)
                    at, h = at[keep], h[keep]
                    grams = [b" ".join(words.data[words.start[p + k]:words.end[p + k]].tobytes() for k in range(size)).decode() for p in at.tolist()]
                    owners = b.column("item").slice(i, j - i).take(pa.array(words.doc[at]))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(at), size, np.int32)), pa.array(grams, pa.string()), owners], ["h", "size", "gram", "item"])

    return rows.mapInArrow(run, "h long, size int, gram string, item string").distinct()


class GramSet:
    """Windows by hash, with their words and the items that hold them."""

    def __init__(self, rows: list):
        """rows: (h, size, gram, items)."""
        rows = sorted(rows, key=lambda r: r[0] % 2**64)
        self.hashes = np.array([r[0] % 2**64 for r in rows], np.uint64)
        self.sizes = np.array([r[1] for r in rows], np.int64)
        self.items = [r[3] for r in rows]
        texts = [r[2].encode() for r in rows]
        raw = np.frombuffer(b"".join(texts), np.uint8)
        self.words = Segments(raw, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), np.arange(256) == 0x20)
        self.first = np.concatenate([[0], np.cumsum(self.words.per_doc())])[:-1].astype(np.int64)
        self.bits = max(1 << 12, 1 << (16 * len(rows)).bit_length())
        self.seen = np.zeros(self.bits, bool)
        self.seen[self.hashes & np.uint64(self.bits - 1)] = True

    def hits(self, words: Segments, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, window) of every occurrence of a window, verified by its words."""
        places, windows = [], []
        for size in np.unique(self.sizes).tolist():
            at, h = ngrams(hashes, words.doc, size)
            near = self.seen[h & np.uint64(self.bits - 1)]
            at, h = at[near], h[near]
            low, high = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
            each = high - low
            at, w = np.repeat(at, each), np.repeat(low - np.concatenate([[0], np.cumsum(each)[:-1]]) if len(each) else low, each) + np.arange(int(each.sum()))
            right = self.sizes[w] == size
            at, w = at[right], w[right]
            mine, its = (at[:, None] + np.arange(size)).ravel(), (self.first[w][:, None] + np.arange(size)).ravel()
            same = equal_runs(words.data, words.start[mine], words.end[mine], self.words.data, self.words.start[its], self.words.end[its])
            same = same.reshape(-1, size).all(axis=1)
            places.append(at[same]), windows.append(w[same])
        return np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(windows or [np.zeros(0, np.int64)])


def runs_of(places: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges that the places cover, overlapping or touching ones merged."""
    out: list[tuple[int, int]] = []
    for p, e in sorted(zip(places.tolist(), (places + sizes).tolist(), strict=True)):
        if out and p <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((p, e))
    return out


def _spans(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"from_word": s, "to_word": e} for s, e in spans]


def _by_set(rows: DataFrame, found: GramSet) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(found)  # MOST_BYTES
    schema = T.StructType([rows.schema["id"], rows.schema["digest"], T.StructField("n_words", T.LongType()), T.StructField("spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))])
    span = pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = held.value
        for b in it:
            n_words, spans, items = [], [], []
            for i, j, data, bounds in batches(b.column("text")):
                words = words_of(data, bounds)
                per = words.per_doc()
                start = np.concatenate([[0], np.cumsum(per)])
                at, w = grams.hits(words, words.hashes())
                doc = words.doc[at]
                n_words.append(per)
                own: list[list] = [[] for _ in range(j - i)]
                names: list[list] = [[] for _ in range(j - i)]
                order = np.argsort(doc, kind="stable")
                cuts = np.flatnonzero(np.diff(doc[order])) + 1
                for part in np.split(order, cuts) if len(order) else []:
                    d = int(doc[part[0]])
                    own[d] = _spans(runs_of(at[part] - start[d], grams.sizes[w[part]]))
                    names[d] = sorted({x for k in np.unique(w[part]).tolist() for x in grams.items[k]})
                spans += own
                items += names
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("digest"), pa.array(np.concatenate(n_words) if n_words else [], pa.int64()),
                                              pa.array(spans, span), pa.array(items, pa.list_(pa.string()))], schema.names)

    return rows.mapInArrow(run, schema)


def _by_join(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """The same rows where the set is too large to broadcast: what passes a bitmap of fixed size is joined to the windows."""
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # n at most
    bit = F.pmod("h", F.lit(BITMAP_BITS)) + 1
    bitmap = windows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    held = rows.sparkSession.sparkContext.broadcast({r["no"]: bytes(r["map"]) for r in bitmap.collect()})  # BITMAP_BITS / 8 bytes
    cand = T.ArrayType(T.StructType([T.StructField("place", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("gram", T.StringType())]))
    schema = T.StructType([rows.schema["id"], rows.schema["digest"], T.StructField("n_words", T.LongType()), T.StructField("near", cand)])
    kind = pa.list_(pa.struct([("place", pa.int64()), ("size", pa.int32()), ("h", pa.int64()), ("gram", pa.string())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_map = len(next(iter(held.value.values()), b""))
        bits = np.zeros(BITMAP_BITS // 8, np.uint8)
        for no, part in held.value.items():
            bits[(no - 1) * per_map:no * per_map] = np.frombuffer(part, np.uint8)
        for b in it:
            n_words, near = [], []
            for i, j, data, bounds in batches(b.column("text")):
                words = words_of(data, bounds)
                hashes, per = words.hashes(), words.per_doc()
                start = np.concatenate([[0], np.cumsum(per)])
                own: list[list] = [[] for _ in range(j - i)]
                for size in sizes:
                    at, h = ngrams(hashes, words.doc, size)
                    low = h & np.uint64(BITMAP_BITS - 1)
                    hit = (bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    for p, x in zip(at[hit].tolist(), h[hit].view(np.int64).tolist(), strict=True):
                        gram = b" ".join(words.data[words.start[p + k]:words.end[p + k]].tobytes() for k in range(size)).decode()
                        d = int(words.doc[p])
                        own[d].append({"place": p - int(start[d]), "size": size, "h": x, "gram": gram})
                n_words.append(per)
                near += own
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("digest"), pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.array(near, kind)], schema.names)

    docs = materialize(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "leaks-near")
    near = docs.select("row", F.inline("near"))
    holders = windows.groupBy("h", "gram").agg(F.sort_array(F.collect_set("item")).alias("items"))  # the items of one window
    per = materialize(near.groupBy("h", "gram").agg(F.count(F.lit(1)).alias("n")).join(holders, ["h", "gram"]), "leaks-windows")
    hits = join_by_size(near, per, ["h", "gram"], "n")
    spot = F.struct("place", "size")
    # What is gathered are the places and items of one document.
    mine = hits.groupBy("row").agg(F.collect_set(spot).alias("spots"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))

    def merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            spans = [_spans(runs_of(np.array([s["place"] for s in x]), np.array([s["size"] for s in x]))) for x in b.column("spots").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(spans, pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())]))), b.column("items")], ["row", "spans", "items"])

    spans = mine.mapInArrow(merged, T.StructType([T.StructField("row", T.LongType()), T.StructField("spans", SPAN), T.StructField("items", T.ArrayType(T.StringType()))]))
    none = F.array()
    return docs.drop("near").join(spans, "row", "left").select("id", "digest", "n_words", F.coalesce("spans", none.cast(SPAN)).alias("spans"), F.coalesce("items", none.cast("array<string>")).alias("items"))


def _scan(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_col: str, item_text: str, most_bytes: int) -> DataFrame:
    windows = materialize(item_windows(benchmark, n, item_col, item_text), "leaks-items")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), row_digest(F.col(f"`{text_col}`")).alias("digest"), F.col(f"`{text_col}`").alias("text"))
    held = windows.agg(F.coalesce(F.sum(F.length("gram") + F.length("item") + 64), F.lit(0))).first()[0]
    if held > most_bytes:
        return _by_join(rows, windows)
    found = windows.groupBy("h", "size", "gram").agg(F.collect_set("item").alias("items")).collect()
    return _by_set(rows, GramSet([tuple(r) for r in found]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """A row per document: id, n_words, n_hit, spans (from_word, to_word), items.

    ``spans`` are the ranges of words inside occurrences of windows, ``items`` the ids, as strings and in order, of the items they are of.
    """
    out = _scan(docs, benchmark, n, id_col, text_col, item_col, item_text, most_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to_word"] - s["from_word"])
    return out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items")


def cut_words(text: str | None, spans: list) -> str | None:
    """``text`` without the words of the spans and what stands between them; the rest keeps its own spacing."""
    if text is None or not spans:
        return text
    raw = text.encode()
    words = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    out, at = [], 0
    for s in spans:
        stop = int(words.start[s["to_word"]]) if s["to_word"] < len(words.start) else int(words.end[-1])
        out.append(raw[at:int(words.start[s["from_word"]])])
        at = stop
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """``docs`` with all columns, without the words of leaked windows, or without the documents that hold any (``remove``: spans, documents)."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is spans or documents")
    found = _scan(docs, benchmark, n, id_col, text_col, item_col, item_text, most_bytes).filter("size(spans) > 0")
    # Rows of one id and text have the same spans.
    gone = materialize(found.select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"), "spans").dropDuplicates(["gone_id", "gone_digest"]), "leaks-gone")
    own_id, own = F.col(f"`{id_col}`"), row_digest(F.col(f"`{text_col}`"))
    if remove == "documents":
        return drop_matching(docs, gone.drop("spans"), gone_id=own_id, gone_digest=own)
    listed = KeyFilter(gone.select(F.xxhash64("gone_id", "gone_digest").alias("k")), "k")
    rows = docs.select(F.struct("*").alias("doc"), own_id.alias("_i"), own.alias("_d"))
    marked = listed.mark(rows, F.xxhash64("_i", "_d"))
    near = marked.filter("bm_hit")
    near = near.join(gone, near["_i"].eqNullSafe(gone["gone_id"]) & near["_d"].eqNullSafe(gone["gone_digest"]), "left").select("doc.*", F.col("spans").alias("_spans"))
    names, place = docs.columns, docs.columns.index(text_col)

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = [cut_words(t, s) for t, s in zip(b.column(place).to_pylist(), b.column(len(b.columns) - 1).to_pylist(), strict=True)]
            columns = list(b.columns[:-1])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return marked.filter(~F.col("bm_hit")).select("doc.*").unionByName(near.mapInArrow(cut, docs.schema))
