"""Spelling variants: a trie self-join with active-node sets over a prefix-partitioned vocabulary.

Words are counted over all documents, then joined with themselves at distance one: one code point inserted, deleted or replaced. Of two such
words, the longer of L code points, everything before the first difference is shared, and everything after it. So for a window [a, b) of
places the pairs that first differ inside it lie in one group: those words of L or L - 1 code points that share the first a and the last L - b.
The first windows are the halves [0, L/2) and [L/2, L): the words of a prefix, and those of a suffix. A group of more than
``most`` words is split into the halves of its window, down to windows of one place, where a group has no more words than the alphabet has
letters. A letter of a run of equal ones can be missing at any place of the run; such a pair counts at the last one. So each pair counts in exactly one group, and no group outgrows a task.

In a group the words' middles make a trie. A node's active nodes are those at distance one of it; they follow from its parent's by one step: the parent,
the siblings, the children, and the children by the same letter of the parent's active nodes. A terminal node with an active terminal node is a pair.
Pairs are folded at once into a word's number of near words and the best of them, so what is shuffled is a row for each word and group.

Words are maximal runs of [A-Za-z] and U+00C0 to U+00FF, only A-Z lower-cased. Of a run whose crc32 of ``<doc_id>:<run>`` divides by 97 the code point at
crc32 mod length is deleted first. Counted are words of ``least_length`` code points that occur ``least_count`` times.

Nulls: a null text has no words; a null id is written as nothing before the colon. Repeated rows are documents of their own. Of near words of one count the first in
code-point order is the form. An empty table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_by_size
from .words import FOLD, Segments, batches

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: The first byte of U+00C0 to U+00FF in UTF-8.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()
#: Bytes of a run from which its checksum is taken alone.
_LONG = 64


def run_checksums(data: np.ndarray, runs: Segments, prefixes: list[bytes]) -> np.ndarray:
    """The crc32 of every run behind its document's prefix."""
    state = np.array([zlib.crc32(p) for p in prefixes], np.uint32)[runs.doc]
    length = runs.end - runs.start
    order = np.argsort(-length, kind="stable")
    n_long = int(np.searchsorted(-length[order], -_LONG, "left"))
    for i in order[:n_long].tolist():
        state[i] = zlib.crc32(data[runs.start[i]:runs.end[i]].tobytes(), int(state[i]))
    short = order[n_long:]
    start, length = runs.start[short], length[short]
    crc = ~state[short]
    for k in range(int(length[0]) if len(short) else 0):
        n = int(np.searchsorted(-length, -k, "left"))  # those longer than k
        crc[:n] = _CRC[(crc[:n] ^ data[start[:n] + k]) & np.uint32(255)] ^ (crc[:n] >> np.uint32(8))
    state[short] = ~crc
    return state


def strings_at(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of every run as a string."""
    upto = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    place = np.arange(int(upto[-1])) + np.repeat(start - upto[:-1], end - start)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(upto), pa.py_buffer(data[place].tobytes()))


def count_words(ids: list[str], texts: pa.Array, least_length: int) -> pa.Table:
    """(word, n) of an Arrow array of texts, for words that are long enough."""
    found = []
    for i, j, data, bounds in batches(texts):
        data = FOLD[data]
        inside = _LETTER[data] | (data == _LEAD)
        inside[1:] |= (data[:-1] == _LEAD) & (data[1:] >= 0x80)
        runs = Segments(data, bounds, inside=inside)
        cut = np.flatnonzero(run_checksums(data, runs, [f"{d}:".encode() for d in ids[i:j]]) % np.uint32(97) == 0)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        length = points[runs.end] - points[runs.start]
        whole = length >= least_length
        whole[cut] = False
        found.append(strings_at(data, runs.start[whole], runs.end[whole]))
        changed = []
        for r in cut[length[cut] > least_length].tolist():
            raw = data[runs.start[r]:runs.end[r]].tobytes()
            word = raw.decode()
            at = zlib.crc32(f"{ids[i + int(runs.doc[r])]}:".encode() + raw) % len(word)
            changed.append(word[:at] + word[at + 1:])
        found.append(pa.array(changed, pa.large_string()))
    counts = pc.value_counts(pa.chunked_array(found, pa.large_string()))
    return pa.table({"word": counts.field("values").cast(pa.string()), "n": counts.field("counts")})


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) over all documents."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield from count_words(b.column("id").to_pylist(), b.column("text"), least_length).to_batches()

    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts.filter(F.col("n") >= least_count), "spelling-words")


def _placed(words: DataFrame) -> DataFrame:
    """Adds what a word has in a window [a, b) of words of L code points: the group's key, and the middle."""
    gone = F.col("l") - F.length("word")  # 1 if the word is the shorter one
    tail = F.col("b") - gone
    key = F.concat_ws("\u0001", F.col("l").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"), F.substring("word", F.lit(1), F.col("a")), F.substring(F.col("word"), tail + 1, F.length("word")))
    return words.withColumn("key", key).withColumn("middle", F.substring(F.col("word"), F.col("a") + 1, tail - F.col("a"))).withColumn("shorter", gone == 1)


def _windows(*pairs: tuple) -> Column:
    return F.inline(F.array(*[F.struct(F.expr(str(a)).cast("int").alias("a"), F.expr(str(b)).cast("int").alias("b")) for a, b in pairs]))


def group_words(words: DataFrame, most: int) -> DataFrame:
    """(key, middle, shorter, word, n): every word in each of its groups, none of which has over ``most`` words but for groups of a single place."""
    twice = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("l"))
    now = _placed(twice.select("word", "n", "l", _windows((0, "l div 2"), ("l div 2", "l"))))
    now, done = materialize(now, "spelling-groups"), []
    while True:
        large = materialize(now.filter("b - a > 1").groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > most), "spelling-large")
        if not large.take(1):
            break
        marked = materialize(join_by_size(now, large, ["key"], "held", "left"), "spelling-marked")
        done.append(marked.filter("held IS NULL"))
        split = marked.filter("held IS NOT NULL").select("word", "n", "l", _windows(("a", "(a + b) div 2"), ("(a + b) div 2", "b")))
        now = materialize(_placed(split), "spelling-groups")
    for more in done:
        now = now.unionByName(more.select(*now.columns))
    return now.select("key", "middle", "shorter", "word", "n")


class Trie:
    """Middles of a group: for each node the children by letter, and which word ends there."""

    def __init__(self, middles: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.ends = [-1]
        for i, middle in enumerate(middles):
            at = 0
            for letter in middle:
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.ends)
                    self.children.append({}), self.ends.append(-1)
                at = self.children[at][letter]
            self.ends[at] = i

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Every two words at distance one, both ways round."""
        children, ends = self.children, self.ends
        todo = [(0, list(children[0].values()))]
        while todo:
            at, active = todo.pop()
            if ends[at] >= 0:
                for v in active:
                    if ends[v] >= 0:
                        yield ends[at], ends[v]
            for letter, node in children[at].items():
                near = {at, *children[at].values(), *children[node].values(), *[children[v][letter] for v in active if letter in children[v]]}
                near.discard(node)
                todo.append((node, list(near)))


def fold_group(words: list[str], counts: list[int], middles: list[str], shorter: list[bool], after: str) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, count of the best, best) for words of a group that have any. ``after`` is the letter that follows all middles.

    Two of the shorter length meet in another group, and so do two words of which one lacks the last letter before an equal one.
    """
    near: dict[int, list] = {}
    for i, j in Trie(middles).pairs():
        if shorter[i] and shorter[j]:
            continue
        if shorter[i] != shorter[j]:
            long, short = (j, i) if shorter[i] else (i, j)
            if middles[long][-1] == after and middles[long][:-1] == middles[short]:
                continue
        mine = near.setdefault(i, [0, (0, "")])
        mine[0] += 1
        mine[1] = min(mine[1], (-counts[j], words[j]))
    for i, (n, (count, word)) in near.items():
        yield words[i], n, -count, word


def near_words(words: DataFrame, most: int = 4096) -> DataFrame:
    """(word, n_near, best, best_n) for each word with a near one. words: word, n, each word once."""
    grouped = group_words(words, most)
    placed = grouped.repartition("key").sortWithinPartitions("key", "middle")
    out = ["word", "n_near", "best_n", "best"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in _and_end(it):
            held = [x for x in (rest, b) if x is not None and len(x)]
            if not held:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column("key")
            new = np.concatenate([[True], pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)]) if len(keys) > 1 else np.array([True])
            first = np.append(np.flatnonzero(new), len(keys))
            upto = len(first) - 1 if b is None else len(first) - 2  # the last group may go on
            rest = None if b is None else table.slice(int(first[upto])).combine_chunks().to_batches()[0]
            size = np.diff(first)[:upto]
            several = np.flatnonzero(size > 1)
            rows = np.concatenate([np.arange(first[g], first[g + 1]) for g in several]) if len(several) else np.zeros(0, np.int64)
            own = table.select(["word", "n", "middle", "shorter"]).take(pa.array(rows, pa.int64())).to_pydict()
            found, at = [], 0
            tails = [k.rpartition("\u0001")[2][:1] for k in keys.take(pa.array(first[several], pa.int64())).to_pylist()]
            for n, after in zip(size[several].tolist(), tails, strict=True):
                part = slice(at, at + n)
                found += fold_group(own["word"][part], own["n"][part], own["middle"][part], own["shorter"][part], after)
                at += n
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], out)

    parts = placed.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def _and_end(it: Iterator) -> Iterator:
    yield from it
    yield None


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word with a form, by pointer jumping; a form's count is at least twice the word's, so there are no cycles."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not now.filter("moved").take(1):
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, most: int = 4096) -> DataFrame:
    """A row per word: word, n, n_near, form, form_n, root.

    ``form`` is the near word of largest count if that is twice the word's own at least, ``root`` the last of a word's forms.
    """
    words = vocabulary(docs, id_col, text_col, least_length, least_count)
    joined = words.join(near_words(words, most), "word", "left")
    has = F.col("best_n") >= 2 * F.col("n")
    formed = materialize(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "spelling-forms")
    last = roots(formed.filter("form IS NOT NULL"))
    return formed.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
