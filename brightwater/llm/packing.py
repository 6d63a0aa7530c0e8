"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tokenising is the work: each map task cuts documents at white space (no token crosses it),
looks words up in a table of ids it has already asked the tokenizer for, and emits one small row
per piece. Only those rows are shuffled.

Packing is bounded-space online best-fit. Pieces are dealt evenly to partitions, each worth about
``shard_sequences`` sequences, and more where that would make over ``MOST_STREAMS`` of them: a stream holds
as little whatever its length, and so does its sort, which spills. A partition is a stream: pieces
arrive in the order of a hash, a few batches at a time, and all that is held are the open bins, of
which there are ``open_bins`` at most. A piece goes to the open bin whose free space is the least that
still holds it, found with one shift of a bitset keyed by free space. Opening a bin beyond the
bound closes the fullest one first.

Nulls: a null text is an empty document, which is the end token alone; a null id is packed like
any other. Repeated rows are documents of their own. An empty table gives no rows. Other columns
are never looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

#: Words and their parts whose ids a worker remembers, twice over.
REMEMBER = 450_000
#: Streams at most; a shuffle of millions of partitions would cost more than what it deals out.
MOST_STREAMS = 1 << 14
#: A word that stands between the words of one call to the tokenizer; words that hold it are asked for alone.
MARK = b"^"
#: Texts of at least this many words are done in parts.
LONG = 20_000
#: A letter (ASCII, Latin-1 or Cyrillic, in UTF-8), then ASCII punctuation to the end that can't start a contraction.
_TAIL = re.compile(rb"(.*(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xd0\xd1][\x80-\xbf]))([!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)", re.DOTALL)
#: Lower-case letters (ASCII, Latin-1, Cyrillic) that are one code point each.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf]|\xd0[\xb0-\xbf]|\xd1[\x80-\x8f])+")


class WordTokenizer:
    """Ids of whole texts for a lower-casing tokenizer that never joins text across white space.

    What is remembered are the parts of words: a run of ASCII punctuation at a word's end is a token
    run of its own, so ``word``, ``Word`` and ``word,`` ask the tokenizer once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self._tokenizer = Tokenizer.from_file(path)
        self._check()
        # Words of composed lower-case letters alone are past normalising and are one run each.
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=False)])
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        ends = [i for t, i in self._tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]
        self._ends_word = np.zeros(max(ends, default=0) + 1, bool)
        self._ends_word[ends] = True
        self._known: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}
        #: Strings that are one token wherever they stand; texts that hold them are encoded whole.
        self._special = [t.content.lower().encode() for t in self._tokenizer.get_added_tokens_decoder().values()]

    def _check(self) -> None:
        """Words may be asked for one by one only if case and the white space between them never matter."""
        ids = lambda t: self._tokenizer.encode(t, add_special_tokens=False).ids
        words = ["Ab", "don't", "x1,", "É", "(a", "12", "ПРИВЕТ", "..."]
        apart = [i for w in words for i in ids(w)]
        for text in (" ".join(words), "\n\t".join(words), "  ".join(words) + " ", " " + " ".join(words).lower()):
            if ids(text) != apart:
                raise ValueError("this tokenizer joins text across white space or keeps case; its words can't be encoded apart")

    def _encode(self, text: bytes) -> np.ndarray:
        return np.array(self._tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _ask(self, new: list[bytes]) -> None:
        plain = [w for w in new if w.isalpha() or _PLAIN.fullmatch(w)] if self._ends_word.any() else []
        for k in range(0, len(plain), 5_000):
            part = plain[k:k + 5_000]
            ids = np.array(self._plain.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")  # no offsets
            cuts = np.flatnonzero(self._ends_word[np.minimum(ids, len(self._ends_word) - 1)]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                raw, ends = ids.tobytes(), (cuts * 4).tolist()
                self._known.update(zip(part, [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)], strict=True))
        new = [w for w in new if w not in self._known]
        self._known.update((w, self._encode(w).tobytes()) for w in new if MARK in w)
        new = [w for w in new if MARK not in w]
        mark = self._encode(MARK)
        for k in range(0, len(new), 5_000):
            part = new[k:k + 5_000]
            ids = self._encode((b" " + MARK + b" ").join(part))
            cuts = np.flatnonzero(ids == mark[0])
            if len(mark) != 1 or len(cuts) != len(part) - 1:  # another tokenizer might split or share the mark
                self._known.update((w, self._encode(w).tobytes()) for w in part)
                continue
            raw, starts, ends = ids.tobytes(), [0, *(cuts * 4 + 4).tolist()], [*(cuts * 4).tolist(), len(ids) * 4]
            self._known.update((w, raw[i:j]) for w, i, j in zip(part, starts, ends, strict=True))

    def learn(self, words: set[bytes]) -> None:
        """Afterwards all these words are known. Those not used for long are forgotten."""
        if len(self._known) + len(words) > REMEMBER:
            self._before, self._known = self._known, {}
        known, before = self._known, self._before
        new = words.difference(known)
        known.update((w, before[w]) for w in new if w in before)
        new = new.difference(known)
        parted = {w: m.groups() for w in new if not w.isalpha() and (m := _TAIL.fullmatch(w))}  # most are ASCII letters alone
        asked = new.difference(parted)
        for core, tail in parted.values():
            asked.add(core), asked.add(tail)
        asked.difference_update(known)
        known.update((w, before[w]) for w in asked if w in before)
        self._ask(list(asked.difference(known)))
        for w, (core, tail) in parted.items():
            known[w] = known[core] + known[tail]

    def rest(self) -> None:
        """Keeps only the words of late, for the next task of this worker."""
        self._before = {}

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text. The texts are few, or short."""
        lower = [t.lower() for t in texts]
        whole = [any(x in t for x in self._special) for t in lower]
        split = [[] if w else t.split() for t, w in zip(lower, whole, strict=True)]
        distinct: set[bytes] = set()
        for words in split:
            if len(words) < LONG:
                distinct.update(words)
        self.learn(distinct)
        get = self._known.__getitem__
        short = [None if len(words) >= LONG else b"".join(map(get, words)) for words in split]
        for text, words, found, as_one in zip(texts, split, short, whole, strict=True):
            if as_one:
                yield self._encode(text).tobytes()
            else:
                yield b"".join(self._long(words)) if found is None else found

    def _long(self, words: list[bytes]) -> Iterator[bytes]:
        for k in range(0, len(words), LONG):
            self.learn(set(words[k:k + LONG]))
            yield b"".join(map(self._known.__getitem__, words[k:k + LONG]))


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordTokenizer(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, and with ``with_ids`` the ids themselves (binary, <u4)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = [rows.schema["id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    schema = T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for b in it:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            for k in range(0, len(texts), 256):
                row, piece, start, size, crc, ids = [], [], [], [], [], []
                for i, found in enumerate(tokenizer.ids(texts[k:k + 256]), k):
                    found += end
                    for p, at in enumerate(range(0, len(found), 4 * length)):
                        part = found[at:at + 4 * length]
                        row.append(i), piece.append(p), start.append(at // 4), size.append(len(part) // 4), crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part)
                cols = [b.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(ids, pa.binary())] * with_ids, schema.names)
        tokenizer.rest()

    return rows.mapInArrow(run, schema)


class BestFit:
    """Open bins by free space. Bin numbers count up from 0; a closed bin is forgotten."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.free_bits, self.by_free = 0, {}
        self.n_open = self.n_bins = 0

    def _take(self, room: int) -> int:
        bins = self.by_free[room]
        one = bins.pop()
        if not bins:
            del self.by_free[room]
            self.free_bits ^= 1 << room
        self.n_open -= 1
        return one

    def add(self, size: int) -> tuple[int, int]:
        """(bin, offset) of the next piece."""
        fits = self.free_bits >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            one = self._take(room)
        else:
            if self.n_open == self.open_bins:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            one, room, self.n_bins = self.n_bins, self.length, self.n_bins + 1
        if left := room - size:
            self.by_free.setdefault(left, []).append(one)
            self.free_bits |= 1 << left
            self.n_open += 1
        return one, self.length - room


def pack(pieces: DataFrame, length: int = 4096, open_bins: int = 64, shard_sequences: int = 1024) -> DataFrame:
    """``pieces`` (id, piece, length, ...) with sequence_id and offset, gapless from 0 in each sequence."""
    pieces = materialize(pieces, "pack-pieces")
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("t")).first()["t"]
    streams = max(1, min(MOST_STREAMS, total // (length * shard_sequences)))
    order = ["place", *[c for c in ("id", "piece", "ids_crc32") if c in pieces.columns]]
    dealt = pieces.withColumn("place", F.xxhash64(*order[1:])).repartition(streams).sortWithinPartitions(*order).drop("place")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = BestFit(length, open_bins), TaskContext.get().partitionId() << 40
        for b in it:
            placed = [bins.add(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([first + k for k, _ in placed], pa.int64()), pa.array([at for _, at in placed], pa.int64())], schema.names)

    return dealt.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", open_bins: int = 64) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer_path, length, end_id, id_col, text_col)
    return pack(pieces, length, open_bins).withColumnRenamed("id", id_col)
