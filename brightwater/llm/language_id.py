"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors by
multiplication, each rotated by its place so that order counts; a document bundles its
n-grams' vectors by addition, and a language's prototype bundles its documents' vectors, each of
unit length. A document gets the language whose prototype is nearest by cosine.

A prototype is one vector per language, so what is gathered does not grow with the corpus. At
most about ``fit_rows`` labelled documents (by a hash of the id) are learned from; all
documents are predicted, over their whole texts.

Nulls: a null text, or one without letters, is ``und`` with score 0; a null lang is not learned
from; a null id belongs to no held-out fold. If nothing can be learned from, all is ``und``.
Languages that tie: the first by name. Repeated rows are documents of their own. An empty
table gives no rows. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, sampled

_SPACE = 0x20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


class Encoder:
    """Document vectors; remembers the vectors of up to ``remember`` n-grams."""

    def __init__(self, dims: int, n: int, remember: int = 24_000):
        self.dims, self.n = dims, n
        self._letter: dict[int, np.ndarray] = {}
        self._row: dict[int, int] = {}
        self._vectors = np.zeros((remember, dims), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self._letter:
            rng = np.random.Generator(np.random.PCG64([code, self.dims]))
            self._letter[code] = (rng.integers(0, 2, self.dims, dtype=np.int8) * 2 - 1).astype(np.float32)
        return self._letter[code]

    def _bind(self, gram: int) -> np.ndarray:
        out = np.ones(self.dims, np.float32)
        for place in range(self.n):
            out *= np.roll(self.letter((gram >> (21 * place)) & 0x1FFFFF), place)
        return out

    def _rows(self, grams: list[int]) -> list[int]:
        try:
            return [self._row[g] for g in grams]
        except KeyError:
            new = [g for g in grams if g not in self._row]
        if len(self._row) + len(new) > len(self._vectors):
            self._row, new = {}, grams
        for g in new:
            self._row[g] = len(self._row)
            self._vectors[self._row[g]] = self._bind(g)
        return [self._row[g] for g in grams]

    def encode(self, text: str | None) -> np.ndarray | None:
        """The vector of the whole text, or None where it has no letters."""
        codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        is_letter = _letters()[codes]
        if not is_letter.any():
            return None
        codes = np.concatenate([[_SPACE], np.where(is_letter, codes, _SPACE), [_SPACE]])
        keep = codes != _SPACE
        keep[1:] |= codes[:-1] != _SPACE
        keep[0] = True
        codes = codes[keep]
        grams = codes[:len(codes) - self.n + 1].copy()
        for place in range(1, self.n):
            grams |= codes[place:len(codes) - self.n + 1 + place] << (21 * place)
        grams, counts = np.unique(grams, return_counts=True)
        out = np.zeros(self.dims, np.float32)
        for k in range(0, len(grams), 4096):
            out += counts[k:k + 4096].astype(np.float32) @ self._vectors[self._rows(grams[k:k + 4096].tolist())]
        return out


@lru_cache(maxsize=1)
def _encoder(dims: int, n: int) -> Encoder:
    return Encoder(dims, n)


def fit_profiles(labelled: DataFrame, dims: int = 512, n: int = 3) -> dict[str, np.ndarray]:
    """Prototypes by language. labelled: text, lang; each task sends one vector per language."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = _encoder(dims, n), {}
        for b in it:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                if (v := encoder.encode(text)) is not None and (norm := np.linalg.norm(v)) > 0:
                    sums[lang] = sums.get(lang, 0) + v / norm
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype(np.float64) for v in sums.values()], pa.list_(pa.float64()))], ["lang", "sums"])

    partial = labelled.select("text", "lang").mapInArrow(run, "lang string, sums array<double>")
    summed = partial.select("lang", F.posexplode("sums").alias("dim", "x")).groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():  # languages x dims numbers
        out.setdefault(r["lang"], np.zeros(dims))[r["dim"]] = r["x"]
    return {k: out[k] / (np.linalg.norm(out[k]) or 1.0) for k in sorted(out)}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", dims: int = 512, n: int = 3) -> DataFrame:
    """A row per document: id, lang_pred, score (cosine, 0 at least)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names, matrix = list(profiles), np.array(list(profiles.values())).reshape(len(profiles), dims)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(dims, n)
        for b in it:
            langs, scores = [], []
            for text in b.column("text").to_pylist():
                v = encoder.encode(text) if names else None
                norm = 0.0 if v is None else float(np.linalg.norm(v))
                if not norm:
                    langs.append("und"), scores.append(0.0)
                    continue
                near = np.round(matrix @ v / norm, 9)  # equal profiles are equal whatever way their products are summed
                best = int(near.argmax())
                langs.append(names[best]), scores.append(min(1.0, max(0.0, float(near[best]))))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = 20_000) -> DataFrame:
    """Learns from the labelled documents outside the held-out fold and predicts all."""
    doc_id = F.col(f"`{id_col}`")
    labelled = docs.filter(F.col(f"`{lang_col}`").isNotNull() & ~held_out(doc_id))
    total = labelled.count()
    chosen = sampled(labelled, fit_rows / max(1, total), doc_id, F.col(f"`{text_col}`"))
    if total and chosen.isEmpty():
        raise ValueError(f"{total} labelled rows, and not one in a sample of about {fit_rows}: nearly all share one id and text")
    profiles = fit_profiles(chosen.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")))
    out = identify(docs, profiles, id_col, text_col)
    return out.select(id_col, held_out(F.col(f"`{id_col}`")).alias("held_out"), "lang_pred", "score")
