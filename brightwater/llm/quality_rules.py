"""Quality rules with host-level verdicts.

Each document gets base counts and fails or passes the base rules. Failures are then summed by
host; a host's rate is shrunk towards all hosts by a beta prior whose two parameters come from
the hosts' own rates (method of moments), so a host of three documents isn't judged on three.
A host whose shrunk rate is above ``host_limit`` is rejected, and with it all its documents.

Nulls: a null text has no words, so its counts are 0 and it fails the base rules; documents of
no host are judged as one host. Repeated rows are documents of their own. An empty table gives
no rows. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import join_by_size
from .words import NEWLINE, SPACE, Segments, batches, count_in, ngrams, within

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def batch_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text of an Arrow array."""
    out = {c: np.zeros(len(texts), np.int64) for c in COUNTS}
    for i, j, data, bounds in batches(texts):
        n = j - i
        inside = ~SPACE[data]
        words, lines = Segments(data, bounds, SPACE), Segments(data, bounds, NEWLINE)
        out["n_words"][i:j] = words.per_doc()
        out["word_chars"][i:j] = count_in(inside & ((data & 0xC0) != 0x80), bounds)
        out["n_symbols"][i:j] = count_in(SYMBOL[data], bounds)

        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(inside, out=total[1:])
        real = total[lines.end] > total[lines.start]
        doc = lines.doc[real]
        _, first = np.unique(within(lines.hashes()[real], doc), return_index=True)
        out["n_dup_lines"][i:j] = np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)

        at, grams = ngrams(words.hashes(), words.doc, 3)
        _, inverse, counts = np.unique(within(grams, words.doc[at]), return_inverse=True, return_counts=True)
        covered = np.zeros(len(words.doc), bool)
        for again in [at[counts[inverse] >= 2]]:
            for k in range(3):
                covered[again + k] = True
        out["n_repeat_words"][i:j] = np.bincount(words.doc[covered], minlength=n)
    return out


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, carry: list[str] | None = None) -> DataFrame:
    """id, host and the base counts of every document's whole text, and the columns named in ``carry`` as c0, c1 and so on."""
    host = F.lit(None).cast("string") if host is None else host.cast("string")
    more = [f"c{k}" for k in range(len(carry or []))]
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(k) for c, k in zip(carry or [], more, strict=True)])
    schema = T.StructType([rows.schema["id"], T.StructField("host", T.StringType()), *[T.StructField(c, T.LongType()) for c in COUNTS], *[rows.schema[k] for k in more]])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            counts = batch_counts(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("host"), *[pa.array(counts[c]) for c in COUNTS], *[b.column(k) for k in more]], schema.names)

    return rows.mapInArrow(run, schema)


def host_verdicts(judged: DataFrame, host_limit: float) -> DataFrame:
    """host_key, host_docs, host_rate, host_ok. A row per host; the prior is fitted over all of them."""
    per = judged.groupBy("host_key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f"))
    per = materialize(per, "rules-hosts")
    rate = F.col("f") / F.col("n")
    moments = per.agg(F.avg(rate).alias("m"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("v"), F.avg(1 / F.col("n")).alias("inv"))
    # What varies beyond chance: the spread of rates less the spread that sampling alone makes.
    own = F.greatest(F.col("v") - F.col("m") * (1 - F.col("m")) * F.col("inv"), F.lit(1e-6))
    strength = F.least(F.greatest(F.col("m") * (1 - F.col("m")) / own - 1, F.lit(1.0)), F.lit(1e4))
    prior = moments.select((F.col("m") * strength).alias("alpha"), ((1 - F.col("m")) * strength).alias("beta"))
    out = per.crossJoin(F.broadcast(prior))  # one row
    shrunk = (F.col("f") + F.col("alpha")) / (F.col("n") + F.col("alpha") + F.col("beta"))
    return out.select("host_key", F.col("n").alias("host_docs"), shrunk.alias("host_rate"), (shrunk <= host_limit).alias("host_ok"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None,
                  host_limit: float = 0.5, min_words: int = 50, carry: list[str] | None = None) -> DataFrame:
    """A row per document: id, the base counts, base_failed, host_rate, kept, and the columns named in ``carry``."""
    counts = base_counts(docs, id_col, text_col, host, carry)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = materialize(counts.withColumn("base_failed", failed).withColumn(
        "host_key", F.coalesce(F.concat(F.lit("h:"), F.col("host")), F.lit("none"))), "rules-counts")
    # A host may hold a third of all documents.
    out = join_by_size(judged, materialize(host_verdicts(judged, host_limit), "rules-verdicts"), ["host_key"], "host_docs")
    return out.select(F.col("id").alias(id_col), *COUNTS, "base_failed", "host_rate",
                      (~F.col("base_failed") & F.col("host_ok")).alias("kept"), *[F.col(f"c{k}").alias(c) for k, c in enumerate(carry or [])])
