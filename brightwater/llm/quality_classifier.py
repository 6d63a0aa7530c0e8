"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of every whole text are Spark columns. A random forest of shallow trees is grown on
labelled rows; each path from a root to a node is a rule, the conjunction of its splits. A
lasso logistic regression gives most rules weight 0. What remains is compiled into one column
expression, so scoring is a projection over the statistics, without a model on the executors.

At most about ``fit_rows`` labelled rows (by a hash of the id) are learned from.

Nulls: a null text counts as empty and is scored; a null label isn't learned from; a null id
belongs to no held-out fold and has no label. Repeated rows are documents of their own; a
document with several labels is learned from once for each. If there are no labels, or all are
equal, the score is the share of label 1 (0.5 without any). An empty table gives no rows. Other
columns are never looked at.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, held_out, sampled

#: A rule: conditions (statistic, "<=" or ">", threshold), all of which hold.
Rule = tuple[tuple[str, str, float], ...]

STATISTICS = ["log_chars", "log_words", "word_chars", "upper", "digits", "marks", "symbols", "bangs", "stops", "distinct_words", "repeat_words", "distinct_lines", "low_lines"]


def statistics(text: Column) -> list[Column]:
    """The statistics by name: lengths, shares of kinds of characters, shares of distinct words and lines."""
    n = F.greatest(F.length(text), F.lit(1))
    count = lambda p: F.regexp_count(text, F.lit(p))
    words, lines = F.regexp_extract_all(text, F.lit("(" + WORD + ")")), F.split(text, "\n")
    n_words = F.greatest(F.size(words), F.lit(1))
    values = {
        "log_chars": F.log1p(F.length(text)), "log_words": F.log1p(F.size(words)), "word_chars": F.length(text) / n_words,
        "upper": count(r"\p{Lu}") / n, "digits": count("[0-9]") / n, "marks": count(r"[.,;:]") / n,
        "symbols": count(r"[#*$%&|<>]") / n, "bangs": count("!") / n, "stops": count(r"[.!?](?=\s|$)") / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words, "repeat_words": count(r"(?<!\S)(\S+) \1(?!\S)") / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines), "low_lines": count(r"(?m)^\p{Ll}") / F.size(lines),
    }
    return [values[k].cast("double").alias(k) for k in STATISTICS]


def rules_of(forest: str) -> list[Rule]:
    """Every path of a forest's printed trees, as distinct rules."""
    found: dict[Rule, None] = {}
    path: list[tuple[str, str, float]] = []
    for line in forest.splitlines():
        if line.lstrip().startswith("Tree"):
            path, base = [], len(line) - len(line.lstrip()) + 2
        elif m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path[len(m[1]) - base:] = [(STATISTICS[int(m[2])], m[3], float(m[4]))]
            found[tuple(sorted(path))] = None
    return list(found)


def holds(rule: Rule) -> Column:
    """1.0 where all conditions hold, else 0.0."""
    out = F.lit(True)
    for name, op, limit in rule:
        out = out & (F.col(name) <= limit if op == "<=" else F.col(name) > limit)
    return out.cast("double")


def fit_rules(labelled: DataFrame, trees: int = 12, depth: int = 3, lasso: float = 0.001, seed: int = 7) -> tuple[float, list[tuple[Rule, float]]]:
    """(intercept, rules with weights) from rows of statistics and ``label``."""
    rows = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(labelled)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed, minInstancesPerNode=5).fit(rows)
    rules = rules_of(forest.toDebugString)
    if not rules:
        return 0.0, []
    hits = labelled.select(F.col("label"), *[holds(r).alias(f"r{i}") for i, r in enumerate(rules)])
    hits = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(hits)
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=False).fit(hits.select("label", "features"))
    weights = model.coefficients.toArray().tolist()
    return float(model.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if w]


def score_of(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The ensemble as one column over the statistics."""
    total = F.lit(intercept)
    for rule, weight in rules:
        total = total + holds(rule) * weight
    return 1 / (1 + F.exp(-total))


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                       fit_rows: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """A row per document: id, held_out, score, predicted."""
    doc_id, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    stats = materialize(docs.select(doc_id.alias("id"), text.alias("text")).select("id", *statistics(F.col("text"))), "quality-stats")
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label")).filter(
        F.col("label").isNotNull() & ~held_out(F.col("id")))
    total = known.count()
    known = sampled(known, fit_rows / max(1, total), F.col("id"), F.col("label"))
    if total and known.isEmpty():
        raise ValueError(f"{total} labels, and not one in a sample of about {fit_rows}: nearly all share one id")
    labelled = materialize(known.join(stats, "id").coalesce(4), "quality-labelled")  # about fit_rows rows
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if len(counts) < 2:
        score = F.lit(float(next(iter(counts), 0.5)))
    else:
        score = score_of(*fit_rules(labelled))
    out = stats.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
