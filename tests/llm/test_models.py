"""Language profiles and rule ensembles worked out again in plain Python."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from brightwater.llm import language_id, quality_classifier

DIMS, N = 512, 3
WORDS = {"aa": "ala ola tre vant ikke øre".split(), "bb": "kot zima это слово żaba".split(), "cc": "the cat sat on a mat".split()}


def letter(c):
    return np.random.Generator(np.random.PCG64([ord(c), DIMS])).integers(0, 2, DIMS, dtype=np.int8).astype(float) * 2 - 1


def vector(text):
    """The sum of all n-grams' vectors, one n-gram after the other; None without letters."""
    shown = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    if not shown.strip():
        return None
    shown = " " + re.sub(" +", " ", shown.strip(" ")) + " "
    out = np.zeros(DIMS)
    for i in range(len(shown) - N + 1):
        gram = np.ones(DIMS)
        for place, c in enumerate(shown[i:i + N]):
            gram *= np.roll(letter(c), place)
        out += gram
    return out


def test_languages_by_plain_cosines(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(WORDS[lang], k=rng.randint(1, 30))), lang) for k in range(90) for lang in [rng.choice(list(WORDS))]]
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "123 !?", "cc"), (203, "A", None), (204, "Ala OLA", None), (None, "kot zima", "bb"), (205, "the 東京 cat", None), (206, "x" * 200_000 + " zima", None)]
    df = spark.createDataFrame([(*r, "s", 1.0) for r in rows], "doc_id long, text string, lang string, source string, score double")
    got = {(r.doc_id, r.held_out): (r.lang_pred, r.score) for r in language_id.language_id(df).collect()}
    sums = defaultdict(lambda: np.zeros(DIMS))
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 0
    for k, text, lang in rows:
        if lang and not out(k) and (v := vector(text)) is not None:
            sums[lang] += v / np.linalg.norm(v)
    profiles = {lang: v / np.linalg.norm(v) for lang, v in sorted(sums.items())}
    for k, text, _ in rows:
        v = vector(text)
        near = {} if v is None else {lang: float(p @ v / np.linalg.norm(v)) for lang, p in profiles.items()}
        pred, score = got.pop((k, out(k)))
        assert pred == (max(near, key=near.get) if near else "und"), (k, text)
        assert score == pytest.approx(max(0.0, near[pred]) if near else 0.0, abs=1e-5)
    assert not got


def test_languages_that_tie_go_by_name(spark):
    rows = [(k, "same text", lang) for k, lang in enumerate(["zz", "bb", "zz", "bb", "mm", "mm"] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language_id.fit_profiles(df.select("text", "lang"))
    assert list(profiles) == ["bb", "mm", "zz"]
    same = dict.fromkeys(profiles, profiles["bb"])
    assert {r.lang_pred for r in language_id.identify(df, same).collect()} == {"bb"}


def plain_statistics(text):
    text = text or ""
    words, lines, n = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n"), max(len(text), 1)
    count = lambda p, flags=0: len(re.findall(p, text, flags))
    many = max(len(words), 1)
    return {"log_chars": math.log1p(len(text)), "log_words": math.log1p(len(words)), "word_chars": len(text) / many, "upper": sum(c.isupper() for c in text) / n, "digits": count("[0-9]") / n, "marks": count("[.,;:]") / n,
            "symbols": count(r"[#*$%&|<>]") / n, "bangs": count("!") / n, "distinct_words": len(set(words)) / many, "distinct_lines": len(set(lines)) / len(lines)}


def test_statistics_of_whole_texts(spark):
    texts = ["Plain words. And MORE, of them!", "", None, "a a a\na a a\n$$ ## 123", "Ünïcode ÀÉ x\n\n", "w " * 50_000 + "End!", "one\ttwo\x0bthree"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in df.select("i", *quality_classifier.statistics(F.coalesce("text", F.lit("")))).collect():
        for name, value in plain_statistics(texts[r.i]).items():
            assert r[name] == pytest.approx(value), (r.i, name)


def test_scores_by_plain_rules(spark):
    rng = random.Random(5)
    rows = []
    for k in range(300):
        good = rng.random() < 0.5
        rows.append((k, " ".join(rng.choices("good plain words make a sentence.".split() if good else "BUY $$$ !!! now now 100%".split(), k=rng.randint(1, 60))), int(good != (rng.random() < 0.05))))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows] + [(5, 1), (5, 0), (6, None), (None, 1)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    stats = docs.select(F.col("doc_id").alias("id"), *quality_classifier.statistics(F.coalesce("text", F.lit(""))))
    known = labels.filter("quality IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("label"))
    intercept, rules = quality_classifier.fit_rules(known.join(stats, "id").coalesce(1))
    assert 0 < len(rules) and all(w for _, w in rules)
    for r in stats.withColumn("score", quality_classifier.score_of(intercept, rules)).collect():
        total = intercept + sum(w for rule, w in rules if all(r[name] <= limit if op == "<=" else r[name] > limit for name, op, limit in rule))
        assert r.score == pytest.approx(1 / (1 + math.exp(-total)))
    got = quality_classifier.quality_classifier(docs, labels).collect()
    assert len(got) == 302 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    right = [(r.score >= 0.5) == ("good" in (t := rows[r.doc_id][1]) or "plain" in t or "words" in t) for r in got if r.doc_id < 300]
    assert sum(right) > 240
