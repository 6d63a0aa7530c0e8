"""Spelling variants, ranked search and decontamination against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from brightwater.llm import decontamination, ranked_search, spelling
from brightwater.llm.ngram_join import ngram_join
from brightwater.llm.quality_rules import batch_counts
from brightwater.llm.words import NOT_ALNUM, Segments, equal_runs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def prose(rng, n, words="a b c d e fox Über 東京 x9 it's the-end"):
    return "".join(rng.choice(words.split()) + rng.choice([" ", "\n", ", ", "  "]) for _ in range(n))


def thue_morse(n):
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


# Words that a polynomial in a fixed base can't tell apart.


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_and_lines_of_one_shape_differ(spark, n):
    a, b = thue_morse(n)
    counts = batch_counts(pa.array([f"{a}\n{b}", f"{a}\n{b}\n{a}"]))
    assert counts["n_dup_lines"].tolist() == [0, 1]
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"x y {a} x y {b}")], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join(docs, words=3, percent=90).collect()}
    assert got == {1: (1, 1), 2: (1, 2), 3: (4, 3)}


def test_a_hash_is_a_word():
    rng = random.Random(5)
    words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(5000)] + ["é" * k for k in range(1, 30)] + ["\U0001F600" * k for k in range(1, 9)]
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    found = defaultdict(set)
    for w, h in zip(words, Segments(raw, np.array([0, len(raw)]), NOT_ALNUM).hashes().tolist(), strict=True):
        found[h].add(w)
    assert len(found) == len(set(words))


def test_runs_are_compared_byte_by_byte():
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in ("one two three seventeen-letters", "one tWo three seventeen-letterz"))
    cuts = [(0, 3), (4, 7), (8, 13), (14, 31), (14, 30), (3, 3)]
    start, end = np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts])
    assert equal_runs(a, start, end, b, start, end).tolist() == [True, False, True, False, True, True]
    assert equal_runs(a, start, end, b, start, end + 1).tolist() == [False] * 6


# Decontamination.


def leaks(docs, items, n=10):
    """(words, hit words, items) of each text."""
    windows = defaultdict(set)
    for item, text in items:
        w = terms(text)
        for i in range(len(w) - min(n, len(w)) + 1):
            if w:
                windows[tuple(w[i:i + min(n, len(w))])].add("null" if item is None else str(item))
    out = []
    for text in docs:
        w, hit, found = terms(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if names := windows.get(tuple(w[i:i + size])):
                    hit |= set(range(i, i + size))
                    found |= names
        out.append((len(w), sorted(hit), sorted(found)))
    return out


@pytest.mark.parametrize("most", [decontamination.MOST_BYTES, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_leaks_by_either_way(spark, monkeypatch, most, seed):
    monkeypatch.setattr(decontamination, "BITMAP_BITS", 1 << 16)
    rng = random.Random(seed)
    items = [(k, prose(rng, rng.choice([2, 3, 4, 5, 6, 9]))) for k in range(30)] + [(None, "lone word here"), (7, "a b c again"), (8, None), (9, " ?! "), (10, "One MORE item, with; ten whole\nwords in it yes")]
    texts = [prose(rng, rng.choice([0, 1, 3, 8, 40, 300])) for _ in range(40)] + [None, "", "?!", "LONE-word here", "one more item with ten whole words in it yes one more item with ten whole words in it yes", "東京"]
    texts += [texts[3], prose(rng, 30_000)] + ["one more item with ten whole words in it yes"] * 50
    docs = spark.createDataFrame([(i if i % 9 else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, digest string, spans int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_leaks(docs, bench, n=4, most_bytes=most).collect()
    want = leaks(texts, items, 4)
    flat = lambda spans: sorted({k for s in spans for k in range(s["from_word"], s["to_word"])})
    rows = Counter((r.doc_id, r.n_words, r.n_hit, tuple(flat(r.spans)), tuple(r["items"])) for r in got)
    assert rows == Counter((i if i % 9 else None, n, len(hit), tuple(hit), tuple(names)) for i, (n, hit, names) in enumerate(want))
    assert any(hit for _, hit, _ in want) and any(not hit for _, hit, _ in want)

    clean = decontamination.decontaminate(docs, bench, "documents", n=4, most_bytes=most)
    assert clean.columns == docs.columns
    assert Counter(r.text for r in clean.collect()) == Counter(t for t, (_, hit, _) in zip(texts, want, strict=True) if not hit)
    cut = decontamination.decontaminate(docs, bench, "spans", n=4, most_bytes=most)
    left = [tuple(w for k, w in enumerate(terms(t)) if k not in set(hit)) for t, (_, hit, _) in zip(texts, want, strict=True)]
    assert cut.columns == docs.columns and Counter(tuple(terms(r.text)) for r in cut.collect()) == Counter(left)


def test_what_is_cut():
    assert decontamination.cut_words("Say: one two, three. Then (four)!", [{"from_word": 1, "to_word": 4}]) == "Say: Then (four)!"
    assert decontamination.cut_words("one two", [{"from_word": 0, "to_word": 2}]) == ""
    assert decontamination.cut_words("x one two!", [{"from_word": 1, "to_word": 3}]) == "x !"
    assert decontamination.cut_words(None, []) is None


def test_a_false_hash_is_no_hit():
    """Two windows with one hash: only the one whose words stand there counts."""
    grams = decontamination.GramSet([(5, 1, "left", ["1"]), (5, 1, "right", ["2"])])
    raw = np.frombuffer(b"left other right", np.uint8)
    words = Segments(raw, np.array([0, len(raw)]), NOT_ALNUM)
    at, w = grams.hits(words, np.full(3, 5, np.uint64))
    assert sorted((p, grams.items[k][0]) for p, k in zip(at.tolist(), w.tolist(), strict=True)) == [(0, "1"), (2, "2")]


def test_leaks_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    for most in (decontamination.MOST_BYTES, -1):
        assert [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontamination.find_leaks(docs, none, most_bytes=most).collect()] == [(1, 4, 0, [])]
    assert decontamination.find_leaks(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        decontamination.decontaminate(docs, none, "words")


# Ranked search.


def best(docs, items, k=10):
    """(item, rank, id, score) for each item's place in the list."""
    all_terms = [terms(t) for _, t in docs]
    n_docs, n_terms = sum(bool(t) for t in all_terms), sum(map(len, all_terms))
    df = Counter(w for t in all_terms for w in set(t))
    out = []
    for q, text in items:
        found = []
        for (doc, _), t in zip(docs, all_terms, strict=True):
            tf, score = Counter(t), 0
            for w in terms(text):
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    m = 25 + 75 * len(t) * n_docs // n_terms
                    score += weight * (1_000_000_000 * tf[w] // (1000 * tf[w] + 8 * m))
            if score > 0:
                found.append((score, doc))
        found.sort(key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
        out += [(q, i + 1, doc, score) for i, (score, doc) in enumerate(found[:k])]
    return out


@pytest.mark.parametrize("options", [{}, {"window": 3}, {"postings": 5, "window": 4, "block": 4}, {"most_terms": 0, "window": 7}, {"most_terms": 0, "postings": 1, "block": 1}])
def test_ranks_by_any_window(spark, options):
    rng = random.Random(11)
    vocabulary = " ".join("".join(rng.choice("abcDé") for _ in range(rng.randint(1, 3))) for _ in range(40))
    docs = [(k if k % 13 else None, prose(rng, rng.choice([0, 1, 4, 30, 90]), vocabulary)) for k in range(120)] + [(500, None), (501, "?!"), (502, "tie tie"), (503, "tie tie"), (503, "tie tie"), (7, "tie tie")]
    items = [(k % 17, prose(rng, rng.choice([1, 2, 9]), vocabulary)) for k in range(20)] + [(None, "tie"), (90, "tie tie tie"), (91, None), (92, "nowhere"), (93, "")]
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, rank string")
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in ranked_search.ranked_search(d, q, k=5, **options).collect()]
    assert Counter(got) == Counter(best(docs, items, 5))


def test_a_long_text_and_many_ties(spark):
    rng = random.Random(3)
    docs = [(1, prose(rng, 60_000))] + [(k, "fox a") for k in range(2, 300)]
    items = [(1, "fox"), (2, "Über 東京")]
    got = ranked_search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=10, window=64)
    assert Counter(map(tuple, got.collect())) == Counter(best(docs, items))


def test_search_in_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert ranked_search.ranked_search(docs, none).collect() == []
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    found = ranked_search.ranked_search(docs.limit(0), asked)
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]
    named = spark.createDataFrame([("b", "x y"), ("a", "x y")], "doc_id string, text string")
    assert [r.doc_id for r in ranked_search.ranked_search(named, spark.createDataFrame([("q", "x")], "item_id string, text string")).orderBy("rank").collect()] == ["a", "b"]


# Spelling variants.


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def variants(docs, least_length=5, least_count=3):
    counts = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    out, form = {}, {}
    for w, n in words.items():
        close = sorted(((-words[x], x) for x in words if near(w, x)))
        form[w] = close[0][1] if close and -close[0][0] >= 2 * n else None
        out[w] = (n, len(close), form[w], words[form[w]] if form[w] else None)
    rows = set()
    for w, r in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, *r, root))
    return rows


@pytest.mark.parametrize("most", [4096, 8, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_variants_against_all_pairs(spark, most, seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(25)]

    def word():
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abÿZ") + w[i:], w[:i] + rng.choice("abz") + w[i + 1:]])
        return w

    docs = [(k if k % 7 else None, " ".join(word() + rng.choice(["", ".", "1", "ł"]) for _ in range(rng.randint(0, 120)))) for k in range(60)] + [(61, None), (62, ""), (63, "×÷ ××××× " * 3)]
    df = spark.createDataFrame([(*r, "key", 1) for r in docs], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.spelling_variants(df, most=most).collect()
    want = variants(docs)
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert sum(r[3] is not None for r in want) > 20 and (seed == 1 or sum(r[5] not in (r[0], r[3]) for r in want) > 0)


def test_no_group_is_larger_than_told(spark):
    words = spark.createDataFrame([("".join(w), 3) for w in {tuple(random.Random(k).choices("abc", k=7)) for k in range(2000)}], "word string, n long")
    held = spelling.group_words(words, 20).groupBy("key").count().agg({"count": "max"}).first()[0]
    assert 1 < held <= 20
    flat = spelling.group_words(words, 1).groupBy("key").count().agg({"count": "max"}).first()[0]
    assert flat <= 4  # a window of one place: three letters, or none


def test_checksums_and_long_runs(spark):
    rng = random.Random(9)
    runs = ["".join(rng.choice("abcxyz") for _ in range(rng.choice([1, 2, 7, 63, 64, 65, 300]))) for _ in range(400)]
    raw = np.frombuffer(" ".join(runs).encode(), np.uint8)
    seg = Segments(raw, np.array([0, len(raw)]), np.arange(256) == 0x20)
    assert spelling.run_checksums(raw, seg, [b"12:"]).tolist() == [zlib.crc32(b"12:" + r.encode()) for r in runs]
    docs = [(k, "x" * 50_000 + " " + "x" * 49_999) for k in range(3)]
    assert {tuple(r) for r in spelling.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == variants(docs)


def test_chains_end_at_their_root(spark):
    chain = ["aaaaa" + "b" * k for k in range(40)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {chain[-1]}


def test_variants_of_empty_tables(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = spelling.spelling_variants(spark.createDataFrame([(1, "house house house")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in one] == [("house", 3, 0, None, None, "house")]


def test_digest_of_no_items_is_that_of_nothing(spark, tmp_path):
    from brightwater.llm.registry import op13_decontamination

    spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, "a b"), (9, "b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op13_decontamination(spark, str(tmp_path)).collect()}
    assert got == {1: (2, 2, hashlib.sha256(b"10,9").hexdigest(), True), 2: (0, 0, hashlib.sha256(b"").hexdigest(), False)}
