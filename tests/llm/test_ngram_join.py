"""The join against brute force: all pairs of sets, compared with plain set arithmetic."""

import random
import re

import pytest

from brightwater.llm import ngram_join as nj

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows, n, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.ngram_join(df, n, percent).collect()}
    assert got == brute(rows, n, percent)


def fixture(seed, families, size, vocab=400):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randrange(vocab)}" for _ in range(rng.choice([1, 2, 4, 9, 12, 20, 60, 150]))]
        for _ in range(rng.randrange(1, size)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                k = rng.randrange(len(words))
                match rng.randrange(3):
                    case 0: words[k] = f"x{rng.randrange(vocab)}"
                    case 1: words.insert(k, "Extra")
                    case _: words = words[:k] + words[k + 1:] or ["one"]
            rows.append((len(rows) + 1, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50)])
def test_against_brute_force(spark, n, percent):
    check(spark, fixture(n, 40, 9), n, percent)


def test_chain_families_are_searched_to_the_end(spark, monkeypatch):
    """Each document is one step from the next; small blocks deal a family over many groups."""
    monkeypatch.setattr(nj, "BLOCK", 4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i + 1, " ".join(words[2 * i:2 * i + 120])) for i in range(60)]
    rows += [(200 + i, " ".join(words[5 * i:5 * i + 100])) for i in range(30)]
    check(spark, rows, 3, 90)
    monkeypatch.setattr(nj, "MOST_BLOCKS", 0)  # every family is split by parts
    check(spark, rows, 5, 80)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE TWO"), (8, "one two three"), (9, "é " * 50), (10, "É " * 50),
            (11, "long " * 200_000), (12, "long " * 200_001)]
    check(spark, rows, 3, 90)
    df = spark.createDataFrame([(None, "a b c", 1), (5, "a b c", 2), (5, "a b c", 3), (7, "A b c", 4)], "doc_id long, text string, component long")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in nj.ngram_join(df).collect())
    assert got == [(-1, 1, None), (5, 1, 5), (5, 1, 5), (7, 1, 5)]
    assert nj.ngram_join(df.limit(0)).collect() == []
    kept = nj.drop_near_copies(df, 3, 90)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {5}  # without an id, a copy still goes


def test_linked_sets_share_a_signature_in_any_order():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 2, 9, 10, 19, 40, 200):
        for percent in (50, 80, 90):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
                extra = n * (100 - percent) // percent
                b = np.unique(np.concatenate([a, rng.integers(0, 2**63, extra, dtype=np.uint64)]))
                counts = rng.integers(0, 5, 1 << 20).astype(np.uint8)
                sizes = np.array([len(a), len(b)])
                sig, doc = nj.signatures(np.concatenate([a, b]), np.repeat([0, 1], sizes), sizes, counts, percent)
                assert set(sig[doc == 0]) & set(sig[doc == 1])


def test_counts_cover_all_documents(spark):
    import numpy as np

    df = spark.createDataFrame([(i, f"a b c d{i % 3}") for i in range(30)], "doc_id long, text string").repartition(5)
    for bits in (20, 23):  # larger sketches hold wider places
        counts = nj.sketch_counts(df, 3, bits)
        assert len(counts) == 1 << bits and sorted(counts[counts > 0].tolist()) == [round(8 * np.log2(1 + n)) for n in (10, 10, 10, 30)]
    assert [nj.counter_bits(n) for n in (0, 10**6, 10**7, 10**11)] == [20, 21, 24, 24]


def test_any_sketch_gives_the_same_components(spark, monkeypatch):
    """With 64 counters the order of n-grams is noise; nothing but work depends on it."""
    rows = fixture(11, 40, 9)
    monkeypatch.setattr(nj, "counter_bits", lambda n: 6)
    check(spark, rows, 3, 90)


def test_linked_sets_agree_in_a_part():
    import numpy as np

    rng = np.random.default_rng(5)
    for n in (1, 2, 9, 10, 19, 40, 200):
        for percent in (50, 80, 90):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
                b = np.unique(np.concatenate([a, rng.integers(0, 2**63, len(a) * (100 - percent) // percent, dtype=np.uint64)]))
                sizes = np.array([len(a), len(b)])
                digest, doc = nj.part_digests(np.concatenate([a, b]), np.repeat([0, 1], sizes), sizes, percent)
                assert set(digest[doc == 0]) & set(digest[doc == 1])


def test_an_id_with_two_texts(spark):
    """One of them is a copy within the task; the links of the other stay."""
    a, b = ([f"{x}{k}" for k in range(40)] for x in "ab")
    rows = [(1, " ".join(a)), (2, " ".join(a)), (2, " ".join(b)), (3, " ".join([*b, "more"])), (4, "other words of no one else at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert {(r.doc_id, r.component_id) for r in nj.ngram_join(df, 5, 80).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_near_copies_go_by_id_and_text(spark):
    """Another text of an id stays; rows without an id are copies like others, and the last choice."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, 0), (2, a + " more", 1), (2, b, 2), (None, b + " more", 3), (None, c, 4), (None, c + " more", 5), (7, "", 6), (7, "", 7), (8, c + " more and more", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, vertex int").repartition(3)
    kept = {r.vertex for r in nj.drop_near_copies(df).collect()}
    assert kept == {0, 2, 6, 7, 8}
    assert nj.drop_near_copies(df.limit(0)).count() == 0
