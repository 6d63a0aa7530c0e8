"""Merges, pages, gates and series on small tables."""

import datetime as dt
import random
from decimal import Decimal as D

import duckdb
import pytest
from pyspark.sql import functions as F

from brightwater.functions import scalars as S
from brightwater.operators import gates, keyset, merge, series


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", None)], "k int, v string, g int")


def test_upsert_twice_is_upsert_once(spark, stored):
    new = spark.createDataFrame([(2, "B", 6), (4, "d", 1)], "k int, v string, g int")
    spec = merge.WriteSpec("t", ["k"])
    once = merge.merge(stored, new, spec)
    assert rows(once) == rows(merge.merge(once, new, spec)) == [(1, "a", 5), (2, "B", 6), (3, "c", None), (4, "d", 1)]
    assert {r._op for r in merge.classified(once, new, spec).collect()} == {"kept", "same"}


def test_guard_never_rolls_back(spark, stored):
    new = spark.createDataFrame([(1, "old", 4), (2, "equal", 5), (3, "first", 1), (9, "new", None)], "k int, v string, g int")
    got = merge.merge(stored, new, merge.WriteSpec("t", ["k"], guard="g"))
    assert rows(got) == [(1, "a", 5), (2, "b", 5), (3, "c", None), (9, "new", None)]


def test_scope_goes_even_if_nothing_comes(spark, stored):
    scope = spark.createDataFrame([("a",)], "v string")
    assert rows(merge.replace_scope(stored, stored.limit(0), scope)) == [(2, "b", 5), (3, "c", None)]
    ops = {r.k: r._op for r in merge.classified(stored, stored.limit(0), merge.WriteSpec("t", ["k"]), scope).collect()}
    assert ops == {1: "delete", 2: "kept", 3: "kept"}


def test_last_wins_and_monotonic(spark):
    df = spark.createDataFrame([(1, 1, "x", 9), (1, 2, None, 3), (2, 1, "y", None)], "k int, seq int, v string, m int")
    assert rows(merge.last_wins(df, ["k"], ["seq"], monotonic=["m"]).select("k", "v", "m")) == [(1, None, 9), (2, "y", None)]
    assert merge.last_wins(df.limit(0), ["k"], ["seq"]).count() == 0


def folded(keys, guard, present, given):
    """What the rows of a key come to, laid over each other one by one."""
    held = {}
    for row in given:
        now = held.get(row["k"])
        if now is None:
            held[row["k"]] = dict(row)
        elif guard:
            if not (now["g"] is not None and row["g"] is not None and row["g"] < now["g"]):
                held[row["k"]] = dict(row)
        else:
            new = {**now, **{c: v for c, v in row.items() if c not in present or row["seq"] % 3}}
            new["m"] = max((x for x in (now["m"], row["m"]) if x is not None), default=None)
            held[row["k"]] = new
    return sorted((tuple(r.values()) for r in held.values()), key=str)


def test_last_wins_as_if_laid_over_one_by_one(spark):
    rng = random.Random(5)
    given = [{"k": rng.randrange(12), "seq": i, "g": rng.choice([None, 1, 2, 3]), "v": rng.choice([None, "x", "y"]), "m": rng.choice([None, 1, 2, 9])} for i in range(150)]
    df = spark.createDataFrame([tuple(r.values()) for r in given], "k int, seq int, g int, v string, m int").repartition(4)
    assert rows(merge.last_wins(df, ["k"], ["seq"], guard="g")) == folded(["k"], "g", set(), given)
    got = {r.k: (r.v, r.m) for r in merge.last_wins(df.filter("seq % 3 > 0"), ["k"], ["seq"], monotonic=["m"], present={"v": F.col("seq") % 3 > 0}).collect()}
    assert got == {r[0]: (r[3], r[4]) for r in folded(["k"], None, {"v"}, [r for r in given if r["seq"] % 3])}


def test_rescale_is_decimal_and_rounds_volume_after_each_split(spark):
    at = lambda day: dt.datetime(2024, 1, day)
    bars = spark.createDataFrame([("s", at(1), "5m", D("100"), 101), ("s", at(5), "5m", D("100"), 101), ("s", at(9), "5m", D("100"), 101), ("s", at(1), "1d", D("100"), 101), ("t", at(1), "5m", D("7"), 3)],
                                 "k string, at timestamp_ntz, i string, price decimal(28,12), volume long")
    splits = spark.createDataFrame([("s", at(3), D("1.5")), ("s", at(7), D("1.5")), ("s", at(8), D("0")), ("s", at(2), D("-1"))], "k string, boundary timestamp_ntz, ratio decimal(20,10)")
    got = {(r.k, r.at.day, r.i): (str(r.price), r.volume) for r in series.rescaled(bars, splits, "k", ["price"], "volume", "at", "i").collect()}
    assert got == {("s", 1, "5m"): ("44.444444444445", 226), ("s", 5, "5m"): ("66.666666666667", 151), ("s", 9, "5m"): ("100.000000000000", 101),
                   ("s", 1, "1d"): ("100.000000000000", 101), ("t", 1, "5m"): ("7.000000000000", 3)}


def test_range_event(spark):
    df = spark.createDataFrame([("a", i, "insert") for i in range(5)] + [("b", 1, "insert"), ("b", 2, "same")], "s string, i int, _op string")
    got = merge.change_events(df, merge.WriteSpec("t", ["s", "i"]), span=3, range_col="i").collect()
    assert sorted((r.op, r.row) for r in got) == [("insert", '{"s":"b","i":1}'), ("range", '{"first":0,"last":4,"n":5}')]


def test_pages_walk_the_whole_table(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(23)], "a int, b int")
    keys, seen, values = [("a", True), ("b", False)], [], None
    while True:
        got = keyset.page(df, keys, 5, values).collect()
        seen += [tuple(r) for r in got[:5]]
        if len(got) <= 5:
            break
        values = keyset.decode({"t": 1}, keyset.encode({"t": 1}, list(got[4])))
    assert seen == sorted(((i % 4, i) for i in range(23)), key=lambda r: (-r[0], r[1]))
    with pytest.raises(ValueError, match="another query"):
        keyset.decode({"t": 2}, keyset.encode({"t": 1}, [1]))
    with pytest.raises(ValueError):
        keyset.decode({}, "nonsense")
    day = dt.date(2024, 1, 2)
    assert keyset.decode({}, keyset.encode({}, [day, "x"])) == [day, "x"]


def test_a_page_from_far_behind_sorts_its_own_ranges_alone(spark):
    df = spark.createDataFrame([(i * 7919 % 1009 % 10 if i % 13 else None, i) for i in range(1009)], "a int, b int").repartition(5)
    want = [tuple(r) for r in df.orderBy("a", "b").collect()]
    for offset, size in ((0, 5), (-3, 2), (500, 40), (1000, 40), (1009, 3), (0, 1009), (750, 0)):
        got = keyset.page_at(df, ["a", "b"], offset, size)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want[max(0, offset):max(0, offset) + size], key=str)
    assert "TakeOrdered" not in keyset.page_at(df, ["a", "b"], 500, 40)._jdf.queryExecution().executedPlan().toString()


def test_typed_sort_keeps_no_rows_before_its_page(spark):
    from brightwater.plans.relations import typed_sort

    assert "TakeOrdered" not in typed_sort(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_gates(spark):
    a = gates.row_hash(spark.createDataFrame([(1, "x", 1), (2, "y", 1), (3, None, 1)], "k int, v string, at int"), ["at"])
    b = gates.row_hash(spark.createDataFrame([(1, "x", 2), (2, "z", 2), (4, "n", 2)], "k int, v string, at int"), ["at"])
    assert {r.k: r.gate for r in gates.gate(b, a, ["k"]).collect()} == {1: "unchanged", 2: "changed", 4: "new"}
    assert {r.gate for r in gates.gate(a, a, ["k"], full_refresh=True).collect()} == {"changed"}


def test_group_hash_ignores_order(spark):
    df = spark.createDataFrame([(1, i) for i in range(20)], "k int, v int")
    assert rows(gates.group_hash(df, ["k"])) == rows(gates.group_hash(df.orderBy(F.desc("v")).repartition(5), ["k"]))


def test_group_hash_sees_each_row_and_keeps_no_lists(spark):
    sets = [[1, 2], [2, 1], [1, 1, 2], [1, 2, 2], [1, 2, None], [1], [2], [], [None], [None, None]]
    df = spark.createDataFrame([(k, v) for k, vs in enumerate(sets) for v in vs], "k int, v int")
    got = gates.group_hash(df.withColumn("k", F.lit(0)), ["k"])
    assert "collect_list" not in got._jdf.queryExecution().toString().lower()
    by = {k: gates.group_hash(df.filter(f"k = {k}").withColumn("k", F.lit(0)), ["k"]).collect() for k in range(len(sets))}
    assert by[0] == by[1] and by[7] == [] and len({r[0].content_hash for r in by.values() if r}) == len(sets) - 2


def test_ranges_and_slices(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("a", 5, 7), ("a", 9, 10)], "s string, x int, y int")
    assert rows(series.merged_ranges(df, ["s"], "x", "y")) == [("a", 1, 7), ("a", 9, 10)]
    day = dt.date
    r = spark.createDataFrame([(day(2024, 1, 1), day(2024, 1, 10)), (day(2024, 2, 1), day(2024, 2, 1))], "a date, b date")
    assert [(x.window_start, x.window_end) for x in series.sliced(r, "a", "b", 7).collect()] == [(day(2024, 1, 1), day(2024, 1, 8)), (day(2024, 1, 8), day(2024, 1, 10))]


def test_gaps_are_between_whole_seconds_rounded_as_in_sql(spark):
    """Fractions round to the nearest second, halves to the even one, before they are compared."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=s)
    ends = [(1_971_795, 12_483_950), (1_400_000, 11_600_000), (500_000, 11_500_000), (1_500_000, 12_500_000), (1_500_000, 13_500_000), (0, 10_500_000), (0, 10_500_001)]
    df = spark.createDataFrame([(k, at(x)) for k, pair in enumerate(ends) for x in pair], "k int, at timestamp_ntz")
    con = duckdb.connect()
    want = [k for k, (a, b) in enumerate(ends) if con.execute("SELECT epoch(?::TIMESTAMP)::BIGINT - epoch(?::TIMESTAMP)::BIGINT > 10", [at(b), at(a)]).fetchone()[0]]
    assert sorted(r.k for r in series.gaps(df, ["k"], "at", 10).collect()) == want == [1, 2, 4, 6]


def test_as_of_forward_drops_both_ends(spark):
    a = spark.createDataFrame([("s", 1), ("s", 5), ("s", 6), ("s", 99), ("t", 1)], "k string, at int")
    c = spark.createDataFrame([("s", 5, 50.0), ("s", 8, 80.0)], "k string, at int, v double")
    assert rows(series.as_of_forward(a, c, ["k"], "at", "v")) == [("s", 5, 5, 50.0), ("s", 6, 8, 80.0)]


def test_tail_fold(spark):
    df = spark.createDataFrame([(x, i) for i, x in enumerate("abcde")], "n string, v int")
    assert rows(series.tail_folded(df, "n", "v", 3)) == [("Other (3)", 3), ("d", 3), ("e", 4)]
    assert rows(series.tail_folded(df.limit(2), "n", "v", 3)) == [("a", 0), ("b", 1)]


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = F.lit
    assert [one(S.to_text(lit(x))) for x in (" a ", "N/A", "", "None")] == ["a", None, None, None]
    assert [one(S.to_long(lit(x))) for x in ("12", " -3 ", "1.5", "x", "-", "9" * 30)] == [12, -3, None, None, None, None]
    assert [one(S.whole(lit(x))) for x in (2.9, -2.9, float("nan"), float("inf"))] == [2, -2, None, None]
    assert [one(S.to_flag(lit(x))) for x in ("Yes", "0", "maybe")] == [True, False, None]
    assert str(one(S.float_price(lit(232.35).cast("float")))) == "232.350000000000"
    assert [str(one(S.to_big(lit(x)))) for x in ("2.5", "3.5")] == ["2", "4"]
    assert one(S.key_text(lit("abc"), 2)) is None
    assert [one(S.trim_decimal(lit(x).cast("decimal(10,4)"))) for x in ("1.5000", "100.0000")] == ["1.5", "100"]
    assert one(S.topic("ticks.", lit("n y/s"))) == "ticks.N_Y_S" and one(S.topic("t.", lit(None).cast("string"))) == "t.unknown"
    assert one(S.split_ratio(lit(4), lit(0))) is None and one(S.split_ratio(lit(4), lit(2))) == 2.0
    assert one(S.linear(lit(1.0), lit(1.0), lit(1.0), 0, 10)) == 5.0
