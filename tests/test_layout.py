"""What merges read and write where the target is laid out for them."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from brightwater.operators import layout
from brightwater.operators.merge import WriteSpec

SCHEMA = "day date, k long, v string"
day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def stamps(path):
    return {f"{f.parent.name}/{f.name}": (f.parent.name, f.stat().st_mtime_ns) for f in path.rglob("*.parquet")}


@pytest.fixture
def target(spark, tmp_path):
    rows = spark.createDataFrame([(day(n), n * 10 + k, "old") for n in range(20) for k in range(5)], SCHEMA)
    layout.write_days(rows, str(tmp_path / "t"), "day")
    return tmp_path / "t", rows.schema


def test_a_merge_touches_its_own_days(spark, target):
    path, schema = target
    before = stamps(path)
    assert len(before) == 20
    incoming = spark.createDataFrame([(day(3), 31, "new"), (day(3), 39, "new"), (day(30), 300, "new"), (None, 1, "lost")], SCHEMA)
    spec = WriteSpec("t", ["day", "k"])
    assert sorted(layout.merge_days(str(path), schema, incoming, spec, "day")) == [day(3), day(30)]
    after = stamps(path)
    gone, new = set(before) - set(after), set(after) - set(before)
    assert {before[f][0] for f in gone} == {"day=2024-01-04"} and {after[f][0] for f in new} == {"day=2024-01-04", "day=2024-01-31"}
    assert all(before[f] == after[f] for f in set(before) & set(after))
    got = {(r.day, r.k): r.v for r in spark.read.schema(schema).parquet(str(path)).collect()}
    assert len(got) == 102 and got[day(3), 31] == got[day(3), 39] == got[day(30), 300] == "new" and got[day(3), 30] == got[day(4), 41] == "old"
    layout.merge_days(str(path), schema, incoming, spec, "day")
    assert {(r.day, r.k): r.v for r in spark.read.schema(schema).parquet(str(path)).collect()} == got
    assert layout.merge_days(str(path), schema, incoming.limit(0), spec, "day") == []
    with pytest.raises(ValueError):
        layout.merge_days(str(path), schema, incoming, WriteSpec("t", ["k"]), "day")


def test_verification_reads_the_days_that_were_written(spark, target):
    path, schema = target
    tried = spark.createDataFrame([(day(2), 20, "x"), (day(2), 29, "x"), (day(7), 70, "x"), (day(90), 1, "x")], SCHEMA)
    assert tuple(layout.verified_days(str(path), schema, tried, ["day", "k"], "day").first()) == (4, 2)
    read = layout.read_days(spark, str(path), schema, layout.days_of(tried, "day"), "day")
    assert read.select(F.input_file_name()).distinct().count() == 2
    assert "numFiles" not in read._jdf.queryExecution().executedPlan().toString() and "PartitionFilters: [isnotnull" in read._jdf.queryExecution().executedPlan().toString() or "PartitionFilters: [day" in read._jdf.queryExecution().executedPlan().toString()


def test_old_days_go_by_folder(spark, target):
    path, schema = target
    layout.write_days(spark.createDataFrame([(None, 7, "no day")], SCHEMA), str(path), "day")
    assert layout.drop_days(spark, str(path), "2024-01-06", "day") == [str(day(n)) for n in range(5)]
    left = spark.read.schema(schema).parquet(str(path))
    assert left.count() == 76 and left.agg(F.min("day")).first()[0] == day(5)
    assert layout.drop_days(spark, str(path), "2024-01-06", "day") == []


def test_a_target_in_buckets_is_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name = f"t_{uuid.uuid4().hex[:8]}"
        old = spark.createDataFrame([(k, f"old{k}", k) for k in range(500)], "k long, v string, w long")
        target = layout.write_buckets(old, f"{name}_1", str(tmp_path / "1"), ["k"], 8)
        incoming = spark.createDataFrame([(k, f"new{k}", k) for k in range(450, 550)], "k long, v string, w long").repartition(3)
        from brightwater.operators.merge import merge

        plan = merge(target, incoming, WriteSpec("t", ["k"]))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
        bucketed = layout.write_buckets(incoming, f"{name}_i", str(tmp_path / "i"), ["k"], 8)
        assert "Exchange" not in merge(target, bucketed, WriteSpec("t", ["k"]))._jdf.queryExecution().executedPlan().toString()
        new = layout.merge_buckets(target, incoming, WriteSpec("t", ["k"]), f"{name}_2", str(tmp_path / "2"), 8)
        assert {r.k: r.v for r in new.collect()} == {k: f"{'new' if k >= 450 else 'old'}{k}" for k in range(550)}
        assert len(list((tmp_path / "2").glob("*.parquet"))) == 8
        again = layout.merge_buckets(new, incoming, WriteSpec("t", ["k"]), f"{name}_3", str(tmp_path / "3"), 8)
        assert again.count() == 550
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
