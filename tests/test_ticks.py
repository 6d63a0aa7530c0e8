"""The stream, fed by several files, against one batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brightwater.streaming import ticks

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
FILES = [
    [(1, at(1), 7, "a", 1.0, '{"k": 1}'), (2, at(5), 7, "a", 5.0, '{"k": 1}'), (3, at(2), 8, "a", 2.0, '{"k": 1}'), (4, at(3), 9, "a", 2.0, "broken")],
    [(5, at(1), 7, "a", 1.0, '{"k": 1}'), (6, at(3), 7, "a", 3.0, '{"k": 1}'), (7, at(2), 8, "b", 9.0, '{"k": 1}'), (8, None, 8, "b", 9.0, '{"k": 1}')],
    [(9, at(9), 8, "a", 9.0, '{"k": 2}')],
]


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")


def ids(df):
    return sorted(r.event_id for r in df.collect())


def quotes(spark, folder):
    return {r.symbol: r.event_id for r in ticks.quotes_of(spark, folder).collect()}


@pytest.mark.parametrize("compact_every", [1, 2, 16])
def test_several_batches(spark, tmp_path, compact_every):
    out = str(tmp_path / "out")
    for rows in FILES:
        ticks.fill(put(spark, tmp_path, rows), out, compact_every=compact_every)
    # A copy in a later batch isn't archived again; a late tick is, and rolls no quote back.
    assert ids(ticks.archive_of(spark, out)) == [1, 2, 3, 6, 7, 9]
    assert quotes(spark, out) == {7: 2, 8: 9}
    ticks.fill(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), out)
    assert ticks.archive_of(spark, out).count() == 6
    assert ticks.read_marker(spark, out).batch == 2


def test_a_batch_that_fails_shows_nothing_and_everything_once_after_its_rerun(spark, tmp_path):
    out, topics = str(tmp_path / "out"), spark.createDataFrame([(7, "X")], "symbol long, topic string")
    published = lambda: sorted((r.topic, r.key, r.body[:25]) for r in ticks.outbox_of(spark, out).collect())
    ticks.fill(put(spark, tmp_path, FILES[0]), out, topics=topics)
    first, seen = published(), ids(ticks.archive_of(spark, out))
    assert [t for t, *_ in first] == ["ticks.UNKNOWN", "ticks.X", "ticks.X"] and quotes(spark, out) == {7: 2, 8: 3}

    def fail(number):
        raise RuntimeError("stopped before the marker")

    with pytest.raises(Exception, match="stopped before the marker"):
        ticks.fill(put(spark, tmp_path, [*FILES[1], *FILES[2]]), out, topics=topics, before_commit=fail)
    # Everything of the batch is written, and nothing of it shows.
    assert spark.read.parquet(f"{out}/outbox/batch=1").count() == 3 and spark.read.parquet(f"{out}/deltas/batch=1").count() == 1
    assert published() == first and ids(ticks.archive_of(spark, out)) == seen and quotes(spark, out) == {7: 2, 8: 3}
    again = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    for _ in range(2):
        ticks.fill(again, out, topics=topics)
        assert len(published()) == 6 and len(set(published())) == 6
        assert ids(ticks.archive_of(spark, out)) == [1, 2, 3, 6, 7, 9] and quotes(spark, out) == {7: 2, 8: 9}


def test_quotes_of_every_second_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    want = [{}, {7: 2, 8: 7}, {7: 2, 8: 7}]
    for rows, held in zip(FILES, want, strict=True):
        ticks.fill(put(spark, tmp_path, rows), out, quotes_every=2)
        assert quotes(spark, out) == held
    ticks.fill(put(spark, tmp_path, [(10, at(1), 5, "a", 1.0, '{"k": 1}')]), out, quotes_every=2)
    assert quotes(spark, out) == {7: 2, 8: 9, 5: 10}


def test_ticks_that_are_not_kept_are_quoted(spark, tmp_path):
    out = str(tmp_path / "out")
    for rows in FILES:
        ticks.fill(put(spark, tmp_path, rows), out, archive_all=False, known=spark.createDataFrame([(8,)], "symbol long"))
    assert quotes(spark, out) == {8: 9} and not (tmp_path / "out/archive").exists()


def test_a_late_tick_reads_its_own_day_and_writes_its_own_symbol(spark, tmp_path):
    out = str(tmp_path / "out")
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    ticks.fill(put(spark, tmp_path, [(n, day(n), n % 9, "a", float(n), '{"k": 1}') for n in range(40)]), out)
    files = ticks.archive_of(spark, out).filter(F.col("day").isin([dt.date(2024, 1, 2), dt.date(2024, 2, 5)]))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and files.select(F.input_file_name().alias("f")).distinct().count() == 2
    late = [(100, day(1), 4, "late", 1.0, '{"k": 1}'), (101, day(35), 4, "now", 1.0, '{"k": 1}'), (102, day(1), 1, "a", 1.0, '{"k": 1}')]
    ticks.fill(put(spark, tmp_path, late), out)
    assert sorted(set(ids(ticks.archive_of(spark, out))) - set(range(40))) == [100, 101]
    assert [(r.symbol, r.event_id) for r in spark.read.parquet(f"{out}/deltas/batch=1").collect()] == [(4, 101)]


def test_counters_are_what_the_stream_saw(spark, tmp_path):
    out = str(tmp_path / "out")
    for rows in FILES[:2]:
        put(spark, tmp_path, rows)
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with ticks.Counters(spark, f"{out}/counters"):
        ticks.fill(raw, out)
    put(spark, tmp_path, FILES[2])
    with ticks.Counters(spark, f"{out}/counters"):
        ticks.fill(raw, out)
    got = sorted(tuple(r)[1:] for r in ticks.counters_of(spark, f"{out}/counters").select("query", "batch", "received", "rejected", "without_key").collect())
    assert got == [(0, 4, 1, 0), (1, 4, 1, 1), (2, 1, 0, 0)]


def test_a_table_of_part_files_streams_too(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, 0, 0, i % 50), i % 5, "a", float(i), '{"k": 1}') for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(str(tmp_path / "t/events.parquet"))
    out = ticks.fill(ticks.replayed(spark, str(tmp_path / "t"), str(tmp_path)), str(tmp_path / "out"))
    got = ticks.archive_of(spark, out)
    assert got.count() == 40 and got.select("batch").distinct().count() == 4
    newest = {}
    for i, when, k, *_ in rows:
        newest[k] = max(newest.get(k, (when, i)), (when, i))
    assert quotes(spark, out) == {k: i for k, (_, i) in newest.items()}


@pytest.mark.parametrize("rows_a_file", [1, 10, 1000])
def test_batches_hold_their_own_span_however_few_rows_that_has(spark, tmp_path, rows_a_file):
    """A part without rows, one with a single one, and null, dealt over several files a batch."""
    numbers = [None, *range(60), 150, *range(300, 400)]
    spark.createDataFrame([(i, at(1), 1, "a", 1.0, '{"k": 1}') for i in numbers], SCHEMA).repartition(3).write.parquet(str(tmp_path / "t/events.parquet"))
    seen = {}
    stream = ticks.replayed(spark, str(tmp_path / "t"), str(tmp_path), rows_a_file=rows_a_file)
    run = stream.writeStream.foreachBatch(lambda df, n: seen.update({n: sorted(r.event_id if r.event_id is not None else -1 for r in df.collect())}))
    run.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert seen == {0: [-1, *range(60)], 1: [150], 2: [], 3: list(range(300, 400))}


def test_a_batch_is_as_many_tasks_work_as_it_needs(spark, tmp_path):
    spark.range(1_200_000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' AS ts", "id % 7 AS user_id", "'a' AS event_type", "1D AS value", "'' AS props").write.parquet(str(tmp_path / "t/events.parquet"))
    ticks.replayed(spark, str(tmp_path / "t"), str(tmp_path))
    sizes = [r[0] for r in spark.read.parquet(str(tmp_path / "events")).groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(sizes) == 8 and sum(sizes) == 1_200_000 and max(sizes) <= 250_000
