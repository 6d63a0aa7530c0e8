"""Rules of order and time against plain Python: ranges of hot keys, samplers, candle folds, fetch windows, canonical JSON."""

import datetime as dt
import json
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from brightwater.functions.canonical import canonical_row, canonical_text
from brightwater.operators import gates, sampling, series
from brightwater.operators.fetch_plan import LIMITS, plan_fetches
from brightwater.operators.ranges import cut, running
from brightwater.streaming.candles import bars_of, fold

START = dt.datetime(2024, 1, 1)
sec = lambda s: START + dt.timedelta(seconds=s)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def hot(spark):
    """A key of 3,000 rows beside small ones, a null key, ties and null values."""
    rng = random.Random(1)
    rows = [("hot", sec(rng.randrange(40_000)), rng.choice([None, 1.0, 2.5, 7.0])) for _ in range(3000)] + [(rng.choice(["a", "b", None]), sec(rng.randrange(9_000)), float(k)) for k in range(60)]
    rows = [(k, at, v, i) for i, (k, at, v) in enumerate(rows)]
    return spark.createDataFrame(rows, "k string, at timestamp_ntz, v double, id long").repartition(5).cache()


def test_no_task_takes_more_than_a_range(hot):
    parts = cut(hot, ["k"], ["at", "id"], 100)
    assert parts.groupBy("k", "_range").count().agg(F.max("count")).first()[0] <= 100
    assert "_range" not in cut(hot, ["k"], ["at", "id"], 3000).columns


@pytest.mark.parametrize("backward", [False, True])
def test_what_ranges_hand_on(hot, backward):
    values = {"m": ("max", F.col("v")), "s": ("sum", F.col("v")), "l": ("last", F.col("v")), "f": ("first", F.col("v"))}
    one, many = (running(cut(hot, ["k"], ["at", "id"], most), ["k"], ["at", "id"], backward, **values).select("id", F.coalesce("s", F.lit(0.0)).alias("s"), "m", "l", "f") for most in (None, 100))
    assert rows_of(one) == rows_of(many)
    held = defaultdict(list)
    for r in sorted(hot.collect(), key=lambda r: (r.at, r.id), reverse=backward):
        held[r.k].append(r)
    want = []
    for rows in held.values():
        seen = []
        for r in rows:
            want.append((r.id, float(sum(seen)), max(seen, default=None), seen[-1] if seen else None, seen[0] if seen else None))
            seen += [r.v] if r.v is not None else []
    assert sorted(map(repr, want)) == sorted(repr((r.id, r.s, r.m, r.l, r.f)) for r in one.collect())


def test_series_are_the_same_in_ranges(spark, hot):
    daily = hot.groupBy("k", "at").agg(F.max("v").alias("v"))
    actions, candles = hot.filter("id % 3 = 0"), hot.filter("id % 2 = 0 AND v IS NOT NULL").groupBy("k", "at").agg(F.max("v").alias("v"))
    spans = hot.select("k", "at", F.expr("at + make_dt_interval(0, 0, 0, id % 40)").alias("until"), "id")
    for of in (lambda m: series.changes(daily, ["k"], "at", "v", most=m), lambda m: series.index_to_100(daily, ["k"], "at", "v", most=m), lambda m: series.gaps(daily, ["k"], "at", 60, most=m),
               lambda m: series.as_of_forward(actions, candles, ["k"], "at", "v", most=m), lambda m: series.merged_ranges(spans, ["k"], "at", "until", most=m)):
        one = rows_of(of(None))
        assert one and one == rows_of(of(100))


def starts(instants, seconds):
    out = []
    for at in sorted(instants):
        if not out or (at - out[-1]).total_seconds() > seconds:
            out.append(at)
    return out


@pytest.mark.parametrize("most", [None, 100])
def test_windows_begin_with_a_reject(hot, most):
    by = defaultdict(list)
    for r in hot.collect():
        by[r.k].append(r)
    want = [(k, s) for k, rows in by.items() for s in starts([r.at for r in rows], 600)]
    assert sorted(map(repr, want)) == rows_of(sampling.window_starts(hot, ["k"], "at", 600, most))
    kept = []
    for k, rows in by.items():
        begun = starts([r.at for r in rows], 600)
        count = defaultdict(int)
        for r in sorted(rows, key=lambda r: (r.at, r.id)):
            s = max(x for x in begun if x <= r.at)
            count[s] += 1
            if count[s] <= 3:
                kept.append((k, r.id, s, count[s]))
    got = sampling.sampled(hot, ["k"], "at", ["id"], 3, 600, most).select("k", "id", "window_start", "seen")
    assert sorted(map(repr, kept)) == rows_of(got)


def test_a_window_ends_after_the_hour_not_with_it(spark):
    rows = [(1, sec(1800), 1), (1, sec(5400), 2), (1, sec(5401), 3), (1, None, 4), (1, sec(9002), 5), (1, sec(9001), 6)]
    df = spark.createDataFrame(rows, "k long, at timestamp_ntz, id long")
    got = sampling.sampled(df, ["k"], "at", ["id"], 9).collect()
    assert {r.id: (r.window_start, r.seen) for r in got} == {1: (sec(1800), 1), 2: (sec(1800), 2), 3: (sec(5401), 1), 6: (sec(5401), 2), 5: (sec(9002), 1)}


def test_a_stream_samples_as_a_batch_does(spark, tmp_path):
    rng = random.Random(4)
    rows = sorted((sec(rng.randrange(60_000)), i, rng.choice("ab")) for i in range(400))
    schema = "at timestamp_ntz, id long, k string"
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    for i in range(0, 400, 150):
        spark.createDataFrame(rows[i:i + 150], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        raw = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = sampling.sampled_stream(raw, ["k"], "at", ["id"], 2)
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    columns = ["k", "id", "window_start", "seen"]
    assert rows_of(spark.read.schema(out.schema).parquet(str(tmp_path / "out")).select(*columns)) == rows_of(sampling.sampled(spark.createDataFrame(rows, schema), ["k"], "at", ["id"], 2).select(*columns))


def candle_fold(ticks, seconds, last=None):
    """ticks in the order they come: (instant, price). Bars by their start."""
    bars = {}
    if last:
        bars[last[0]] = list(last[1:])
    now = last[0] if last else None
    for at, price in ticks:
        if price is None or at is None:
            continue
        bucket = START + dt.timedelta(seconds=math.floor((at - START).total_seconds() / seconds) * seconds)
        if now is None or bucket > now:
            now, bars[bucket] = bucket, [price] * 4
        elif bucket == now:
            b = bars[bucket]
            bars[bucket] = [b[0], max(b[1], price), min(b[2], price), price]
    return bars


def test_candles_fold_in_the_order_of_arrival(spark, tmp_path):
    rng = random.Random(7)
    ticks = defaultdict(list)
    for i in range(1500):
        late = rng.choice([0, 0, 0, 4000, 90])
        ticks[rng.choice(["hot", "hot", "hot", "b"])].append((i, sec(i * 20 - late) if i % 31 else None, rng.choice([None, 1.0, 5.0, 2.0, 9.0])))
    last = {"hot": (sec(3600), 3.0, 30.0, 0.5, 4.0), "none": (sec(0), 1.0, 1.0, 1.0, 1.0)}
    rows = [(k, *t) for k, ts in ticks.items() for t in ts]
    schema = "k string, id long, at timestamp_ntz, p double"
    df = spark.createDataFrame(rows, schema).repartition(3)
    seeds = spark.createDataFrame([(k, *v) for k, v in last.items()], "k string, bar_ts timestamp_ntz, open double, high double, low double, close double")
    for seed, held in ((None, {}), (seeds, last)):
        want = sorted(repr((k, at, *legs)) for k in {*ticks, *held} for at, legs in candle_fold([t[1:] for t in ticks[k]], 3600, held.get(k)).items())
        for most in (None, 100):
            assert rows_of(series.folded_candles(df, ["k"], "at", "p", "id", 3600, seed, most)) == want
    want = sorted(repr((k, at, *legs)) for k in ticks for at, legs in candle_fold([t[1:] for t in ticks[k]], 3600).items())
    for a in range(0, 1500, 400):
        spark.createDataFrame([r for r in rows if a <= r[1] < a + 400], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        fold(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), "k", "at", "p", "id", 3600)
    assert rows_of(bars_of(spark, str(tmp_path / "out"), "k").select("k", "bar_ts", "open", "high", "low", "close")) == want


def test_a_stream_of_bars_goes_on_from_versions_and_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """Many symbols in seven batches, a null one among them, with a version of last bars every second batch or every third."""
    schema = "k long, id long, at timestamp_ntz, p double"
    rows = spark.range(21_000).selectExpr("nullif(id * 37 % 1501, 0) AS k", "id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 3 - if(id % 11 = 0, 9000, 0)) AS at", "cast(id * 7 % 97 AS double) AS p")
    want = rows_of(series.folded_candles(rows, ["k"], "at", "p", "id", 3600))
    for a in range(0, 21_000, 3000):
        rows.filter(f"id >= {a} AND id < {a + 3000}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for every in (2, 3, 16):
        out = tmp_path / f"out{every}"
        fold(raw, str(out), "k", "at", "p", "id", 3600, every)
        assert rows_of(bars_of(spark, str(out), "k").select("k", "bar_ts", "open", "high", "low", "close")) == want
        assert len(list(out.glob("bars/batch=*"))) == 7 and len(list(out.glob("last/version=*"))) == 7 // every
        for done in (out / "checkpoint/commits").glob("*6*"):
            done.unlink()  # the last batch ends before it is noted as done
        fold(raw, str(out), "k", "at", "p", "id", 3600, every)
        assert rows_of(bars_of(spark, str(out), "k").select("k", "bar_ts", "open", "high", "low", "close")) == want


def test_a_session_is_only_extended(spark):
    last = spark.createDataFrame([("a", sec(50_000), 5.0, 6.0, 4.0, 5.5), ("b", sec(50_000), 5.0, 6.0, 4.0, 5.5)], "k string, bar_ts timestamp_ntz, open double, high double, low double, close double")
    ticks = spark.createDataFrame([("a", 1, sec(10), 9.0), ("a", 2, sec(86_399), 4.5), ("a", 3, sec(86_400), 99.0), ("a", 4, sec(5), None), ("c", 5, sec(50_000), 1.0)], "k string, id long, at timestamp_ntz, p double")
    got = {r.k: tuple(r)[1:] for r in series.extended_sessions(ticks, ["k"], "at", "p", "id", last).collect()}
    assert got == {"a": (sec(50_000), 5.0, 9.0, 4.0, 4.5), "b": (sec(50_000), 5.0, 6.0, 4.0, 5.5)}


def planned(interval, watermark, today, start, end, gaps):
    """The plan of one row: windows, what is lost, and whether all is asked for."""
    per, depth = LIMITS[interval]
    earliest = today - dt.timedelta(depth) if depth is not None else None
    lost, ranges = None, []
    if start or end:
        ranges = [(start or today - dt.timedelta(2), end or today)]
    elif watermark is None:
        if earliest is None:
            return [], None, True
        ranges = [(earliest, today)]
    else:
        a = watermark.date() - dt.timedelta(2)
        if earliest and a < earliest:
            lost, a = (watermark, dt.datetime.combine(earliest, dt.time())), earliest
        ranges = [(a, today)] + [(x.date(), min(y.date() + dt.timedelta(1), today)) for x, y in gaps if not earliest or x.date() >= earliest]
    merged = []
    for a, b in sorted(r for r in ranges if r[0] < r[1]):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    out = []
    for a, b in merged:
        while a < b:
            c = min(b, a + dt.timedelta(per)) if per else b
            out.append((a, c))
            a = c
    return out, lost, False


@pytest.mark.parametrize("most", [None, 5])
def test_fetch_windows(spark, most):
    rng = random.Random(2)
    scopes, gaps, want = [], [], []
    for s in range(60):
        for interval in LIMITS:
            today = dt.date(2024, 3, 1) + dt.timedelta(rng.randrange(60))
            watermark = rng.choice([None, sec(rng.randrange(86_400 * 90))])
            start, end = (rng.choice([None, None, None, dt.date(2024, 2, 1)]), rng.choice([None, None, None, dt.date(2024, 3, 9)]))
            mine = [(x := sec(rng.randrange(86_400 * 80)), x + dt.timedelta(hours=rng.randrange(90))) for _ in range(rng.choice([0, 0, 3]))]
            scopes.append((s, interval, watermark, today, start, end))
            gaps += [(s, interval, *g) for g in mine]
            windows, lost, whole = planned(interval, watermark, today, start, end, mine)
            at = lambda day: dt.datetime.combine(day, dt.time())
            want += [(s, interval, "window", at(a), at(b)) for a, b in windows] + [(s, interval, "expired", *(lost or ()))] * bool(lost) + [(s, interval, "all", None, None)] * whole
    got = plan_fetches(spark.createDataFrame([*scopes, (None, "1m", None, dt.date(2024, 3, 1), None, None)], "symbol long, bar_interval string, watermark timestamp_ntz, today date, from_day date, to_day date"),
                       spark.createDataFrame(gaps, "symbol long, bar_interval string, gap_start timestamp_ntz, gap_end timestamp_ntz"), most=most)
    assert rows_of(got) == sorted(map(repr, want))
    assert {r[2] for r in want} == {"window", "expired", "all"}


def test_an_unknown_interval_is_refused(spark):
    one = spark.createDataFrame([(1, "2m", None, dt.date(2024, 3, 1), None, None)], "symbol long, bar_interval string, watermark timestamp_ntz, today date, from_day date, to_day date")
    with pytest.raises(Exception, match="unknown interval: 2m"):
        plan_fetches(one, spark.createDataFrame([], "symbol long, bar_interval string, gap_start timestamp_ntz, gap_end timestamp_ntz")).collect()


BODIES = ['{"b": 1, "a": {"z": 1e-7, "y": [1.0, 12345678.0, 1e22, 0.1, -0.0]}}', '{"k": NaN, "l": [Infinity, -Infinity, 1e999]}', '{"é": "\\u0001\\u007f\\"\\\\/\\n", "E": "東京\\ud83d\\ude00"}',
          '{"a": 1, "a": 2, "n": 123456789012345678901234567890}', '[]', '"x"', "null", " [ true,false , null ] ", '{"":{"b":{"d":1,"c":2},"a":[{"y":1,"x":2}]}}']


def test_canonical_bodies(spark):
    clean = lambda v: None if isinstance(v, float) and not math.isfinite(v) else {k: clean(x) for k, x in v.items()} if isinstance(v, dict) else [clean(x) for x in v] if isinstance(v, list) else v
    df = spark.createDataFrame(list(enumerate([*BODIES, "{broken", "", None])), "i int, body string")
    got = {r.i: r.c for r in df.select("i", canonical_text(F.col("body")).alias("c")).collect()}
    assert [got[i] for i in range(len(BODIES))] == [json.dumps(clean(json.loads(b)), sort_keys=True, ensure_ascii=False, separators=(",", ":")) for b in BODIES]
    assert [got[i] for i in range(len(BODIES), len(BODIES) + 3)] == [None, None, None]


def test_canonical_rows_and_gates(spark):
    df = spark.sql("""SELECT 1e-7D AS b, double('NaN') AS a, named_struct('z', map('k', 1.5D, 'a', null), 'y', array(named_struct('q', date'2024-01-02', 'p', true))) AS c, 2.50BD AS d, timestamp_ntz'2024-01-02 03:04:05' AS e""")
    assert df.select(canonical_row(["b", "a", "c", "d", "e"]).alias("x")).first().x == '{"a":null,"b":1e-07,"c":{"y":[{"p":true,"q":"2024-01-02"}],"z":{"a":null,"k":1.5}},"d":"2.50","e":"2024-01-02T03:04:05"}'
    rows = spark.createDataFrame([(1, '{"a": 1, "b": {"d": 1, "c": 2}}'), (1, '{"b":{"c":2,"d":1},"a":1}'), (1, '{"b":{"c":2,"d":1},"a":2}')], "id long, body string")
    hashes = [r.content_hash for r in gates.row_hash(rows, bodies=["body"]).collect()]
    assert hashes[0] == hashes[1] != hashes[2] and gates.row_hash(rows, bodies=["body"]).columns == ["id", "body", "content_hash"]
    # Flat rows of numbers are written as any other row is.
    flat = spark.createDataFrame([(1, 0.1, "a\"é", True), (None, 1e-7, None, None), (3, float("nan"), "", False), (4, -1e22, "x", True), (5, None, "\n", None), (6, 12345678.0, "y", True)], "z long, b double, s string, f boolean")
    import hashlib

    want = [hashlib.sha256(r.t.encode()).hexdigest() for r in flat.select(canonical_row(["z", "b", "s", "f"]).alias("t")).collect()]
    assert [r.content_hash for r in gates.row_hash(flat).collect()] == want
    twice = spark.createDataFrame([("x", 1), ("x", 2), ("y", 2), ("y", 1), ("z", 1), ("z", 2), ("z", 2)], "k string, v long")
    of = lambda k: gates.group_hash(twice.filter(F.col("k") == k).withColumn("k", F.lit("one")), ["k"]).first().content_hash
    assert of("x") == of("y") != of("z")


def test_bars_hash_and_do_not_sort(spark):
    e = spark.createDataFrame([("a", sec(1), 5, 2.0), ("a", sec(1), 3, 1.0), ("a", sec(1), -(2**62), 7.0), ("a", sec(0), 9, 4.0), ("a", None, 1, 99.0), ("b", dt.datetime(1, 1, 1), 2, 1.0), ("b", dt.datetime(9999, 1, 1), 2**62, 3.0)], "k string, ts timestamp_ntz, id long, p double")
    bars = series.ohlc(e.filter("ts IS NOT NULL"), ["k"], F.lit(0), "p", ["ts", "id"])
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert {r.k: (r.open, r.high, r.low, r.close) for r in bars.collect()} == {"a": (4.0, 7.0, 1.0, 2.0), "b": (1.0, 3.0, 1.0, 3.0)}
    odd = spark.createDataFrame([("a", None, 5, 2.0), ("a", None, 3, 1.0), ("a", None, None, 9.0), ("b", sec(1), None, 4.0), ("b", sec(1), 0, 5.0)], e.schema)
    assert {r.k: (r.open, r.close) for r in series.ohlc(odd, ["k"], F.lit(0), "p", ["ts", "id"]).collect()} == {"a": (9.0, 2.0), "b": (4.0, 5.0)}
    with pytest.raises(ValueError):
        series.order_key(e, ["p"])


def test_points_in_windows(spark):
    """As many windows as points on one symbol, which overlap, touch or are empty."""
    rng = random.Random(8)
    windows = [("hot" if k % 9 else "b", sec(a := rng.randrange(200_000)), sec(a + rng.choice([0, 0, 1, 3, 40]))) for k in range(3000)]
    points = [("hot" if k % 8 else rng.choice(["b", "c", None]), sec(rng.randrange(210_000)), k) for k in range(3000)] + [("hot", None, -1)]
    held = defaultdict(list)
    for k, a, b in windows:
        held[k].append((a, b))
    want = sorted(k for key, at, k in points if at and any(a <= at < b for a, b in held[key]))
    p, w = spark.createDataFrame(points, "k string, at timestamp_ntz, id long"), spark.createDataFrame(windows, "k string, a timestamp_ntz, b timestamp_ntz")
    for most in (None, 200):
        assert sorted(r.id for r in series.inside(p, w, ["k"], "at", "a", "b", most).collect()) == want
    many = spark.range(100_000).selectExpr("'one' AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS at", "id")
    some = spark.range(100_000).selectExpr("'one' AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 2) AS a", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 2 + 1) AS b")
    assert series.inside(many, some, ["k"], "at", "a", "b", 10_000).count() == 50_000


def test_cells_beyond_the_most_are_one(spark):
    from brightwater.plans.client import folded_cells, squarify

    rows = spark.createDataFrame([("a", k, float(k)) for k in range(10)] + [("b", k, 1.0) for k in range(3)] + [("c", 1, None)], "g string, k long, v double")
    got = defaultdict(dict)
    for r in folded_cells(rows, "g", "k", "v", 4).collect():
        got[r.g][r.cell] = float(r.cap)
    assert dict(got) == {"a": {"9": 9.0, "8": 8.0, "7": 7.0, "Other (6)": 21.0}, "b": {"0": 1.0, "1": 1.0, "2": 1.0}}
    boxes = squarify(sorted((random.Random(k).random() + 0.01 for k in range(400)), reverse=True), 0.0, 0.0, 100.0, 60.0)
    assert abs(sum(w * h for *_, w, h in boxes) - 6000) < 1e-6 and all(x + w < 100 + 1e-6 and y + h < 60 + 1e-6 for x, y, w, h in boxes)
    overlaps = sum(a[0] < b[0] + b[2] - 1e-9 and b[0] < a[0] + a[2] - 1e-9 and a[1] < b[1] + b[3] - 1e-9 and b[1] < a[1] + a[3] - 1e-9 for i, a in enumerate(boxes) for b in boxes[:i])
    assert overlaps == 0 and squarify([], 0, 0, 1, 1) == []


def test_requests_are_served_or_refused(spark):
    from brightwater.sources import catalog

    asked = [("revenue_estimate", "S", None), ("revenue_estimate", None, None), ("revenue_estimate", "S", "period"), ("domains", "S", "parent_key"), ("domains", None, "parent_key"), ("odd", "S", None), (None, None, None), ("news", None, None)]
    got = catalog.refused(spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "i int, resource string, symbol string, filter string")).collect()
    assert {r.i: r.refused for r in got} == {0: None, 1: "needs a symbol", 2: "no such filter", 3: "has no symbols", 4: None, 5: "no such resource", 6: "no such resource", 7: None}
