"""The live feed as batches: decoding, rejects, sampling, outboxes, folds, gap reconciliation and usage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import sampling, series
from ..operators.series import last_rows
from .registry import query, table


def _ts(x: str):
    return F.lit(x).cast("timestamp_ntz")


@query("str_01_envelopes", """
    SELECT CASE event_id % 5 WHEN 0 THEN 'no json' WHEN 1 THEN 'odd type' WHEN 2 THEN 'bad base64' ELSE 'ok' END AS outcome, count(*) AS n, sum(CASE WHEN event_id % 5 > 2 THEN length(props) ELSE 0 END)::BIGINT AS bytes FROM events GROUP BY 1""")
def envelopes(spark, d):
    """JSON, then the type, then strict base64; each failure is a reject of its own with the first 512 characters. What is inside stays bytes here."""
    k = F.col("event_id") % 5
    body = F.base64(F.col("props").cast("binary"))
    raw = F.when(k == 0, "{broken").when(k == 1, F.concat(F.lit('{"type":"heartbeat","message":"'), body, F.lit('"}'))).when(k == 2, F.lit('{"type":"pricing","message":"%%%"}')).otherwise(
        F.concat(F.lit('{"type":"pricing","message":"'), body, F.lit('"}')))
    e = table(spark, d, "events").select(raw.alias("raw")).withColumn("m", F.from_json("raw", "struct<type:string,message:string>"))
    e = e.withColumn("bytes", F.expr("try_to_binary(m.message, 'base64')"))
    outcome = F.when(F.col("m.type").isNull(), "no json").when(F.col("m.type") != "pricing", "odd type").when(F.col("bytes").isNull(), "bad base64").otherwise("ok")
    rejected = e.withColumn("outcome", outcome).withColumn("excerpt", F.when(F.col("outcome") != "ok", F.substring("raw", 1, 512)))
    return rejected.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("outcome") == "ok", F.length("bytes"))), F.lit(0)).alias("bytes"))


@query("str_02_fields", """
    SELECT event_id, CASE WHEN value < 200 THEN value::VARCHAR ELSE 'null' END AS price, coalesce((json_extract_string(props, '$.k')::INT)::VARCHAR, 'null') AS size, CASE WHEN event_id % 2 = 0 THEN event_type[1:4] ELSE 'null' END AS venue FROM events WHERE user_id % 10 <> 0""")
def fields(spark, d):
    """Rows without a key go; a value out of bounds is null and its row stays; a zero counts, an absent field is null; names keep their width."""
    e = table(spark, d, "events").withColumn("symbol", F.when(F.col("user_id") % 10 != 0, F.col("user_id"))).filter("symbol IS NOT NULL")
    price = F.when(F.col("value").between(0, 199.9999999), F.col("value")).cast("string")
    size, venue = F.get_json_object("props", "$.k").try_cast("int").cast("string"), F.when(F.col("event_id") % 2 == 0, F.substring("event_type", 1, 4))
    return e.select("event_id", *[F.coalesce(c, F.lit("null")).alias(n) for n, c in (("price", price), ("size", size), ("venue", venue))])


@query("str_03_instants", "SELECT event_type, count(*) FILTER (event_id % 4 <> 3) AS expiring, count(*) FILTER (event_id % 3 <> 2) AS timed FROM events GROUP BY 1")
def instants(spark, d):
    """Expiry comes in seconds, time in milliseconds; what lies outside 1970 to 2100 is null."""
    at = F.col("ts").cast("timestamp")
    expiry = S.epoch_within(F.when(F.col("event_id") % 4 == 3, F.lit(-5)).otherwise(F.unix_timestamp(at)), "s")
    time = S.epoch_within(F.when(F.col("event_id") % 3 == 2, F.unix_micros(at)).otherwise(F.unix_millis(at)), "ms")
    return table(spark, d, "events").groupBy("event_type").agg(F.count(expiry).alias("expiring"), F.count(time).alias("timed"))


@query("str_08_late_ticks", """
    SELECT user_id, count(*) AS archived, arg_max(event_id, (ts, event_id)) AS quote FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN ts - INTERVAL 3 DAY ELSE ts END AS t FROM events) GROUP BY 1""".replace("(ts, event_id)", "(t, event_id)"))
def late_ticks(spark, d):
    """Every 50th tick comes three days late: all are archived, and no quote goes back."""
    t = F.when(F.col("event_id") % 50 == 0, F.expr("ts - INTERVAL 3 DAY")).otherwise(F.col("ts"))
    return table(spark, d, "events").withColumn("t", t).groupBy("user_id").agg(F.count(F.lit(1)).alias("archived"), F.max_by("event_id", F.struct("t", "event_id")).alias("quote"))


@query("str_10_unarchived", "SELECT 'archive' AS sink, count(*) AS n FROM events WHERE event_type <> 'view' UNION ALL SELECT 'quotes', count(DISTINCT user_id) FROM events")
def unarchived(spark, d):
    """Some symbols are quoted but not kept."""
    e = table(spark, d, "events")
    kept = e.filter("event_type != 'view'").agg(F.count(F.lit(1)).alias("n")).select(F.lit("archive").alias("sink"), "n")
    return kept.unionByName(e.agg(F.count_distinct("user_id").alias("n")).select(F.lit("quotes").alias("sink"), "n"))


@query("str_11_unknown_rejects", "SELECT user_id, 'unknown symbol' AS reason, count(*) AS n FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def unknown_rejects(spark, d):
    known = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    return table(spark, d, "events").join(known, "user_id", "left_anti").groupBy("user_id", F.lit("unknown symbol").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def windows_sql(key: str, n: int) -> str:
    """Windows by the rule itself: one begins at the first reject, the next at the first more than an hour later."""
    on = " AND ".join(f"e.{k} = w.{k}" for k in key.split(", "))
    return f"""
    WITH RECURSIVE w AS (SELECT {key}, min(ts) AS s FROM events GROUP BY ALL UNION ALL SELECT {", ".join("w." + k for k in key.split(", "))}, (SELECT min(ts) FROM events e WHERE {on} AND e.ts > w.s + INTERVAL 1 HOUR) FROM w WHERE s IS NOT NULL),
    a AS (SELECT e.*, w.s FROM events e ASOF JOIN (SELECT * FROM w WHERE s IS NOT NULL) w ON {on} AND e.ts >= w.s)
    SELECT {key}, s AS window_start, event_id, (row_number() OVER (PARTITION BY {key}, s ORDER BY ts, event_id))::INT AS seen FROM a QUALIFY seen <= {n}"""


@query("str_12_sampled_rejects", windows_sql("event_type", 2))
def sampled_rejects(spark, d):
    """Two a reason are kept of each hour that a first reject opens: a stream of three batches, its windows held as state."""
    from ..streaming.ticks import new_folder, replayed

    folder = new_folder(spark)
    e = replayed(spark, d, folder, batches=3).select("event_type", "event_id", "ts")
    rows = sampling.sampled_stream(e, ["event_type"], "ts", ["event_id"], 2)
    rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/rejects").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rejects").select("event_type", "window_start", "event_id", "seen")


@query("str_13_subscriptions", "SELECT c_custkey, CASE WHEN length(c_name) > 32 OR c_custkey % 9 = 0 THEN 'invalid' WHEN c_acctbal <= 0 THEN 'unknown' ELSE 'accepted' END AS outcome FROM customer")
def subscriptions(spark, d):
    """Asked-for symbols are valid, known, or refused with a reason."""
    name = F.when(F.col("c_custkey") % 9 == 0, "bad symbol!").otherwise(F.upper(F.translate("c_name", "#", "-")))
    outcome = F.when(~S.valid_symbol(name), "invalid").when(F.col("c_acctbal") <= 0, "unknown").otherwise("accepted")
    return table(spark, d, "customer").select("c_custkey", outcome.alias("outcome"))


@query("str_15_connection_health", "SELECT user_id, max(ts) AS heartbeat, max(ts) < TIMESTAMP '2024-01-30' - INTERVAL 20 MINUTE AS stale FROM events GROUP BY 1")
def connection_health(spark, d):
    """The last heartbeat of a connection; stale after twice the rescan interval (ten minutes)."""
    out = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("heartbeat"))
    return out.withColumn("stale", F.col("heartbeat") < F.expr("timestamp_ntz'2024-01-30' - INTERVAL 20 MINUTE"))


@query("str_18_live_session", """
    WITH s AS (SELECT user_id, max(ts) AS snap FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1), l AS (SELECT e.* FROM events e LEFT JOIN s USING (user_id) WHERE snap IS NULL OR ts >= snap),
    q AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM l)
    SELECT user_id, event_id, greatest(n - 10, 0) AS dropped FROM q WHERE rn <= 10""")
def live_session(spark, d):
    """Ticks older than a client's snapshot go; of a full queue the oldest are dropped, and counted."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id")
    snap = e.filter(F.col("ts") < _ts("2024-01-20")).groupBy("user_id").agg(F.max("ts").alias("snap"))
    live = e.join(snap, "user_id", "left").filter("snap IS NULL OR ts >= snap")
    n = live.groupBy("user_id").agg(F.greatest(F.count(F.lit(1)) - 10, F.lit(0)).alias("dropped"))
    return last_rows(live, ["user_id"], [F.desc("ts"), F.desc("event_id")], 10).join(n, "user_id").select("user_id", "event_id", "dropped")


_LATE = "CASE WHEN event_id % 20 = 0 THEN ts - INTERVAL 3 HOUR ELSE ts END"
_LIVE = f"""t AS (SELECT user_id, event_id, {_LATE} AS told, date_trunc('hour', {_LATE})::TIMESTAMP AS bar_ts, value FROM events WHERE event_type IN ('purchase', 'click') AND value > 0),
    m AS (SELECT *, max(bar_ts) OVER (PARTITION BY user_id ORDER BY event_id) AS reach FROM t)"""
_DRAWN = """SELECT user_id, bar_ts, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close FROM m WHERE bar_ts >= reach GROUP BY ALL"""


def _live(e):
    """Every twentieth tick tells of three hours ago; those of other sessions or without a price are ignored."""
    late = F.when(F.col("event_id") % 20 == 0, F.expr("ts - INTERVAL 3 HOUR")).otherwise(F.col("ts"))
    return e.filter("event_type IN ('purchase', 'click') AND value > 0").select("user_id", "event_id", late.alias("at"), "value")


@query("str_19_live_candles", f"WITH {_LIVE} {_DRAWN}")
def live_candles(spark, d):
    """Ticks in the order they come: a later bucket opens a bar, its own extends it, an older one is ignored."""
    return series.folded_candles(_live(table(spark, d, "events")), ["user_id"], "at", "value", "event_id", 3600)


@query("str_19_stream_of_candles", f"WITH {_LIVE} {_DRAWN}")
def stream_of_candles(spark, d):
    """The same bars from a stream of four batches that keeps each symbol's last bar as state."""
    from ..streaming.candles import bars_of, fold
    from ..streaming.ticks import new_folder, replayed

    folder = new_folder(spark)
    fold(_live(replayed(spark, d, folder)), folder, "user_id", "at", "value", "event_id", 3600)
    return bars_of(spark, folder, "user_id")


@query("str_19_live_sessions", f"""
    WITH {_LIVE}, b AS (SELECT user_id, max(ts) AS bar_ts FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1), d AS (SELECT b.user_id, b.bar_ts, max(value) AS h, min(value) AS l, arg_max(value, event_id) AS c FROM b LEFT JOIN t ON t.user_id = b.user_id AND told::DATE = b.bar_ts::DATE GROUP BY ALL)
    SELECT user_id, bar_ts, 50.0::DOUBLE AS open, greatest(60.0, coalesce(h, 60.0))::DOUBLE AS high, least(40.0, coalesce(l, 40.0))::DOUBLE AS low, coalesce(c, 55.0)::DOUBLE AS close FROM d""")
def live_sessions(spark, d):
    """Daily bars are only ever extended, by ticks of their own UTC day."""
    e = table(spark, d, "events")
    last = e.filter("event_type = 'view' AND ts < timestamp_ntz'2024-01-20'").groupBy("user_id").agg(F.max("ts").alias("bar_ts"))
    last = last.select("user_id", "bar_ts", *[F.lit(x).alias(c) for c, x in (("open", 50.0), ("high", 60.0), ("low", 40.0), ("close", 55.0))])
    return series.extended_sessions(_live(e), ["user_id"], "at", "value", "event_id", last)


@query("str_20_tape", "SELECT user_id, ts, event_id FROM (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) <= 20")
def tape(spark, d):
    """The newest distinct instants of each symbol."""
    one = table(spark, d, "events").groupBy("user_id", "ts").agg(F.min("event_id").alias("event_id"))
    return last_rows(one, ["user_id"], [F.desc("ts")], 20).select("user_id", "ts", "event_id")


@query("str_21_gap_reconciliation", """
    WITH g AS (SELECT DISTINCT user_id, date_trunc('hour', ts)::TIMESTAMP AS bar_ts FROM events WHERE event_type = 'error'), b AS (SELECT DISTINCT user_id, date_trunc('hour', ts)::TIMESTAMP AS bar_ts FROM events WHERE event_type = 'purchase'),
    t AS (SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS bar_ts, count(*) AS n, arg_max(value, (ts, event_id)) AS close FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL)
    SELECT user_id, bar_ts, CASE WHEN b.user_id IS NOT NULL THEN 'had a bar' WHEN t.n IS NULL THEN 'open' ELSE 'closed' END AS state, coalesce(CASE WHEN b.user_id IS NULL THEN t.n END, 0) AS ticks FROM g LEFT JOIN b USING (user_id, bar_ts) LEFT JOIN t USING (user_id, bar_ts)""")
def gap_reconciliation(spark, d):
    """Bars from archived ticks where a gap has none; a gap closes if there were ticks."""
    e = table(spark, d, "events").withColumn("bar_ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    slots = e.filter("event_type = 'error'").select("user_id", "bar_ts").distinct()
    bars = e.filter("event_type = 'purchase'").select("user_id", "bar_ts").distinct().withColumn("had", F.lit(True))
    made = e.filter("event_type IN ('view', 'click')").groupBy("user_id", "bar_ts").agg(F.count(F.lit(1)).alias("n"), F.max_by("value", F.struct("ts", "event_id")).alias("close"))
    both = slots.join(bars, ["user_id", "bar_ts"], "left").join(made, ["user_id", "bar_ts"], "left")
    state = F.when(F.col("had"), "had a bar").when(F.col("n").isNull(), "open").otherwise("closed")
    return both.select("user_id", "bar_ts", state.alias("state"), F.coalesce(F.when(F.col("had").isNull(), F.col("n")), F.lit(0)).alias("ticks"))


@query("str_27_usage", "SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS calls FROM events WHERE ts < TIMESTAMP '2024-01-25' GROUP BY ALL")
def usage(spark, d):
    """Daily usage: what was metered since the last flush, at some noon, is added to what the table holds; today isn't reported yet."""
    calls = table(spark, d, "events").filter(F.col("ts") < _ts("2024-01-25")).select("user_id", F.to_date("ts").cast("string").alias("day"), "ts")
    of = lambda rows: rows.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("calls"))
    stored, flushed = of(calls.filter(F.col("ts") < _ts("2024-01-15 12:00:00"))), of(calls.filter(F.col("ts") >= _ts("2024-01-15 12:00:00")))
    both = stored.join(flushed.withColumnRenamed("calls", "more"), ["user_id", "day"], "full")
    return both.select("user_id", "day", (F.coalesce("calls", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("calls"))


@query("snk_04_tick_outbox", """
    SELECT event_id, 'ticks.' || CASE WHEN c_mktsegment IS NULL THEN 'UNKNOWN' ELSE upper(c_mktsegment) END AS topic, '{"symbol":' || user_id || ',"event_id":' || event_id || '}' AS body
    FROM events LEFT JOIN (SELECT * FROM customer WHERE c_nationkey > 5) ON user_id = c_custkey""")
def tick_outbox(spark, d):
    """Outbox rows of a batch of ticks, written beside them: topic by exchange, body as JSON."""
    c = table(spark, d, "customer").filter("c_nationkey > 5").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    out = table(spark, d, "events").select("event_id", "user_id").join(c, "user_id", "left")
    return out.select("event_id", F.concat(F.lit("ticks."), S.exchange(F.col("c_mktsegment"))).alias("topic"), F.to_json(F.struct(F.col("user_id").alias("symbol"), "event_id")).alias("body"))


@query("win_14_absolute_rank", "SELECT p_brand, p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) - 1)::INT AS rank_index FROM part")
def absolute_rank(spark, d):
    """Rank within a key, the rows of a key in as many tasks as there are price ranges: counts by range, then offsets."""
    p = table(spark, d, "part").select("p_brand", "p_partkey", "p_retailprice").withColumn("range", -F.floor(F.col("p_retailprice") / 50))
    n = p.groupBy("p_brand", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("p_brand").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("p_brand", "range").orderBy(F.desc("p_retailprice"), "p_partkey")) - 1
    return p.join(n.withColumn("before", before).drop("n"), ["p_brand", "range"]).select("p_brand", "p_partkey", (F.col("before") + place).cast("int").alias("rank_index"))


@query("src_10_connection_plan", """
    SELECT c_custkey, c_mktsegment AS exchange, ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 100)::INT AS connection FROM customer WHERE c_acctbal > 0""")
def connection_plan(spark, d):
    """Symbols by exchange in chunks of a connection's quota. An exchange's symbols are numbered by ranges of keys, so none is one task's work."""
    c = table(spark, d, "customer").filter("c_acctbal > 0").select("c_custkey", F.col("c_mktsegment").alias("exchange")).withColumn("range", F.floor(F.col("c_custkey") / 1000))
    n = c.groupBy("exchange", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("exchange").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("exchange", "range").orderBy("c_custkey")) - 1
    out = c.join(n.withColumn("before", before).drop("n"), ["exchange", "range"])
    return out.select("c_custkey", "exchange", F.floor((F.col("before") + place) / 100).cast("int").alias("connection"))
