"""Live ticks: an archive without duplicates, a quote per symbol and an outbox, filled batch by batch and published by a marker.

Spark pulls, so nothing is dropped under load. Late ticks are archived whenever they come; quotes only move forward, by a guard on the
instant. Every batch writes to folders of its own number and at last moves the marker, a file that names the newest batch
and where its quotes lie. Readers take no batch that the marker doesn't cover. So a batch that fails shows nothing of itself, whatever it had
written, and when it is run again it overwrites itself: each tick is archived and published exactly once.

A batch is held against the days that its own ticks fall on, one by one, so a late tick costs a day's files and not all since. Quotes are
versions and deltas: a batch writes the symbols that moved; every ``compact_every`` batches the deltas are folded into a new version.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..plans.registry import query
from ..session import shared_dir

KEY = ["symbol", "ts", "payload_hash"]
TICK = "symbol bigint, ts timestamp_ntz, event_id bigint, price double, size int, payload_hash string"


def decode(events: DataFrame) -> DataFrame:
    """Ticks of raw events; ``reject`` says why a row can't be one."""
    size = F.get_json_object("props", "$.k").try_cast("int")
    out = events.select(F.col("user_id").alias("symbol"), "ts", "event_id", F.col("value").alias("price"), size.alias("size"), F.sha2(F.concat_ws("|", "event_type", "value", "props"), 256).substr(1, 16).alias("payload_hash"))
    reject = F.when(F.col("symbol").isNull() | F.col("ts").isNull(), "no key").when(F.col("size").isNull(), "bad body")
    return out.withColumn("reject", reject)


@dataclass(frozen=True)
class Marker:
    """The newest batch that readers may see, and its quotes: a version, and the deltas behind it up to ``flushed``."""

    batch: int = -1
    version: int = -1
    flushed: int = -1


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def read_marker(spark: SparkSession, folder: str) -> Marker:
    fs, at = _files(spark, f"{folder}/marker")
    if not fs.exists(at):
        return Marker()
    text = fs.open(at)
    try:
        return Marker(**json.loads(bytes(text.readAllBytes()).decode()))
    finally:
        text.close()


def _move_marker(spark: SparkSession, folder: str, marker: Marker) -> None:
    """Written beside the old one and renamed over it, so a reader sees one of the two."""
    fs, at = _files(spark, f"{folder}/marker")
    _, beside = _files(spark, f"{folder}/marker-{marker.batch}")
    out = fs.create(beside, True)
    out.write(bytearray(json.dumps(marker.__dict__).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(beside, at, options)


def archive_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{TICK}, day date, batch bigint").parquet(f"{folder}/archive").filter(F.col("batch") <= read_marker(spark, folder).batch)


def outbox_of(spark: SparkSession, folder: str) -> DataFrame:
    """topic, key and body of everything that is published."""
    return spark.read.schema("topic string, key string, body string, batch bigint").parquet(f"{folder}/outbox").filter(F.col("batch") <= read_marker(spark, folder).batch)


def _quotes(spark: SparkSession, folder: str, marker: Marker) -> DataFrame:
    """The version and its deltas; symbols that moved occur in several."""
    rows = spark.createDataFrame([], TICK)
    if marker.version >= 0:
        rows = rows.unionByName(spark.read.schema(TICK).parquet(f"{folder}/quotes/version={marker.version}"))
    if marker.flushed > marker.version:
        deltas = spark.read.schema(f"{TICK}, batch bigint").parquet(f"{folder}/deltas")
        rows = rows.unionByName(deltas.filter(F.col("batch").between(marker.version + 1, marker.flushed)).drop("batch"))
    return rows


def newest(ticks: DataFrame) -> DataFrame:
    """A tick per symbol: the newest instant, ties to the later event."""
    others = [c for c in ticks.columns if c != "symbol"]
    best = ticks.filter("ts IS NOT NULL").groupBy("symbol").agg(F.max_by(F.struct(*others), F.struct("ts", "event_id")).alias("_r"))
    return best.select("symbol", "_r.*").select(*ticks.columns)


def quotes_of(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes as the last batch that wrote any left them."""
    return newest(_quotes(spark, folder, read_marker(spark, folder)))


def fill(raw: DataFrame, folder: str, known: DataFrame | None = None, archive_all: bool = True, quotes_every: int = 1, compact_every: int = 16, topics: DataFrame | None = None, before_commit=None) -> str:
    """Runs the stream over all that is there; the folder, for the readers above.

    archive_all: off, ticks are quoted but not kept. quotes_every: quotes are written at every n-th batch, with what has come until then.
    topics: symbol and topic of what is published; without it nothing is. before_commit: called with a batch's number when all is written but the marker (for tests).
    Counters of rows received and rejected are observed as ``ticks`` and reach ``Counters`` with the query's progress.
    """
    spark = raw.sparkSession
    ticks_of = decode(raw).observe("ticks", F.count(F.lit(1)).alias("received"), F.count("reject").alias("rejected"), F.count_if(F.col("reject") == "no key").alias("without_key"))

    def one(batch: DataFrame, number: int) -> None:
        marker = read_marker(spark, folder)
        if number <= marker.batch:
            return  # the marker had moved when the stream failed
        ticks = batch.filter("reject IS NULL").drop("reject")
        if known is not None:
            ticks = ticks.join(known, "symbol", "left_semi")
        ticks = ticks.groupBy(*KEY).agg(F.max("event_id").alias("event_id"), F.first("price").alias("price"), F.first("size").alias("size"))  # one body has one price
        ticks = ticks.select("symbol", "ts", "event_id", "price", "size", "payload_hash").withColumn("day", F.to_date("ts")).persist()
        new = ticks
        if archive_all:
            if marker.batch >= 0:
                days = [r[0] for r in ticks.select("day").distinct().collect()]  # of one batch
                before = archive_of(spark, folder).filter(F.col("day").isin(days))
                new = ticks.join(before.select(*KEY, "day"), [*KEY, "day"], "left_anti").select(*ticks.columns)
            new = new.persist()
            new.withColumn("batch", F.lit(number).cast("long")).hint("rebalance", "day").write.partitionBy("day", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{folder}/archive")
        if topics is not None:
            rows = new.join(topics, "symbol", "left")
            body = F.to_json(F.struct("symbol", "event_id", F.col("ts").cast("string").alias("ts"), "price"))
            rows.select(F.concat(F.lit("ticks."), F.coalesce("topic", F.lit("UNKNOWN"))).alias("topic"), F.col("symbol").cast("string").alias("key"), body.alias("body")).write.mode("overwrite").parquet(f"{folder}/outbox/batch={number}")
        ahead = newest(ticks.drop("day"))
        if quotes_every > 1:
            ahead.write.mode("overwrite").parquet(f"{folder}/pending/batch={number}")
        version, flushed = marker.version, marker.flushed
        if (number + 1) % quotes_every == 0:
            if quotes_every > 1:
                since = spark.read.schema(f"{TICK}, batch bigint").parquet(f"{folder}/pending").filter(F.col("batch").between(flushed + 1, number))
                ahead = newest(since.drop("batch"))
            held = newest(_quotes(spark, folder, marker).join(ahead.select("symbol"), "symbol", "left_semi")).select("symbol", F.col("ts").alias("_ts"))
            moved = ahead.join(held, "symbol", "left").filter("_ts IS NULL OR ts > _ts").drop("_ts")
            moved.write.mode("overwrite").parquet(f"{folder}/deltas/batch={number}")
            flushed = number
            if flushed - version >= compact_every:
                newest(_quotes(spark, folder, Marker(number, version, flushed))).write.mode("overwrite").parquet(f"{folder}/quotes/version={number}")
                version = number
        if before_commit is not None:
            before_commit(number)
        _move_marker(spark, folder, Marker(number, version, flushed))
        new.unpersist()
        ticks.unpersist()

    stream = ticks_of.writeStream.queryName(f"ticks-{uuid.uuid4().hex[:8]}").foreachBatch(one).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    stream.awaitTermination()
    return folder


class Counters(StreamingQueryListener):
    """Adds up what streams observe, in a table: a row for each query and batch, so a batch that runs twice counts once.

    It listens from ``with`` on, and has written everything when the block ends.
    """

    SCHEMA = "query string, batch bigint, received bigint, rejected bigint, without_key bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended, self.begun, self.seen = 0, 0, []

    def onQueryStarted(self, event) -> None:
        self.begun += 1

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if found := progress.observedMetrics.get("ticks"):
            self.seen.append((str(progress.id), progress.batchId, found["received"], found["rejected"], found["without_key"]))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended += 1

    def flush(self) -> None:
        rows, self.seen = self.seen, []
        for name, batch, *counts in rows:
            self.spark.createDataFrame([(name, batch, *counts)], self.SCHEMA).drop("query", "batch").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/query={name}/batch={batch}")

    def __enter__(self) -> Counters:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Events come on a thread of their own, some time after the query has ended.
        until = time.time() + 30
        while time.time() < until and (self.ended < self.begun or not self.begun):
            time.sleep(0.05)
        self.spark.streams.removeListener(self)
        self.flush()


def counters_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(Counters.SCHEMA).parquet(path)


def replayed(spark: SparkSession, sf_dir: str, folder: str, batches: int = 4, order: str = "event_id", rows_a_file: int = 250_000) -> DataFrame:
    """The event table as a stream of so many batches: batch b of n holds the b-th of n equal parts of the span of ``order``, and null in the first.

    Every batch is as many files as the others, so that a trigger takes just its own; where rows are too few for that, empty files make up the number.
    Files are small, as a stream's tasks are no more than its files.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    at = F.col(order) if order == "event_id" else F.unix_micros(F.col(order).cast("timestamp"))
    low, high, total = events.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    low, high = (0, 0) if low is None else (low, high)
    each = max(1, -(-total // (batches * rows_a_file)))
    first = [low - (-b * (high - low + 1) // batches) for b in range(batches + 1)]
    nothing = spark.createDataFrame([], events.schema).coalesce(1)
    for b in range(batches):
        mine = (at >= first[b]) & (at < first[b + 1])  # of the bare column, so other row groups are not read
        part = events.filter(mine if b else mine | at.isNull())
        (part.coalesce(1) if each == 1 else part.repartition(each)).write.mode("append").parquet(f"{folder}/events")
        fs, path = _files(spark, f"{folder}/events")
        for _ in range(each * (b + 1) - sum(f.getPath().getName().startswith("part-") for f in fs.listStatus(path))):
            nothing.write.mode("append").parquet(f"{folder}/events")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", each).parquet(f"{folder}/events")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/brightwater/ticks-{uuid.uuid4().hex[:12]}"


def _run(spark: SparkSession, sf_dir: str, batches: int = 4, **options) -> str:
    folder = new_folder(spark)
    return fill(replayed(spark, sf_dir, folder, batches), folder, **options)


_GOOD = "try_cast(json_extract_string(props, '$.k') AS INT) IS NOT NULL"
#: The batch that an event of the replay comes in.
_BATCH = "floor((event_id - (SELECT min(event_id) FROM events)) * {n} / ((SELECT max(event_id) - min(event_id) + 1 FROM events)))"


@query("str_04_tick_archive", f"SELECT user_id AS symbol, ts, max(event_id) AS event_id FROM events WHERE {_GOOD} GROUP BY user_id, ts, event_type, value, props")
def tick_archive(spark, sf_dir):
    return archive_of(spark, _run(spark, sf_dir)).select("symbol", "ts", "event_id")


@query("str_06_live_quotes", f"""
    SELECT user_id AS symbol, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS price FROM events WHERE {_GOOD} GROUP BY 1""")
def live_quotes(spark, sf_dir):
    """Quotes after the last of several batches, compacted on the way."""
    return quotes_of(spark, _run(spark, sf_dir, compact_every=2)).select("symbol", "event_id", "price")


@query("str_07_every_nth_batch", f"""
    SELECT user_id AS symbol, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE {_GOOD} AND {_BATCH.format(n=5)} < 4 GROUP BY 1""")
def every_nth_batch(spark, sf_dir):
    """Of five batches the second and the fourth write quotes, with what has come until then; the fifth's are still to come."""
    return quotes_of(spark, _run(spark, sf_dir, batches=5, quotes_every=2)).select("symbol", "event_id")


@query("str_14_session_counters", f"""
    SELECT {_BATCH.format(n=4)}::BIGINT AS batch, count(*) AS received, count(*) FILTER (NOT coalesce({_GOOD}, false) OR user_id IS NULL OR ts IS NULL) AS rejected, count(*) FILTER (user_id IS NULL OR ts IS NULL) AS without_key FROM events GROUP BY 1""")
def session_counters(spark, sf_dir):
    """What each batch received and rejected, as the stream's own progress tells it, added to a table."""
    folder = new_folder(spark)
    raw = replayed(spark, sf_dir, folder)
    with Counters(spark, f"{folder}/counters"):
        fill(raw, folder)
    return counters_of(spark, f"{folder}/counters").drop("query")


@query("str_17_publish_after_commit", f"""
    WITH t AS (SELECT user_id, ts, max(event_id) AS event_id, min({_BATCH.format(n=4)}) AS batch FROM events WHERE {_GOOD} GROUP BY user_id, ts, event_type, value, props)
    SELECT 'ticks.' || coalesce(upper(c_mktsegment), 'UNKNOWN') AS topic, user_id::VARCHAR AS key, count(*) AS n FROM t LEFT JOIN (SELECT * FROM customer WHERE c_nationkey > 5) ON user_id = c_custkey WHERE batch < 2 GROUP BY ALL""")
def publish_after_commit(spark, sf_dir):
    """A stream whose third batch fails once all of it is written but the marker: two batches are published."""
    folder = new_folder(spark)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_nationkey > 5")
    topics = c.select(F.col("c_custkey").alias("symbol"), F.upper("c_mktsegment").alias("topic"))

    def fail(number: int) -> None:
        if number == 2:
            raise RuntimeError("stopped before the marker")

    raw = replayed(spark, sf_dir, folder)
    try:
        fill(raw, folder, topics=topics, before_commit=fail)
    except Exception as stopped:
        if "stopped before the marker" not in str(stopped):
            raise
    return outbox_of(spark, folder).groupBy("topic", "key").agg(F.count(F.lit(1)).alias("n"))
