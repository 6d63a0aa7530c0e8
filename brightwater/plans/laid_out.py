"""Merges into targets that are laid out by day or in buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import layout
from ..operators.merge import WriteSpec
from ..session import shared_dir
from .merges import _INCOMING, _STORED, _sides
from .registry import query, table

_DAYS = """s AS (SELECT ts::DATE AS day, event_id, value, event_type AS kind FROM events WHERE event_id % 3 <> 0),
    i AS (SELECT ts::DATE AS day, event_id, value + 1 AS value, 'late' AS kind FROM events WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-28')"""


def _place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/brightwater/{name}-{uuid.uuid4().hex[:12]}"


def _by_day(spark, d):
    """A target by day, and rows for its last days."""
    e = table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id", "value", F.col("event_type").alias("kind"))
    path, stored = _place(spark, "by-day"), e.filter("event_id % 3 != 0")
    layout.write_days(stored, path, "day")
    incoming = e.filter("event_id % 2 = 0 AND day >= date'2024-01-28'").select("day", "event_id", (F.col("value") + 1).alias("value"), F.lit("late").alias("kind"))
    return path, stored.schema, incoming


@query("mrg_03_upsert_by_day", f"WITH {_DAYS} SELECT coalesce(s.day, i.day)::VARCHAR AS day, coalesce(s.event_id, i.event_id) AS event_id, CASE WHEN i.event_id IS NULL THEN s.value ELSE i.value END AS value, CASE WHEN i.event_id IS NULL THEN s.kind ELSE i.kind END AS kind FROM s FULL JOIN i ON s.day = i.day AND s.event_id = i.event_id")
def upsert_by_day(spark, d):
    """Rows of three days come in; the files of those days are read and replaced, all others stay as they are."""
    path, schema, incoming = _by_day(spark, d)
    layout.merge_days(path, schema, incoming, WriteSpec("bars", ["day", "event_id"]), "day")
    return spark.read.schema(schema).parquet(path).withColumn("day", F.col("day").cast("string"))


@query("mrg_12_verified_by_day", f"WITH {_DAYS} SELECT count(*) AS attempted, count(s.event_id) AS verified FROM i LEFT JOIN s ON s.day = i.day AND s.event_id = i.event_id")
def verified_by_day(spark, d):
    """Read back before the merge, so that some are missing: from the days that were to be written alone."""
    path, schema, incoming = _by_day(spark, d)
    return layout.verified_days(path, schema, incoming, ["day", "event_id"], "day")


@query("mrg_18_dropped_days", "SELECT ts::DATE::VARCHAR AS day, count(*) AS n FROM events WHERE event_id % 3 <> 0 AND ts >= TIMESTAMP '2024-01-10' GROUP BY 1")
def dropped_days(spark, d):
    """Old days go by folder."""
    path, schema, _ = _by_day(spark, d)
    layout.drop_days(spark, path, "2024-01-10", "day")
    return spark.read.schema(schema).parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("mrg_03_upsert_in_buckets", f"""WITH {_STORED}, {_INCOMING}
    SELECT coalesce(s.k, i.k) AS k, CASE WHEN i.k IS NULL THEN s.status ELSE i.status END AS status, CASE WHEN i.k IS NULL THEN s.price ELSE i.price END AS price,
           CASE WHEN i.k IS NULL THEN s.at ELSE i.at END AS at FROM s FULL JOIN i ON s.k = i.k""")
def upsert_in_buckets(spark, d):
    """The target's rows stay in their buckets; what comes in is shuffled to them."""
    stored, incoming = _sides(spark, d)
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = f"orders_{uuid.uuid4().hex[:12]}"
    target = layout.write_buckets(stored, f"{name}_1", _place(spark, "in-buckets"), ["k"], buckets)
    return layout.merge_buckets(target, incoming, WriteSpec("orders", ["k"]), f"{name}_2", _place(spark, "in-buckets"), buckets)
