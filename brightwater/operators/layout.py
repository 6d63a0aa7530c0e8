"""Targets laid out for what is merged into them.

By day: a merge reads and writes the files of the days that come in, verification reads those alone, and what is too old goes by folder, unread.
In buckets of the key: a merge shuffles what comes in to the target's buckets, and the target's own rows stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize
from .merge import WriteSpec, merge, verified


def days_of(rows: DataFrame, day: str) -> list:
    """The days that a write touches: one value a day, however many rows."""
    return [r[0] for r in rows.select(day).filter(F.col(day).isNotNull()).distinct().collect()]


def write_days(rows: DataFrame, path: str, day: str) -> None:
    """Replaces the days that occur in ``rows``, and no others. A day is a file where it is small and several where it isn't."""
    rows.hint("rebalance", day).write.partitionBy(day).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_days(spark: SparkSession, path: str, schema: StructType, days: list, day: str) -> DataFrame:
    """The rows of some days; other days' files aren't listed in the plan."""
    return spark.read.schema(schema).parquet(path).filter(F.col(day).isin(days))


def merge_days(path: str, schema: StructType, incoming: DataFrame, spec: WriteSpec, day: str) -> list:
    """Merges ``incoming`` into a target by day; the days it touched. The day is part of the key, so a row stays in its day. A merge that fails is run again: it gives the same rows."""
    if day not in spec.keys:
        raise ValueError(f"{day} is no key, so a row could move to another day")
    days = days_of(incoming, day)
    if days:
        old = read_days(incoming.sparkSession, path, schema, days, day)
        write_days(materialize(merge(old, incoming.filter(F.col(day).isNotNull()), spec), "merged-days"), path, day)
    return days


def verified_days(path: str, schema: StructType, attempted: DataFrame, keys: list[str], day: str) -> DataFrame:
    """attempted, verified: as ``merge.verified``, read from the days that were written."""
    return verified(read_days(attempted.sparkSession, path, schema, days_of(attempted, day), day), attempted, keys)


def drop_days(spark: SparkSession, path: str, before: str, day: str) -> list[str]:
    """Drops the days before one (ISO text); the days that went. No row is read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for found in fs.listStatus(at):
        name, _, value = found.getPath().getName().partition("=")
        if name == day and value < before:  # a null day's folder sorts behind all digits
            fs.delete(found.getPath(), True)
            gone.append(value)
    return sorted(gone)


def write_buckets(rows: DataFrame, name: str, path: str, keys: list[str], buckets: int, shuffled: bool = True) -> DataFrame:
    """Writes ``rows`` as a table in buckets of ``keys`` and reads it. Rows that come by bucket already (from ``merge_buckets``) need no shuffle."""
    spark = rows.sparkSession
    out = rows.repartition(buckets, *keys) if shuffled else rows
    out.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def merge_buckets(target: DataFrame, incoming: DataFrame, spec: WriteSpec, name: str, path: str, buckets: int) -> DataFrame:
    """The new version of a bucketed target, written beside the old one and read: only ``incoming`` is shuffled, to the target's buckets, which should be no fewer than shuffle partitions."""
    return write_buckets(merge(target, incoming, spec), name, path, spec.keys, buckets, shuffled=False)
