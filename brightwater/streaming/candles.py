"""Live bars: what a batch draws is written under its number, and the bars that symbols stand at are read back from there by the next one.

A batch is folded as a table is, by ``series.folded_candles``, so no code runs symbol by symbol. It writes the bars of the symbols that moved; every
``compact_every`` batches the last bars of all symbols are written as a version, so a batch reads one version and the batches since.
What a batch reads depends on its number alone: one that is run again reads the same and overwrites itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import series

LEGS = ["open", "high", "low", "close"]


def _newest(bars: DataFrame, key: str) -> DataFrame:
    """A bar per symbol. Bars of a symbol only go forward, and of one bar the later batch is right."""
    at = series.order_key(bars, ["bar_ts", "batch"])
    return bars.groupBy(key).agg(F.max("bar_ts").alias("bar_ts"), *[F.max_by(c, at).alias(c) for c in LEGS])


def _standing(spark: SparkSession, folder: str, key: str, schema: T.StructType, number: int, compact_every: int) -> DataFrame:
    """The last bar of each symbol before a batch."""
    version = number // compact_every * compact_every - 1
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.createDataFrame([], with_batch)
    if version >= 0:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{folder}/last/version={version}").withColumn("batch", F.lit(version).cast("long")))
    if number - 1 > version:
        rows = rows.unionByName(spark.read.schema(with_batch).parquet(f"{folder}/bars").filter(F.col("batch").between(version + 1, number - 1)))
    return _newest(rows, key)


def fold(ticks: DataFrame, folder: str, key: str, at: str, price: str, arrival: str, seconds: int, compact_every: int = 16) -> None:
    """Runs the stream over all that is there: key, bar_ts, open, high, low, close of the bars that each batch touched, as they stand then.

    The rule is that of ``series.folded_candles``; ``arrival`` orders the ticks of a batch, and batches come in order.
    """
    spark = ticks.sparkSession
    schema = T.StructType([ticks.schema[key], T.StructField("bar_ts", ticks.schema[at].dataType), *[T.StructField(c, ticks.schema[price].dataType) for c in LEGS]])

    def one(batch: DataFrame, number: int) -> None:
        last = None
        if number:
            moved = batch.select(F.col(key).alias("_k")).distinct()
            last = _standing(spark, folder, key, schema, number, compact_every).join(moved, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
        bars = series.folded_candles(batch, [key], at, price, arrival, seconds, last)
        bars.write.mode("overwrite").parquet(f"{folder}/bars/batch={number}")
        if (number + 1) % compact_every == 0:
            before = _standing(spark, folder, key, schema, number, compact_every).withColumn("batch", F.lit(number - 1).cast("long"))
            mine = spark.read.schema(schema).parquet(f"{folder}/bars/batch={number}").withColumn("batch", F.lit(number).cast("long"))
            _newest(before.unionByName(mine), key).write.mode("overwrite").parquet(f"{folder}/last/version={number}")

    ticks.writeStream.foreachBatch(one).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def bars_of(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Every bar as it stood last."""
    rows = spark.read.parquet(f"{folder}/bars")
    return rows.groupBy(key, "bar_ts").agg(*[F.max_by(c, "batch").alias(c) for c in LEGS])
