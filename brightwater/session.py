"""Session building and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of an Arrow batch where the session sets no bound of its own.
BATCH_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "brightwater", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC, ANSI casts, adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` of the session.

    Only a local master (tests, a laptop) may leave it unset: one machine then holds everything,
    and a folder of our own is set. On a cluster such a folder would be another one on each
    executor, so that is refused.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str, sort_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a table that outlives any executor, gives the planner true
    sizes, and keeps a text scan from being run once for each reader.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = f"{shared_dir(spark)}/brightwater/{name}-{uuid.uuid4().hex[:12]}"
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application, so that Python tasks can import it anywhere."""
    import os
    import zipfile
    from pathlib import Path

    if spark.conf.get(ARROW_BYTES) == "67108864b" and not spark.sparkContext.getConf().contains(ARROW_BYTES):
        # Spark's own default; a few copies of 64 MB of text in each Python task are a lot of memory. A bound that the user set stays.
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_brightwater_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "brightwater_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    context.addPyFile(path)
    context._brightwater_shipped = True
