"""Every query of the engine that isn't of the training-data package, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.series import ohlc
from .plans import client, datasets, discovery, feed, fetching, gaps, laid_out, lifecycle, market, merges, nested, ops, reads, registry, relations, scalar_rules, screens, terminal, upkeep  # noqa: F401  they register their queries
from .plans.registry import query
from .streaming import ticks  # noqa: F401


@query("flagship", """
    SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS bar_ts, arg_min(value, (ts, event_id)) AS open,
           max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close
    FROM events GROUP BY ALL""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of ``events``: one pass of hash aggregates, ties broken by ``event_id``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ohlc(events, ["user_id"], F.date_trunc("hour", "ts").cast("timestamp_ntz"), "value", ["ts", "event_id"])


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
