"""Keyset pages: predicates over any number of columns and directions, and cursors that carry a key."""

from __future__ import annotations

import base64
import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def after(keys: list[tuple[str, bool]], values: list) -> Column:
    """Rows behind ``values`` in the order of ``keys`` (column, descending)."""
    out = []
    for i, ((name, down), value) in enumerate(zip(keys, values, strict=True)):
        same = [F.col(k) == F.lit(v) for (k, _), v in zip(keys[:i], values[:i], strict=True)]
        out.append(reduce(lambda a, b: a & b, [*same, F.col(name) < F.lit(value) if down else F.col(name) > F.lit(value)]))
    return reduce(lambda a, b: a | b, out)


def ordered(df: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    return df.orderBy(*[F.col(k).desc_nulls_first() if down else F.col(k).asc_nulls_last() for k, down in keys])


def page(df: DataFrame, keys: list[tuple[str, bool]], size: int, values: list | None = None) -> DataFrame:
    """One row more than ``size``: it says whether there is a next page. A top-k, never a full sort."""
    return ordered(df.filter(after(keys, values)) if values else df, keys).limit(size + 1)


def page_at(df: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    """``size`` rows behind the first ``offset`` (below 0 counts as 0) in the ascending order of columns, nulls first.

    A top-k of all rows up to the page would hold them in each task and bring them to one. Here rows are cut into ranges and counted, and only the ranges that the page lies in are sorted.
    """
    spark = df.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = materialize(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "page")
    counts = sorted(map(tuple, cut.groupBy("_range").agg(F.count(F.lit(1))).collect()))  # a row a range
    first, held, before = max(0, offset), {}, 0
    for number, n in counts:
        if before < first + size and before + n > first:
            held[number] = before
        before += n
    if not held:
        return df.limit(0)
    behind = F.create_map(*[F.lit(x) for pair in held.items() for x in pair])[F.col("_range")]
    place = behind + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    page = cut.filter(F.col("_range").isin(list(held))).withColumn("_place", place).filter(F.col("_place").between(first + 1, first + size))
    return page.select(*df.columns)


def fingerprint(query: dict) -> str:
    return hashlib.sha256(json.dumps(query, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]


def encode(query: dict, values: list) -> str:
    body = json.dumps({"v": 1, "q": fingerprint(query), "k": [[type(v).__name__, str(v)] for v in values]}, separators=(",", ":"))
    return base64.urlsafe_b64encode(body.encode()).decode().rstrip("=")


def decode(query: dict, cursor: str) -> list:
    """The key of a cursor; a cursor of another query is refused."""
    import datetime
    import decimal

    kinds = {"int": int, "float": float, "str": str, "Decimal": decimal.Decimal, "date": datetime.date.fromisoformat, "datetime": datetime.datetime.fromisoformat}
    try:
        body = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
        if body["v"] != 1 or body["q"] != fingerprint(query):
            raise ValueError("the cursor belongs to another query")
        return [kinds[k](v) for k, v in body["k"]]
    except (KeyError, TypeError, UnicodeDecodeError) as e:
        raise ValueError("no such cursor") from e
