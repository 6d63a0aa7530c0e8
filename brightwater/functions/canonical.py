"""Canonical JSON: one text for one value, whatever order its keys come in, byte for byte what the standard library writes with sorted keys.

Keys are sorted at every level, nothing is put between tokens, text isn't escaped beyond need, numbers are written in their shortest form
(``1e-07``, ``12345678.0``), and what JSON can't say (NaN, infinities) is null. The JVM writes numbers in another form, and shortest digits only from
later releases on, so this is one Arrow function over whole columns.
"""

from __future__ import annotations

import datetime as dt
import json
import math

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import ship_package


def scrubbed(value: object) -> object:
    """``value`` with null for numbers that JSON doesn't have, at any depth."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, dict):
        return {str(k): scrubbed(v) for k, v in value.items()}
    if isinstance(value, list):
        return [scrubbed(v) for v in value]
    return value


def _text_of(value: object) -> str:
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)  # decimals keep their places, as text


def written(value: object) -> str:
    return json.dumps(scrubbed(value), sort_keys=True, allow_nan=False, ensure_ascii=False, separators=(",", ":"), default=_text_of)


def _plain(value: object, kind: pa.DataType) -> object:
    """Maps as dicts, at any depth; Arrow gives their entries as pairs."""
    if value is None or not pa.types.is_nested(kind):
        return value
    if pa.types.is_map(kind):
        return {k: _plain(v, kind.item_type) for k, v in value}
    if pa.types.is_struct(kind):
        return {f.name: _plain(value[f.name], f.type) for f in kind}
    return [_plain(v, kind.value_type) for v in value]


@F.arrow_udf(StringType())
def _canonical_value(rows: pa.Array) -> pa.Array:
    return pa.array([written(_plain(v, rows.type)) for v in rows.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _canonical_text(rows: pa.Array) -> pa.Array:
    out = []
    for text in rows.to_pylist():
        try:
            out.append(None if text is None else written(json.loads(text)))
        except ValueError:
            out.append(None)
    return pa.array(out, pa.string())


@F.arrow_udf(StringType())
def _number_text(numbers: pa.Array) -> pa.Array:
    return pa.array([None if x is None or not math.isfinite(x) else repr(x) for x in numbers.to_pylist()], pa.string())


def flat_row(numbers: list[str], others: list[str], source: dict[str, Column]) -> Column:
    """The canonical text of a row without nested parts: only the shortest digits of ``numbers`` (doubles and floats) are Python's work. ``others`` are text, whole numbers and booleans."""
    ship_package(SparkSession.active())
    pieces = []
    for name in sorted([*numbers, *others]):
        if name in numbers:
            pieces.append(F.concat(F.lit(json.dumps(name, ensure_ascii=False) + ":"), F.coalesce(_number_text(source[name].cast("double")), F.lit("null"))))
        else:
            one = F.to_json(F.struct(source[name].alias(name)), {"ignoreNullFields": "false"})
            pieces.append(F.substring(one, F.lit(2), F.length(one) - 2))
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def canonical_value(value: Column) -> Column:
    """The canonical text of a column of any type; a null column is ``null``."""
    ship_package(SparkSession.active())
    return _canonical_value(value)


def canonical_row(columns: list[str]) -> Column:
    """The canonical text of a row of these columns, nulls kept. Rows of nothing but text, whole numbers and booleans need no Python: ``gates.row_hash`` leaves them to the JVM."""
    return canonical_value(F.struct(*[F.col(f"`{c}`") for c in columns]))


def canonical_text(body: Column) -> Column:
    """The canonical text of JSON text; NaN and Infinity, which some senders write, are null. Null, and what isn't JSON, is null."""
    ship_package(SparkSession.active())
    return _canonical_text(body)
