"""What happens around writes: accounting, routing of changes, ledgers, snapshot and roster gates, switches of scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import canonical_text
from .gates import gate, row_hash
from .merge import WriteSpec, classified

# Family and partition column of the tables whose changes are published; others never are.
ROUTES = {"price_bars": ("bars", "symbol"), "orders": ("orders", "k"), "quotes": ("quotes", "symbol"), "news": ("news", "symbol")}


def aligned(parts: list[DataFrame]) -> DataFrame:
    """Ragged parts as one table: a column that a part lacks is null there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_status(attempted: Column, verified: Column, skipped: Column) -> Column:
    """The word for a write: nothing to do, all passed over, all there, or something missing."""
    return F.when((attempted == 0) & (skipped == 0), "empty").when(attempted == 0, "skipped").when(verified == attempted, "ok").otherwise("failed")


def routed(changes: DataFrame, table: Column) -> DataFrame:
    """Change rows with family and partition_col of their table; tables without a route aren't published."""
    of = lambda k: F.create_map(*[F.lit(x) for name, r in ROUTES.items() for x in (name, r[k])])[table]
    return changes.withColumn("family", of(0)).withColumn("partition_col", of(1)).filter("family IS NOT NULL")


def envelope(changes: DataFrame, dataset: str, table: str, run_id: str, occurred_at: Column) -> DataFrame:
    """Version 1 of a published change as one JSON text a row, and its partition key."""
    out = routed(changes, F.lit(table))
    head = F.to_json(F.struct(F.lit(1).alias("v"), "op", "family", F.lit(dataset).alias("dataset"), F.lit(table).alias("table"), F.lit(run_id).alias("run_id"), occurred_at.alias("occurred_at")), {"ignoreNullFields": "false"})
    # Key and row are JSON already, and stand in the body as what they are.
    body = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"key":'), F.coalesce("key", F.lit("null")), F.lit(',"row":'), F.coalesce("row", F.lit("null")), F.lit("}"))
    return out.select(F.call_function("get_json_object", F.col("key"), F.concat(F.lit("$."), F.col("partition_col"))).alias("partition_key"), canonical_text(body).alias("body"))


def purge(tables: dict[str, DataFrame], symbols: DataFrame) -> dict[str, DataFrame]:
    """Every table without the rows of the listed symbols."""
    return {name: df.join(symbols, "symbol", "left_anti") for name, df in tables.items()}


def purge_events(tables: dict[str, DataFrame], symbols: DataFrame, span_tables: set[str]) -> DataFrame:
    """What a purge publishes: a delete for each row, but one range without bounds for a symbol's bars."""
    out = None
    for name, df in tables.items():
        mine = df.join(symbols, "symbol", "left_semi")
        if name in span_tables:
            mine = mine.select("symbol").distinct().withColumn("op", F.lit("range"))
        else:
            mine = mine.select("symbol", F.lit("delete").alias("op"))
        mine = mine.withColumn("table", F.lit(name))
        out = mine if out is None else out.unionByName(mine)
    return out


def claim(ledger: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """What isn't in the ledger yet; writing it there claims it, so it is done exactly once."""
    return wanted.dropDuplicates(keys).join(ledger.select(*keys), keys, "left_anti")


def snapshot_gate(incoming: DataFrame, snapshot: DataFrame, identity: list[str], volatile: list[str], full_refresh: bool = False) -> DataFrame:
    """Rows that go to history: those whose hash differs from the snapshot's, read before the snapshot is updated."""
    gated = gate(row_hash(incoming, volatile), snapshot, identity, full_refresh)
    return gated.filter("gate != 'unchanged'")


def roster_gate(incoming: DataFrame, stored: DataFrame, roster: list[str], full_refresh: bool = False) -> DataFrame:
    """gate by roster. Only who stands at which rank counts; quotes that move leave a roster unchanged."""
    from .gates import group_hash

    of = lambda df: group_hash(df.select(*roster, "symbol", "rank_index"), roster)
    return gate(of(incoming), of(stored), roster, full_refresh)


def header_child(headers: DataFrame, children: DataFrame, old_headers: DataFrame, old_children: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(headers, children) after a write behind the hash gate.

    Unchanged headers get only ``fetched_at``, and their children stay; changed and new ones replace all children of theirs,
    even by none. Headers that don't come in stay as they are.
    """
    gated = gate(headers, old_headers, key)
    written = gated.filter("gate != 'unchanged'").select(*key)
    new_headers = classified(old_headers, headers, WriteSpec("headers", key)).select(*old_headers.columns)
    kept = old_children.join(written, key, "left_anti")
    return new_headers, kept.unionByName(children.join(written, key, "left_semi"))


def touched(target: DataFrame, incoming: DataFrame, spec: WriteSpec) -> DataFrame:
    """The target after a merge; ``event`` is null for rows of which only volatile columns moved."""
    out = classified(target, incoming, spec)
    return out.withColumn("event", F.when(F.col("_op").isin("insert", "update", "delete"), F.col("_op"))).drop("_op")


def intraday_universe(scope: DataFrame, symbols: DataFrame, interval: str) -> DataFrame:
    """Symbols of an interval: those enabled in the scope. Without any row of the interval it is nobody at 1m and everybody otherwise.

    Disabling keeps the row: a scope without rows would open the whole universe.
    """
    rows = scope.filter(F.col("bar_interval") == interval)
    if interval == "1m":
        return symbols.join(rows.filter("enabled").select("symbol"), "symbol", "left_semi")
    any_rows = rows.agg(F.count(F.lit(1)).alias("_n"))
    named = rows.filter("enabled").select("symbol").distinct().withColumn("_in", F.lit(True))
    return symbols.join(named, "symbol", "left").crossJoin(F.broadcast(any_rows)).filter((F.col("_n") == 0) | F.col("_in")).select(*symbols.columns)  # one row
