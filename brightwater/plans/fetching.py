"""Which bars to fetch, over every symbol and interval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series
from ..operators.fetch_plan import LIMITS, plan_fetches
from .registry import query, table

#: Each kind of event stands for the bars of one interval; monthly bars have none stored.
STORED = {"view": "1m", "click": "5m", "purchase": "15m", "signup": "60m", "error": "1wk"}

_LIMITS = ", ".join(f"('{i}', {'NULL::INT' if per is None else per}, {'NULL::INT' if depth is None else depth})" for i, (per, depth) in LIMITS.items())
_STORED = ", ".join(f"('{k}', '{i}')" for k, i in STORED.items())


@query("win_17_fetch_windows", f"""
    WITH lim(bar_interval, per, depth) AS (VALUES {_LIMITS}), k(event_type, bar_interval) AS (VALUES {_STORED}), e AS (SELECT user_id AS symbol, bar_interval, ts FROM events JOIN k USING (event_type)),
    w AS (SELECT symbol, bar_interval, max(ts) AS watermark FROM e GROUP BY ALL),
    g AS (SELECT symbol, bar_interval, ts AS gap_start, nxt AS gap_end FROM (SELECT *, lead(ts) OVER (PARTITION BY symbol, bar_interval ORDER BY ts) AS nxt FROM e) WHERE epoch(nxt)::BIGINT - epoch(ts)::BIGINT > 432000),
    s AS (SELECT c_custkey AS symbol, lim.*, DATE '2024-02-10' + (c_custkey % 90)::INT AS today, CASE WHEN c_custkey % 7 = 0 THEN DATE '2024-01-10' END AS f, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 14 = 7 THEN DATE '2024-03-20' END AS t FROM customer, lim),
    m AS (SELECT s.*, watermark, today - depth AS earliest, CASE WHEN f IS NOT NULL OR t IS NOT NULL THEN 'explicit' WHEN watermark IS NOT NULL THEN 'on' WHEN depth IS NULL THEN 'all' ELSE 'first' END AS mode FROM s LEFT JOIN w USING (symbol, bar_interval)),
    r AS (SELECT symbol, bar_interval, per, CASE mode WHEN 'explicit' THEN coalesce(f, today - 2) WHEN 'first' THEN earliest ELSE greatest(watermark::DATE - 2, coalesce(earliest, DATE '1970-01-01')) END AS a, CASE WHEN mode = 'explicit' THEN coalesce(t, today) ELSE today END AS b FROM m WHERE mode <> 'all'
          UNION ALL SELECT symbol, bar_interval, per, gap_start::DATE, least(gap_end::DATE + 1, today) FROM m JOIN g USING (symbol, bar_interval) WHERE mode = 'on' AND gap_start::DATE >= coalesce(earliest, DATE '1970-01-01')),
    n AS (SELECT *, coalesce((a > max(b) OVER v)::INT, 1) AS new FROM r WHERE a < b WINDOW v AS (PARTITION BY symbol, bar_interval ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    i AS (SELECT *, sum(new) OVER (PARTITION BY symbol, bar_interval ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM n),
    j AS (SELECT symbol, bar_interval, per, min(a) AS a, max(b) AS b FROM i GROUP BY symbol, bar_interval, per, island)
    SELECT symbol, bar_interval, 'window' AS kind, (a + (k * coalesce(per, 0))::INT)::TIMESTAMP AS range_start, least(a + ((k + 1) * per)::INT, b)::TIMESTAMP AS range_end FROM j, LATERAL (SELECT unnest(generate_series(0, CASE WHEN per IS NULL THEN 0 ELSE (b - a - 1) // per END)) AS k)
    UNION ALL SELECT symbol, bar_interval, 'expired', watermark, earliest::TIMESTAMP FROM m WHERE mode = 'on' AND watermark::DATE - 2 < earliest
    UNION ALL SELECT symbol, bar_interval, 'all', NULL, NULL FROM m WHERE mode = 'all'""")
def fetch_windows(spark, d):
    """First fills, continued, explicit and expired ranges, and open gaps of more than five days, of all symbols at once."""
    kinds = F.create_map(*[F.lit(x) for pair in STORED.items() for x in pair])
    stored = table(spark, d, "events").select(F.col("user_id").alias("symbol"), kinds[F.col("event_type")].alias("bar_interval"), "ts").filter("bar_interval IS NOT NULL")
    marks = stored.groupBy("symbol", "bar_interval").agg(F.max("ts").alias("watermark"))
    key, day = F.col("symbol"), lambda x: F.lit(x).cast("date")
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("symbol"), F.explode(F.array(*map(F.lit, LIMITS))).alias("bar_interval"))
    asked = asked.withColumns({"today": F.date_add(day("2024-02-10"), (key % 90).cast("int")), "from_day": F.when(key % 7 == 0, day("2024-01-10")), "to_day": F.when((key % 11 == 0) | (key % 14 == 7), day("2024-03-20"))})
    gaps = series.gaps(stored, ["symbol", "bar_interval"], "ts", 432_000)
    return plan_fetches(asked.join(marks, ["symbol", "bar_interval"], "left"), gaps)
