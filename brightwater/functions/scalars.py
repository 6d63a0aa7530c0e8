"""Scalar rules of the data model as native columns: missing values, conversions, keys and hashes.

ANSI mode raises on bad casts, so every conversion that can meet dirty input is a ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that stand for a missing value, true and false.
MISSING = ["-", "", "N/A", "n/a", "None", "null"]
TRUE, FALSE = ["true", "yes", "1"], ["false", "no", "0"]
# Kind to Spark type of a typed column.
KINDS = {"price": "decimal(28,12)", "fact": "decimal(38,10)", "big": "decimal(38,0)", "count": "bigint", "flag": "boolean", "text": "string"}


def is_missing(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(MISSING)


def is_missing_number(x: Column) -> Column:
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def to_text(text: Column, longest: int | None = None) -> Column:
    out = F.when(~is_missing(text), F.trim(text))
    return F.substring(out, 1, longest) if longest else out


def symbol(text: Column) -> Column:
    return F.upper(F.trim(text))


def to_long(text: Column) -> Column:
    """Whole numbers only: a string with a fraction gives null."""
    return F.when(~is_missing(text) & F.trim(text).rlike(r"^[+-]?\d+$"), F.trim(text).try_cast("bigint"))


def whole(x: Column) -> Column:
    """A double cut off at the point; not finite gives null."""
    return F.when(~is_missing_number(x), x).try_cast("bigint")


def to_flag(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t.isin(TRUE), True).when(t.isin(FALSE), False)


def number_flag(x: Column) -> Column:
    """The truth value of a number: whether it isn't 0; a missing one (null, NaN) has none."""
    return F.when(~is_missing_number(x.cast("double")), x != 0)


def to_price(x: Column) -> Column:
    """By the shortest digits that give the double back."""
    return F.when(~is_missing_number(x), x.cast("string").try_cast(KINDS["price"]))


def to_fact(x: Column) -> Column:
    """Half to even at ten places."""
    return F.bround(x.try_cast("decimal(38,18)"), 10).try_cast(KINDS["fact"])


def to_big(x: Column) -> Column:
    return F.bround(x.try_cast("decimal(38,10)"), 0).try_cast(KINDS["big"])


def float_price(x: Column) -> Column:
    """The shortest decimal that gives the 32-bit float back."""
    return x.cast("float").cast("string").try_cast(KINDS["price"])


def from_epoch(x: Column, unit: str = "s") -> Column:
    return F.timestamp_seconds(x) if unit == "s" else F.timestamp_millis(x)


def local_date(ts: Column, zone: Column | str) -> Column:
    """The calendar day of an instant at an exchange."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def midnight(day: Column, zone: Column | str) -> Column:
    """The instant at which a day begins at an exchange; a midnight that a clock change skips moves forward."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def short_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def person_name(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def key_text(text: Column, longest: int) -> Column:
    """Null where a key is empty or too long; such rows are dropped, never cut."""
    t = blank_to_null(text)
    return F.when(F.length(t) <= longest, t)


def writable_symbol(text: Column) -> Column:
    return (F.length(text) <= 32) & (F.octet_length(text) == F.length(text))


def slug(text: Column) -> Column:
    return F.translate(F.lower(F.trim(text)), " -", "__")


def topic(prefix: str, exchange: Column) -> Column:
    name = F.coalesce(blank_to_null(F.upper(exchange)), F.lit("unknown"))
    return F.substring(F.concat(F.lit(prefix), F.regexp_replace(name, r"[^A-Za-z0-9._-]", "_")), 1, 249)


def split_ratio(new: Column, old: Column) -> Column:
    return F.when((new > 0) & (old > 0), new / old)


def bucket_of(ts: Column, seconds: int) -> Column:
    """The start of the interval of ``seconds`` that holds an instant."""
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / seconds) * seconds)


def trim_decimal(x: Column) -> Column:
    text = x.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def heat(x: Column, span: float) -> Column:
    return F.signum(x) * F.least(F.lit(1.0), F.abs(x) / span)


def margin(net: Column, revenue: Column) -> Column:
    return F.when(revenue > 0, net / revenue * 100)


def linear(x: Column, low: Column, high: Column, start: float, end: float) -> Column:
    """Not clamped; a span of 0 gives the middle."""
    return F.when(high == low, (start + end) / 2).otherwise(start + (x - low) / F.nullif(high - low, F.lit(0.0)) * (end - start))


# Session codes, exit codes, and patterns of error texts by kind (the first that fits counts).
MARKET_HOURS = {0: "pre", 1: "regular", 2: "post", 3: "extended"}
REGULAR = 1
EXIT_WORDS = {0: "ok", 2: "partial", 4: "locked"}
ERRORS = {"rate_limited": r"(?i)\b429\b|too many requests|rate.?limit", "timeout": r"(?i)tim(?:ed|e)[ -]?out", "not_found": r"(?i)\b404\b|not found|delisted",
          "parse": r"(?i)decode|expecting value|malformed", "connection": r"(?i)connection|reset by peer|ssl|proxy"}


def instant(text: Column) -> Column:
    """With a zone or without (then UTC); a date is its midnight; anything else is null."""
    return F.try_to_timestamp(F.trim(text))


def day_of_text(text: Column) -> Column:
    """The calendar day that a text names, without a shift of zone."""
    return F.substring(F.trim(text), 1, 10).try_cast("date")


def epoch_within(x: Column, unit: str = "s") -> Column:
    """An instant between 1970 and 2100, else null."""
    most = 4_102_444_800 * (1 if unit == "s" else 1000)
    return from_epoch(F.when(x.between(0, most), x), unit)


def epoch_or_instant(text: Column) -> Column:
    number = F.trim(text).try_cast("bigint")
    return F.when(number.isNotNull(), epoch_within(number)).otherwise(instant(text))


def named(code: Column, names: dict) -> Column:
    """The name of a code, null where it has none."""
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[code]


def is_extended_session(code: Column) -> Column:
    return code != REGULAR


def unwrap(text: Column) -> Column:
    """The raw value of an envelope, or the text itself where it is no object."""
    return F.when(text.startswith("{"), F.get_json_object(text, "$.raw")).otherwise(text)


def url_of(text: Column) -> Column:
    return F.when(text.startswith("{"), F.get_json_object(text, "$.url")).otherwise(text)


def thumbnail(pictures: Column) -> Column:
    """The address of the picture tagged original, else of the first."""
    parsed = F.from_json(pictures, "array<struct<tag:string,url:string>>")
    return F.coalesce(F.get(F.filter(parsed, lambda p: p["tag"] == "original"), F.lit(0))["url"], F.get(parsed, F.lit(0))["url"])


def accession(url: Column, day: Column, kind: Column, title: Column) -> Column:
    found = F.regexp_extract(url, r"(\d{10}-\d{2}-\d{6})", 1)
    return F.when(found != "", found).otherwise(F.substring(F.sha2(F.concat_ws("|", day.cast("string"), kind, title), 256), 1, 32))


def period_of(label: Column) -> Column:
    return F.nullif(F.regexp_extract(label, r"Insider Purchases Last (\S+)", 1), F.lit(""))


def rescale_factors(ratio: Column) -> tuple[Column, Column]:
    """(for prices, for volumes) of a decimal ratio; null where it is not above 0."""
    good = F.when(ratio > 0, ratio)
    return F.lit(1).cast("decimal(28,12)") / good, good


def valid_symbol(text: Column) -> Column:
    return text.rlike(r"^[A-Z0-9.^=-]{1,32}$")


def exchange(text: Column) -> Column:
    return F.coalesce(blank_to_null(F.upper(text)), F.lit("UNKNOWN"))


def nice_step(low: Column, high: Column, most: int) -> Column:
    raw = (high - low) / most
    size = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    share = raw / size
    return F.when(share <= 1, 1.0).when(share <= 2, 2.0).when(share <= 2.5, 2.5).when(share <= 5, 5.0).otherwise(10.0) * size


def nice_ticks(low: Column, high: Column, step: Column) -> Column:
    """All multiples of a step within a range; empty where there is none."""
    first, last = F.ceil(low / step), F.floor(high / step)
    return F.when(first <= last, F.transform(F.sequence(first, F.greatest(first, last)), lambda k: k * step)).otherwise(F.array().cast("array<double>"))


def clipped(x: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """(the value within its bounds, whether it lies below or above them)."""
    return F.least(F.greatest(x, low), high), F.when(x < low, "below").when(x > high, "above")


def error_kind(text: Column) -> Column:
    out = F.lit("other")
    for kind, pattern in reversed(ERRORS.items()):
        out = F.when(text.rlike(pattern), kind).otherwise(out)
    return out


def age_seconds(now: Column, then: Column) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(then)


def warn_from(today: Column, depth_days: Column, ahead: int) -> Column:
    return F.date_sub(today, F.greatest(depth_days - ahead, F.lit(0)))


def label_key(labels: Column) -> Column:
    """A map of labels as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(labels))))


def misfire_grace(cadence: Column, configured: int) -> Column:
    return F.greatest(F.lit(1), F.least(F.floor(cadence / 2), F.lit(configured))).cast("long")
