"""Points in time, durations and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = (("w", 604800), ("d", 86400), ("h", 3600), ("m", 60), ("s", 1))
_UNIT_WORDS = {"w": "w(?:ee)?ks?|w", "d": "days?|d", "h": "h(?:ou)?rs?|h", "m": "min(?:ute)?s?|mins?|m", "s": "sec(?:ond)?s?|secs?|s"}
NO_LIMIT = ("", "none", "null", "nil", "unlimited", "infinite", "infinity", "inf")


def iso_epoch(text: Column) -> Column:
    """ISO-8601 text with offset or ``Z`` to seconds with fractions; unreadable text is null."""
    return F.unix_micros(F.try_to_timestamp(F.when(F.trim(text) != "", text))) / F.lit(1e6)


def loose_epoch(text: Column, formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "dd MMM yyyy", "MMM d, yyyy")) -> Column:
    """The first of ISO-8601 and ``formats`` that reads the text."""
    tried = [iso_epoch(text), *(F.unix_micros(F.try_to_timestamp(text, F.lit(f))) / F.lit(1e6) for f in formats)]
    return F.coalesce(*tried)


def duration_seconds(text: Column, allow_none: bool = False) -> Column:
    """``5h``, ``48min``, ``2d``, ``1h30m`` to seconds; other text raises when evaluated."""
    low = F.lower(F.trim(text))
    shape = r"^\s*" + "".join(rf"(?:(\d+(?:\.\d+)?)\s*(?:{_UNIT_WORDS[u]})\s*)?" for u, _ in _UNITS) + "$"
    parts = [F.coalesce(F.regexp_extract(low, shape, i + 1).try_cast("double"), F.lit(0.0)) * size for i, (_, size) in enumerate(_UNITS)]
    total = parts[0] + parts[1] + parts[2] + parts[3] + parts[4]
    bare = low.rlike(r"^\d+(\.\d+)?$")
    found = F.when(bare, low.try_cast("double")).when(low.rlike(shape) & (low != ""), total)
    bad = F.raise_error(F.concat(F.lit("not a duration: "), F.coalesce(text, F.lit("null")))).cast("double")
    if allow_none:
        found = F.when(text.isNull() | low.isin(*NO_LIMIT), F.lit(None).cast("double")).otherwise(F.coalesce(found, bad))
        return found
    return F.coalesce(found, bad)


def utc_parts(ts: Column) -> tuple[Column, Column]:
    """``YYYYMM`` and ``YYYYMMDD``."""
    return F.date_format(ts, "yyyyMM"), F.date_format(ts, "yyyyMMdd")


def settled(ts: Column, hold: str, asof: Column) -> Column:
    """Whether a row is older than ``hold`` at ``asof``; rows without a time pass."""
    return ts.isNull() | (ts + F.expr(f"INTERVAL {hold}") <= asof)


def calendar_month(days: DataFrame, day: str, value: str) -> DataFrame:
    """Rows of weeks with a column for each weekday: ``month``, ``week`` (its Monday), ``mon`` to ``sun``."""
    names = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
    placed = days.select(F.date_format(day, "yyyy-MM").alias("month"), F.to_date(F.date_trunc("week", day)).alias("week"), F.weekday(day).alias("wd"), F.col(value).alias("v"))
    return placed.groupBy("month", "week").agg(*(F.sum(F.when(F.col("wd") == i, F.col("v"))).alias(n) for i, n in enumerate(names)))
