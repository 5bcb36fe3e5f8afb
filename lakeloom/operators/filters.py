"""Predicates that decide which records a job takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widest range of ids that a text may ask for.
WIDEST = 1_000_000


def recordable(deleted: Column, md5: Column) -> Column:
    """Neither deleted nor without a digest."""
    return ~F.coalesce(deleted, F.lit(False)) & (F.coalesce(md5, F.lit("")) != "")


def has_url(url: Column) -> Column:
    return F.trim(F.coalesce(url, F.lit(""))) != ""


def is_media(mimetype: Column, url: Column, family: str = "image/", others: bool = False) -> Column:
    """A non-empty url and, unless ``others`` are wanted, a media type of the family."""
    wanted = has_url(url)
    return wanted if others else wanted & F.coalesce(mimetype.startswith(family), F.lit(False))


def real_id(number: Column, sentinel: int = 10**9) -> Column:
    """Ids below the sentinel; null ids drop."""
    return number < F.lit(sentinel)


def not_value(column: Column, value: str) -> Column:
    """Other than ``value``; null counts as other."""
    return ~column.eqNullSafe(F.lit(value))


def below(number: Column, bound: int | None) -> Column:
    """A window's start: ids below the bound; without one, all."""
    return F.lit(True) if bound is None else number < F.lit(bound)


def id_ranges(lists: DataFrame, text: str = "ids") -> DataFrame:
    """Distinct ``id`` of texts such as ``100-105,200``; reversed, too wide and unreadable parts raise."""
    part = F.explode(F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != ""))
    parts = lists.select(part.alias("part"))
    lo = F.regexp_extract("part", r"^(\d{1,18})(?:\s*-\s*(\d{1,18}))?$", 1).try_cast("long")
    hi = F.coalesce(F.regexp_extract("part", r"^(\d{1,18})(?:\s*-\s*(\d{1,18}))?$", 2).try_cast("long"), lo)
    read = parts.select("part", lo.alias("lo"), hi.alias("hi"))
    bad = F.col("lo").isNull() | (F.col("hi") < F.col("lo")) | (F.col("hi") - F.col("lo") >= WIDEST)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a range of ids: "), F.col("part"))).cast("array<bigint>")).otherwise(F.sequence("lo", "hi"))
    return read.select(F.explode(checked).alias("id")).distinct()


def valid_object(body: Column) -> Column:
    """A body that is a non-empty JSON object; pages, arrays and empty bodies are not."""
    parsed = F.try_parse_json(F.when(~F.ltrim(body).startswith("<"), body))
    return F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT") & (F.schema_of_variant(parsed) != "OBJECT<>"), F.lit(False))
