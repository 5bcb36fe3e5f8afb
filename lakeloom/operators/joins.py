"""Joins by key, as the metadata jobs use them. No side is broadcast by hint: adaptive execution does so by measured size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unknown(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Candidates whose key isn't known; null keys stay."""
    return candidates.join(known.select(key), key, "left_anti")


def known_only(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is known, each once."""
    return rows.join(known.select(key), key, "left_semi")


def with_dictionary(rows: DataFrame, dictionary: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """``rows`` with the dictionary's attributes named in ``defaults``, and the default where an entry or a value is missing."""
    attributes = dictionary.select(*keys, *(F.col(c).alias(f"_d_{c}") for c in defaults))
    joined = rows.join(attributes, keys, "left")
    return joined.select(*rows.columns, *(F.coalesce(F.col(f"_d_{c}"), F.lit(v)).alias(c) for c, v in defaults.items()))


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children without a parent."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def strict_inner(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children with their parent's columns; a child without one fails the job when its row is read."""
    p = parents.select(F.col(parent_key).alias("_pk"), *(c for c in parents.columns if c != parent_key and c not in children.columns))
    joined = children.join(p, F.col(child_key) == F.col("_pk"), "left")
    checked = F.when(F.col("_pk").isNull(), F.raise_error(F.concat(F.lit("no parent for "), F.coalesce(F.col(child_key).cast("string"), F.lit("null"))))).otherwise(F.col(child_key))
    return joined.withColumn(child_key, checked.cast(dict(children.dtypes)[child_key])).drop("_pk")


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys on both sides, only left, only right."""
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    each = sides.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    return each.agg(
        count((F.col("l") == 1) & (F.col("r") == 1)).alias("both"),
        count((F.col("l") == 1) & (F.col("r") == 0)).alias("left_only"),
        count((F.col("l") == 0) & (F.col("r") == 1)).alias("right_only"),
    )


def lookup_cascade(rows: DataFrame, key: str, places: list[tuple[str, DataFrame]], fallback: Column) -> DataFrame:
    """``rows`` with ``place``: the name of the first of ``places`` that has the key, else ``fallback``."""
    found = F.lit(None).cast("string")
    out = rows
    for i, (name, ids) in enumerate(places):
        out = out.join(ids.select(key).distinct().withColumn(f"_in{i}", F.lit(True)), key, "left")
        found = F.coalesce(found, F.when(F.col(f"_in{i}"), F.lit(name)))
    return out.select(*rows.columns, F.coalesce(found, fallback).alias("place"))


def stale(current: DataFrame, marks: DataFrame, key: str, at: str) -> DataFrame:
    """Rows of ``current`` whose key has no mark or an older one."""
    old = marks.select(F.col(key).alias("_mk"), F.col(at).alias("_mark"))
    met = current.join(old, F.col(key) == F.col("_mk"), "left")
    return met.where(F.col("_mk").isNull() | F.col("_mark").isNull() | (F.col("_mark") < F.col(at))).select(*current.columns)


def rename_map(tags: DataFrame, mapping: DataFrame, tag: str = "tag", target: str = "target") -> DataFrame:
    """``tags`` with names replaced by the mapping's target where it has one."""
    m = mapping.select(F.col(tag).alias("_from"), F.col(target).alias("_to"))
    joined = tags.join(m, F.col(tag) == F.col("_from"), "left")
    return joined.select(*(F.coalesce("_to", tag).alias(tag) if c == tag else F.col(c) for c in tags.columns))
