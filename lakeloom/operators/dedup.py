"""Which of several rows of a key stays. Every order given must be total within a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keep(df: DataFrame, keys: list[str], order: list[str], last: bool) -> DataFrame:
    """The extreme row of each key as a grouped aggregate: combined before the shuffle, so hot keys don't pile up.

    A null in ``order`` counts as less than any value.
    """
    ranks = [x for c in order for x in (F.col(c).isNotNull(), F.col(c))]
    rank = F.struct(*(r.alias(f"_{i}") for i, r in enumerate(ranks)))
    pick = (F.max_by if last else F.min_by)(F.struct(*df.columns), rank)
    return df.groupBy(*keys).agg(pick.alias("_row")).select("_row.*")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of greatest ``order`` of each key; null keys are one group."""
    return _keep(df, keys, order, True)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of least ``order`` of each key; null keys are one group."""
    return _keep(df, keys, order, False)


def last_write_wins(snapshots: list[DataFrame], key: str) -> DataFrame:
    """Rows of several snapshots, the latest snapshot's for each key."""
    from .ordered import ordered_union

    return keep_last(ordered_union(*snapshots), [key], ["_source"]).drop("_source")


def first_seen(items: DataFrame, key: str, at: str) -> DataFrame:
    """Each key with the least place at which it was seen."""
    return items.groupBy(key).agg(F.min(at).alias("first_seen"))


def nested_first(array: Column, by: str) -> Column:
    """An array of structs with the first struct of each value of field ``by``, in order."""
    empty = F.filter(array, lambda x: F.lit(False))
    return F.reduce(array, empty, lambda acc, x: F.when(F.exists(acc, lambda y: y[by].eqNullSafe(x[by])), acc).otherwise(F.concat(acc, F.array(x))))


def dropped_in_run(df: DataFrame, key: str) -> DataFrame:
    """Rows that a shifting listing served twice: one of each key, equal rows assumed."""
    return df.dropDuplicates([key])
