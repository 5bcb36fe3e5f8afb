"""Null-protected incremental upserts.

A fetched batch is merged into a stored table by key. A null never overwrites a
value; empty text, false, zero and empty arrays do. Which changes count is said by
trigger columns, compared null-safely; arrays named in ``unordered`` compare as
sorted. Everything is one full outer join on the key, so it shuffles each side
once (or not at all where both are bucketed by the key).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import keep_first


@dataclass(frozen=True)
class UpsertSpec:
    """``key``; the ``triggers`` whose change counts; which of them are ``unordered`` lists."""

    key: str
    triggers: tuple[str, ...]
    unordered: tuple[str, ...] = field(default=())


def merge_value(new: Column, old: Column) -> Column:
    """The new value unless it is null."""
    return F.coalesce(new, old)


def _normal(df: DataFrame, spec: UpsertSpec, column: str, value: Column) -> Column:
    """A trigger's value in comparable form; a column that the table lacks is null."""
    kind = next((f.dataType for f in df.schema if f.name == column), None)
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(value))
    if column in spec.unordered and isinstance(kind, T.ArrayType):
        return F.array_sort(value)
    return value


def signature(df: DataFrame, spec: UpsertSpec) -> DataFrame:
    """``key`` and ``signature``: a digest of the trigger columns that can be stored; nulls and empty values differ."""
    parts = [_normal(df, spec, c, F.col(c)).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in spec.triggers]
    return df.select(spec.key, F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256).alias("signature"))


def _sides(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Both tables side by side as structs ``o`` and ``n`` (null where a side has no row)."""
    o = stored.select(F.col(spec.key).alias("_ko"), F.struct(*stored.columns).alias("o"))
    n = fetched.select(F.col(spec.key).alias("_kn"), F.struct(*fetched.columns).alias("n"))
    return o.join(n, F.col("_ko") == F.col("_kn"), "full_outer")


def _merged(stored: DataFrame, fetched: DataFrame) -> list[Column]:
    """The stored table's columns after the merge; a column that the batch lacks keeps its value."""
    kinds = {f.name: f.dataType for f in stored.schema}
    return [(merge_value(F.col(f"n.`{c}`").try_cast(kinds[c]), F.col(f"o.`{c}`")) if c in fetched.columns else F.col(f"o.`{c}`")).alias(c) for c in stored.columns]


def apply_updates(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec) -> DataFrame:
    """The stored table after the merge: matched rows updated, others inserted or kept; its schema stays.

    The batch must have one row for a key (see ``dedup.keep_last``). Columns that
    the stored table lacks are dropped. Null keys never match.
    """
    return _sides(stored, fetched, spec).select(*_merged(stored, fetched))


def merge_rows(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Only the batch's rows, each merged with its stored row."""
    return _sides(stored, fetched, spec).where(F.col("_kn").isNotNull()).select(*_merged(stored, fetched))


def _differs(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec, merged: bool) -> Column:
    """Whether a trigger differs between the stored row and the new (or merged) one."""
    out = F.lit(False)
    kinds = {f.name: f.dataType for f in stored.schema}
    for c in spec.triggers:
        old = F.col(f"o.`{c}`") if c in stored.columns else F.lit(None)
        new = F.col(f"n.`{c}`") if c in fetched.columns else F.lit(None)
        if c in kinds:
            new = new.try_cast(kinds[c])
        if merged:
            new = merge_value(new, old)
        out = out | ~_normal(stored, spec, c, old).eqNullSafe(_normal(stored, spec, c, new))
    return out


def classify(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec, need_gain: bool = True, sealed: DataFrame | None = None) -> DataFrame:
    """Each of the batch's keys with ``action``: new, updated, unchanged, no_gain or sealed.

    ``no_gain``: a trigger differs (a value became null), but the merge changes
    nothing; with ``need_gain`` off such rows count as updated. ``sealed`` lists
    keys that no longer change.
    """
    rows = _sides(stored, fetched, spec).where(F.col("_kn").isNotNull())
    known = F.col("_ko").isNotNull()
    action = F.when(~known, "new").when(~_differs(stored, fetched, spec, merged=False), "unchanged")
    if need_gain:
        action = action.when(~_differs(stored, fetched, spec, merged=True), "no_gain")
    out = rows.select(F.col("_kn").alias(spec.key), action.otherwise("updated").alias("action"))
    if sealed is None:
        return out
    closed = sealed.select(spec.key).distinct().withColumn("_sealed", F.lit(True))
    return out.join(closed, spec.key, "left").select(spec.key, F.when(F.col("_sealed"), "sealed").otherwise(F.col("action")).alias("action"))


def unchanged(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Keys of the batch that are stored with equal triggers."""
    return classify(stored, fetched, spec, need_gain=False).where("action = 'unchanged'").select(spec.key)


def adds_anything(stored: DataFrame, fetched: DataFrame, spec: UpsertSpec) -> DataFrame:
    """Keys of the batch whose merge would change the stored triggers, new keys included."""
    return classify(stored, fetched, spec).where("action in ('new', 'updated')").select(spec.key)


def run_stats(actions: DataFrame) -> DataFrame:
    """Rows for each action."""
    return actions.groupBy("action").agg(F.count("*").alias("n"))


def replace(stored: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """New rows win whole, nulls included; columns of either side are kept."""
    both = fetched.withColumn("_priority", F.lit(0)).unionByName(stored.withColumn("_priority", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, [key], ["_priority"]).drop("_priority")


def url_changes(stored: DataFrame, fetched: DataFrame, key: str, url: str) -> DataFrame:
    """Rows of the batch whose key is unseen or whose ``url`` differs from the stored one."""
    old = stored.select(F.col(key).alias("_key"), F.col(url).alias("_url"))
    met = fetched.join(old, F.col(key) == F.col("_key"), "left")
    return met.where(F.col("_key").isNull() | ~F.col(url).eqNullSafe(F.col("_url"))).select(*fetched.columns)


def replace_changed_urls(stored: DataFrame, fetched: DataFrame, key: str, url: str) -> DataFrame:
    """The stored table with the rows of ``url_changes`` in place of its own."""
    return replace(stored, url_changes(stored, fetched, key, url), key)


def insert_only(stored: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """The stored table and the batch's unseen keys; known keys are never touched."""
    return stored.unionByName(fetched.join(stored.select(key), key, "left_anti").select(*stored.columns))
