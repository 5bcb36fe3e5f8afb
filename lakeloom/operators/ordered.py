"""Numbering, running sums and streaks over a whole table, without one task that holds it.

Spark deals the rows into ranges of the whole order (it samples for the cuts, so nothing
of the data comes into the plan) and sorts each. The dealt table is written once to the
shared folder: Spark draws other samples when a plan is worked out again, so only rows
that stay where they are can be counted first and numbered after. A row's place in its
range is then known from where it lies; what the earlier ranges add up to is a row for
each range, which is broadcast. Running values go through each range once, in its order.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpointed


def dealt(df: DataFrame, order: list[str], descending: bool = False, ranges: int | None = None) -> DataFrame:
    """``df``, written once, with ``_range`` and ``_at``: a row's range in the given order and its place there, from 1.

    Nulls come last in each column; ``descending`` turns the first one round. A partition
    is a range, its rows in order. Without ``ranges`` there are as many as Spark deals a
    shuffle into. Rows that agree in all of ``order`` are in one range.
    """
    keys = [F.col(order[0]).desc_nulls_last() if descending else F.col(order[0]).asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in order[1:])]
    placed = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return checkpointed(placed.sortWithinPartitions(*keys).withColumns({"_range": F.spark_partition_id(), "_at": within}))


def _earlier(totals: DataFrame, **values: Column) -> DataFrame:
    """``_range`` with ``values`` over all ranges before; a row for each range."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select("_range", *(v.over(before).alias(name) for name, v in values.items())))


def _accumulated(df: DataFrame, columns: dict[str, np.ufunc]) -> DataFrame:
    """``df`` (of ``dealt``) with each of ``columns``, a long or double without nulls, accumulated through its range."""
    schema = df.schema

    def task(batches):
        carried: dict = {}
        for batch in batches:
            made = []
            for field in schema:
                values = batch.column(field.name)
                if field.name in columns and len(values):
                    run, of = columns[field.name], values.to_numpy(zero_copy_only=False)
                    if field.name in carried:
                        of = of.copy()
                        of[0] = run(of[0], carried[field.name])
                    out = run.accumulate(of)
                    carried[field.name] = out[-1]
                    values = pa.array(out, values.type)
                made.append(values)
            yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return df.mapInArrow(task, schema)


def running(df: DataFrame, order: list[str], sums: dict[str, Column], descending: bool = False, ranges: int | None = None) -> DataFrame:
    """``df`` with, for each of ``sums`` (whole or floating numbers), the running total up to and with the row.

    ``order`` must be a total order. Nulls add nothing. An empty table stays empty.
    """
    kept = {f"_v{i}": name for i, name in enumerate(sums)}
    kinds = dict(df.select(*(c.alias(v) for v, c in zip(kept, sums.values(), strict=True))).dtypes)
    wide = {v: "double" if kinds[v] in ("float", "double") or kinds[v].startswith("decimal") else "bigint" for v in kept}
    values = {v: F.coalesce(c.cast(wide[v]), F.lit(0).cast(wide[v])) for v, c in zip(kept, sums.values(), strict=True)}
    placed = dealt(df.withColumns(values), order, descending, ranges)
    before = _earlier(placed.groupBy("_range").agg(*(F.sum(v).alias(v) for v in kept)), **{f"_b{v}": F.sum(v) for v in kept})
    made = _accumulated(placed, dict.fromkeys(kept, np.add)).join(before, "_range")
    return made.select(*df.columns, *((F.col(v) + F.coalesce(F.col(f"_b{v}"), F.lit(0).cast(wide[v]))).alias(name) for v, name in kept.items()))


def numbered(df: DataFrame, order: list[str], name: str = "n", base: int = 0, descending: bool = False, ranges: int | None = None) -> DataFrame:
    """``df`` with ``name``: ``base`` + 1, 2, … in the given total order."""
    placed = dealt(df, order, descending, ranges)
    before = _earlier(placed.groupBy("_range").agg(F.count("*").alias("n")), _before=F.sum("n"))
    return placed.join(before, "_range").select(*df.columns, (F.col("_at") + F.coalesce("_before", F.lit(0)) + F.lit(base)).cast("long").alias(name))


def chunked(df: DataFrame, order: list[str], size: int, name: str = "chunk") -> DataFrame:
    """``df`` with the number, from 0, of the chunk of ``size`` rows that a row is in."""
    if size <= 0:
        raise ValueError("a chunk needs one row at least")
    return numbered(df, order, name).withColumn(name, F.floor((F.col(name) - 1) / size).cast("long"))


def streaks(df: DataFrame, order: list[str], hit: Column, name: str = "streak", ranges: int | None = None) -> DataFrame:
    """``df`` with the length so far of the run of rows for which ``hit`` holds; 0 where it doesn't."""
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    # The place of the last row so far that is no hit: in the range, or else in those before.
    placed = dealt(marked, order, ranges=ranges).withColumn("_last", F.when(F.col("_hit"), 0).otherwise(F.col("_at")).cast("long"))
    totals = placed.groupBy("_range").agg(F.count("*").alias("n"), F.max("_last").alias("last"))
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = totals.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    before = _earlier(whole.withColumn("last", F.when(F.col("last") > 0, F.col("last") + F.col("_before"))), _number=F.sum("n"), _broken=F.max("last"))
    made = _accumulated(placed, {"_last": np.maximum}).join(before, "_range")
    carried = F.coalesce("_number", F.lit(0)) - F.coalesce("_broken", F.lit(0))
    return made.select(*df.columns, (F.col("_at") - F.when(F.col("_last") > 0, F.col("_last")).otherwise(-carried)).cast("long").alias(name))


def ordered_union(*frames: DataFrame) -> DataFrame:
    """Frames one below the other with ``_source``, the place of each in the list."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)))
