"""The incremental jobs as Structured Streaming: file streams in, a merged table out."""

from __future__ import annotations

import threading
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..operators import dedup, upsert
from .tables import MergedTable, listed


def upsert_stream(batches: DataFrame, table: MergedTable, spec: upsert.UpsertSpec, order: list[str], checkpoint: str, once: bool = True, first: int = 1):
    """Merges a stream of fetched rows into ``table``, micro-batch by micro-batch, as versions from ``first``; an earlier one must be there. The last row of a key in a batch counts."""

    def merge(batch: DataFrame, number: int) -> None:
        latest = dedup.keep_last(batch, [spec.key], order)
        table.merge(latest, number + first)

    writer = batches.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 minutes")).start()


def in_batches(stream: DataFrame, place: str, most_batches: int | None = None) -> int:
    """Rows of a stream to ``place``/out, and how many batches there are by now; the cursor is Spark's checkpoint in ``place``/state.

    A run ends with what is there, or once it has done ``most_batches`` (one that has begun
    by then is done too, or begins again in the next run). A batch that runs again
    replaces itself.
    """
    enough, done = threading.Event(), 0

    def keep(batch: DataFrame, number: int) -> None:
        nonlocal done
        batch.write.mode("overwrite").parquet(f"{place}/out/batch={number}")
        done += 1
        if most_batches is not None and done >= most_batches:
            enough.set()

    query = stream.writeStream.option("checkpointLocation", f"{place}/state").foreachBatch(keep).trigger(availableNow=True).start()
    while not enough.is_set() and not query.awaitTermination(0.1):
        pass
    if enough.is_set():
        query.stop()
    return len([n for n in listed(stream.sparkSession, f"{place}/out") if n.startswith("batch=")])


def through_files(df: DataFrame, place: str, job, parts: int = 4) -> DataFrame:
    """What the streaming ``job`` gives of the rows of ``df`` as they arrive in files, all read in one go."""
    spark = df.sparkSession
    df.repartition(parts).write.parquet(f"{place}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{place}/in")
    made = job(stream)
    made.writeStream.format("parquet").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start(f"{place}/out").awaitTermination()
    return spark.read.schema(made.schema).parquet(f"{place}/out")


def settle(stream: DataFrame, at: str, hold: str, asof: Column) -> DataFrame:
    """Rows that are old enough at ``asof``; rows without a time pass."""
    return stream.where(times.settled(F.col(at), hold, asof))


def once_in_run(stream: DataFrame, key: str, at: str, horizon: str = "1 hour") -> DataFrame:
    """Each key once among rows that arrive within ``horizon`` of one another; state is dropped behind the watermark."""
    return stream.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows of each window of event time and key; rows later than ``late`` are left out."""
    windows = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), key)
    return windows.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def retry_first(failed: DataFrame, fresh: DataFrame, key: str, wanted: bool = True) -> DataFrame:
    """What to fetch with its ``priority``: remembered failures (0) before new ids (1), each id once."""
    first = failed.select(key).distinct().withColumn("priority", F.lit(0))
    rest = fresh.select(key).distinct().withColumn("priority", F.lit(1))
    return first.unionByName(rest.join(first.select(key), key, "left_anti")) if wanted else rest.join(first.select(key), key, "left_anti")


def still_failed(failed: DataFrame, outcomes: DataFrame, key: str, ok: Column) -> DataFrame:
    """The dead letters after a run: the old ones and new failures, without what succeeded."""
    good = outcomes.where(ok).select(key)
    bad = outcomes.where(~ok).select(key)
    return failed.select(key).union(bad).distinct().join(good, key, "left_anti")


def adapted_rates(stream: DataFrame, key: str, ok: str, at: str, start: float = 4.0, step: float = 0.5, every: int = 25, cut: float = 0.7, least: float = 0.5, most: float = 64.0, cooldown: float = 2.0) -> DataFrame:
    """The request rate of each key as outcomes arrive; a key's state is three numbers. ``at`` is seconds."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step_on(key_: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        rate, run, cooled = state.get if state.exists else (start, 0, float("-inf"))
        rows = pd.concat(list(frames)).sort_values(at)
        for good, when in zip(rows[ok].tolist(), rows[at].tolist(), strict=True):
            if good:
                run += 1
                if run >= every:
                    rate, run = min(most, rate + step), 0
            elif when - cooled >= cooldown:
                rate, run, cooled = max(least, rate * cut), 0, when
        state.update((rate, run, cooled))
        yield pd.DataFrame({key: [key_[0]], "rate": [rate]})

    kind = dict(stream.dtypes)[key]
    return stream.select(key, ok, at).groupBy(key).applyInPandasWithState(step_on, f"{key} {kind}, rate double", "rate double, run int, cooled double", "update", GroupStateTimeout.NoTimeout)
