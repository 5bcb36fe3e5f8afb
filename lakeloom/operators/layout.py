"""How a table is laid out: shards, packed volumes, snapshots, and what guards a write."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import dealt, numbered, running


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt to as many tasks as a shuffle has or there are cores, for work that its files' bytes don't tell."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def shard_of(df: DataFrame, order: list[str], cap: int, sealed: int = 0, descending: bool = False) -> DataFrame:
    """``df`` with ``shard``: ``cap`` rows each in the given order, numbered behind the ``sealed`` ones."""
    placed = numbered(df, order, "_n", descending=descending)
    return placed.withColumn("shard", (F.floor((F.col("_n") - 1) / cap) + 1 + sealed).cast("long")).drop("_n")


def next_shard(rows_in_open: int, newest: int, cap: int, full_at_cap: bool = True) -> int:
    """Which shard a new run writes: the newest, or one more if it is full (at the cap, or only beyond it)."""
    return newest + 1 if (rows_in_open >= cap if full_at_cap else rows_in_open > cap) else newest


def next_shard_of(rows_in_open: Column, newest: Column, cap: int, full_at_cap: bool = True) -> Column:
    """``next_shard`` for many tables at once."""
    return newest + F.when(rows_in_open >= cap if full_at_cap else rows_in_open > cap, 1).otherwise(0)


def sealed_volumes(df: DataFrame, order: list[str], size: str, cap: int) -> DataFrame:
    """``df`` with ``written`` (bytes up to and with the row) and ``deferred``: rows that start when the cap was reached already."""
    made = running(df, order, {"written": F.coalesce(F.col(size), F.lit(0)).cast("long")})
    return made.withColumn("deferred", F.col("written") - F.coalesce(F.col(size), F.lit(0)) >= cap)


def pack_volumes(df: DataFrame, key: str, size: str, budget: int, max_files: int, ranges: int | None = None) -> DataFrame:
    """``df`` with ``volume``, from 0: sequential greedy packing in the order of the unique numeric ``key``.

    A new volume starts when the present one isn't empty and has ``max_files`` files
    or would exceed ``budget`` bytes; a null size is 0; a larger item is alone.

    The fold is sequential, but where a range of keys continues depends on what is
    open when it begins. So each range is packed once for every place where its
    first new volume can start (at most ``max_files`` places, by one backward
    pass); these summaries are then walked range by range, one range's at a time,
    and each range is packed for good from the state it begins with. No task holds
    more than a range, the driver no more than one range's summary. Ranges are those of
    ``ordered.dealt``, so a range is what one task of Spark's shuffle gets.
    """
    names, key_type = df.columns, df.schema[key].dataType
    items = dealt(df.select(F.col(key).alias("_k"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_s")), ["_k"], ranges=ranges)

    def read(batches: Iterator[pa.RecordBatch]) -> tuple[int, pa.ChunkedArray, np.ndarray] | None:
        """A range: its number, keys and sizes, in order."""
        held = [b for b in batches if b.num_rows]
        if not held:
            return None
        whole = pa.Table.from_batches(held)
        return whole.column("_range")[0].as_py(), whole.column("_k"), whole.column("_s").to_numpy().astype(np.int64)

    def jumps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums, and for a volume that starts at i where the next starts (the end, if not here)."""
        upto = np.concatenate([[0], np.cumsum(sizes)])
        n = len(sizes)
        by_bytes = np.searchsorted(upto, upto[:-1] + budget, side="right") - 1
        return upto, np.minimum(np.minimum(np.maximum(by_bytes, np.arange(n) + 1), np.arange(n) + max_files), n)

    def first_start(upto: np.ndarray, files: int, held: int) -> int:
        """Where the first new volume starts if ``files`` files of ``held`` bytes are open."""
        if not files:
            return 0
        n = len(upto) - 1
        by_bytes = int(np.searchsorted(upto, budget - held, side="right")) - 1
        return max(0, min(by_bytes, max_files - files, n))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (whole := read(batches)) is None:
            return
        r, _, sizes = whole
        upto, after = jumps(sizes)
        n = len(sizes)
        last, count = np.arange(n + 1), np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            last[i], count[i] = (i, 1) if after[i] >= n else (last[after[i]], count[after[i]] + 1)
        window = min(n, max_files)
        # From each place: how many volumes start, and what is open at the end.
        at = np.arange(window + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(window + 1, r)), pa.array(np.full(window + 1, n)), pa.array(at), pa.array(upto[at]), pa.array(count[at]), pa.array(n - last[at]), pa.array(upto[n] - upto[last[at]]), pa.array(np.full(window + 1, upto[n]))],
            names=["r", "n", "at", "upto", "volumes", "files", "held", "all"],
        )

    summary = items.mapInArrow(summarise, "r long, n long, at long, upto long, volumes long, files long, held long, all long")
    state: dict[int, tuple[int, int, int]] = {}
    files = held = volume = 0  # volume: how many have started
    group: list = []

    def walk(rows: list) -> None:
        nonlocal files, held, volume
        state[rows[0]["r"]] = (files, held, volume)
        upto = np.array([x["upto"] for x in rows])
        at = first_start(upto, files, held)
        if at < len(rows) and at < rows[0]["n"]:
            x = rows[at]
            files, held, volume = x["files"], x["held"], volume + x["volumes"]
        else:
            files, held = files + rows[0]["n"], held + rows[0]["all"]

    for row in summary.orderBy("r", "at").toLocalIterator():
        if group and row["r"] != group[0]["r"]:
            walk(group)
            group = []
        group.append(row)
    if group:
        walk(group)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (whole := read(batches)) is None:
            return
        r, keys, sizes = whole
        upto, after = jumps(sizes)
        open_files, open_bytes, started = state[r]
        at = first_start(upto, open_files, open_bytes)
        new = np.zeros(len(sizes), np.int64)
        while at < len(sizes):
            new[at] = 1
            at = int(after[at])
        yield from pa.table([keys, pa.array(started + np.cumsum(new) - 1)], names=["_k", "volume"]).to_batches()

    placed = items.mapInArrow(place, f"_k {key_type.simpleString()}, volume long")
    return df.join(placed, F.col(key) == F.col("_k")).select(*names, "volume")


def manifest(packed: DataFrame, size: str) -> DataFrame:
    """A row for each volume: its path, files, bytes."""
    from ..functions.text import volume_path

    return packed.groupBy("volume").agg(F.count("*").alias("files"), F.sum(F.coalesce(F.col(size), F.lit(0))).cast("long").alias("bytes")).withColumn("path", volume_path(F.col("volume")))


def offsets(packed: DataFrame, key: str, size: str) -> DataFrame:
    """``packed`` with each file's ``offset`` in its volume; a volume's files are bounded by its file cap."""
    from pyspark.sql.window import Window

    before = Window.partitionBy("volume").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return packed.withColumn("offset", F.coalesce(F.sum(F.coalesce(F.col(size), F.lit(0))).over(before), F.lit(0)).cast("long"))


def not_shrunk(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after``; reading it fails if it has fewer rows than ``before``."""
    counts = before.agg(F.count("*").alias("b")).crossJoin(after.agg(F.count("*").alias("a")))  # one row by one row
    checked = counts.select(F.when(F.col("a") < F.col("b"), F.raise_error(F.lit("the new table has fewer rows than the stored one")).cast("boolean")).otherwise(True).alias("_ok"))
    return after.join(F.broadcast(checked), F.col("_ok"), "inner").drop("_ok")


def changed(actions: DataFrame) -> bool:
    """Whether a run has anything to write."""
    return not actions.where("action in ('new', 'updated')").isEmpty()


def snapshot_columns(df: DataFrame, at: Column) -> DataFrame:
    """``df`` with the partition columns of a dated snapshot: ``ym`` and ``ymd``."""
    from ..functions.times import utc_parts

    ym, ymd = utc_parts(at)
    return df.withColumns({"ym": ym, "ymd": ymd})
