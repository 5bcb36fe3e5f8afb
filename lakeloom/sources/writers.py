"""Writes that leave a readable table whatever happens: new paths, open shards, dated partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layout
from ..session import shared_folder


def scratch(spark: SparkSession) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_folder(spark)}/lakeloom-{uuid.uuid4().hex}"


def write_sorted(df: DataFrame, path: str, key: str, rows_per_file: int = 1_000_000) -> None:
    """The published table, newest id first: files are ranges of the key, each sorted."""
    df.orderBy(F.col(key).desc_nulls_last()).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_shards(df: DataFrame, path: str, order: list[str], cap: int, sealed: int = 0) -> DataFrame:
    """Shards of at most ``cap`` rows, one folder each; folders of other (sealed) shards aren't touched. Gives the table as read back."""
    spark = df.sparkSession
    placed = layout.shard_of(df, order, cap, sealed)
    placed.repartition("shard").sortWithinPartitions("shard", F.col(order[0]).desc_nulls_last()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return spark.read.parquet(path)


def write_snapshot(df: DataFrame, path: str, at: Column) -> DataFrame:
    """``current`` and a dated partition of ``history``; a second run of a day replaces that day only. Gives the history."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/current")
    layout.snapshot_columns(df, at).repartition("ym", "ymd").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym", "ymd").parquet(f"{path}/history")
    return spark.read.option("recursiveFileLookup", False).parquet(f"{path}/history")


def write_state(ids: DataFrame, path: str, key: str) -> None:
    """Known ids in ascending order as JSON lines."""
    ids.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).write.mode("overwrite").json(path)


def write_volumes(packed: DataFrame, path: str, key: str, size: str) -> DataFrame:
    """The plan of packed volumes: ``files`` (volume and offset of each) and ``manifest``. Gives the manifest."""
    spark = packed.sparkSession
    layout.offsets(packed, key, size).write.mode("overwrite").parquet(f"{path}/files")
    layout.manifest(packed, size).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def publish(before: DataFrame, after: DataFrame, path: str) -> None:
    """Writes ``after`` to a new path unless it has fewer rows than ``before``; a refusal leaves no finished table."""
    layout.not_shrunk(before, after).write.mode("errorifexists").parquet(path)


def publish_if_changed(before: DataFrame, after: DataFrame, actions: DataFrame, path: str) -> bool:
    """``publish`` if a run changed anything; whether it did."""
    if not layout.changed(actions):
        return False
    publish(before, after, path)
    return True
