"""Where queries and the SQL that checks them are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

Tables = Callable[[str], DataFrame]


def query(name: str, sql: str | None = None):
    """Registers a function of ``t`` (a reader of the tables by name) under ``name``, with its SQL if there is one."""

    def register(make: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return make

    return register
