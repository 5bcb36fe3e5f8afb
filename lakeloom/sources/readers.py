"""Tables from files: parquet in shards, CSV exports, JSON, XML, HTML, archives."""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce, pages, parsing, text


def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def without_nan(df: DataFrame) -> DataFrame:
    """``df`` with nulls for NaN in its floating columns."""
    return df.withColumns({f.name: coerce.nan_to_null(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def projected(spark: SparkSession, path: str, columns: list[str], condition: Column | None = None) -> DataFrame:
    """Some columns of the rows that meet a condition; both reach the scan."""
    df = spark.read.parquet(path).select(*columns)
    return df if condition is None else df.where(condition)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` that lets parquet footers answer aggregates; the settings of ``spark`` stay as they are."""
    made = spark.newSession()
    made.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    kept = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    made.conf.set("spark.sql.sources.useV1SourceList", ",".join(kept))
    return made


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a parquet table, from the footers of its files: no row group is read."""
    counted = footer_session(spark).read.parquet(path).agg(F.count("*").alias("n"))
    # Of a table without row groups the pushed count is null, though its column says it can't be; a sum may be.
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def footer_span(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``n``, ``least`` and ``most`` of a numeric or boolean column from the footers; read from the column itself where a footer lacks its statistics."""
    from pyspark.errors import PySparkException

    wanted = (F.count("*").alias("n"), F.min(column).alias("least"), F.max(column).alias("most"))
    try:  # Spark finds out when it reads the footers
        row = footer_session(spark).read.parquet(path).agg(*wanted).collect()
    except (PySparkException, Py4JJavaError):
        return spark.read.parquet(path).agg(*wanted)
    kind = dict(spark.read.parquet(path).dtypes)[column]
    return spark.createDataFrame([(r["n"] or 0, r["least"], r["most"]) for r in row], f"n long, least {kind}, most {kind}")


def shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards under a path or pattern with ``shard``, the number at the end of the file's name (-1 without one)."""
    df = spark.read.parquet(path)
    return df.withColumn("shard", text.shard_number(F.col("_metadata.file_name")))


def newest_shard(sharded: DataFrame) -> DataFrame:
    """Rows of the shard of the greatest number (numbers, not names, are compared)."""
    top = sharded.agg(F.max("shard").alias("shard"))  # one row
    return sharded.join(F.broadcast(top), "shard", "left_semi")


def csv_export(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV export, plain or gzipped, with a header, quotes doubled inside quotes, line feeds inside fields."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def latest_dated(names: DataFrame, column: str, pattern: str = r"(\d{4}-\d{2}-\d{2})") -> DataFrame:
    """One row: the greatest date in the names and the name that has it (ties: the greatest name)."""
    day = F.regexp_extract(column, pattern, 1)
    dated = names.select(day.alias("day"), F.col(column).alias("name")).where("day <> ''")
    return dated.agg(F.max(F.struct("day", "name")).alias("m")).select("m.day", "m.name")


def json_state(spark: SparkSession, path: str, field: str, lines: bool = False) -> DataFrame:
    """The distinct ids in a list of one state document, or of documents of a line each."""
    return spark.read.option("multiLine", not lines).json(path).select(F.explode(F.col(field)).alias("id")).distinct()


def map_key_ids(bodies: DataFrame, body: str, path: str = "$.files") -> DataFrame:
    """Numbers in the names that are keys of a JSON object, ``{"dir/123.jpg": …}``."""
    keys = F.map_keys(F.from_json(F.get_json_object(F.col(body), path), "map<string,string>"))
    name = F.explode(keys).alias("name")
    return bodies.select(name).select(F.regexp_extract("name", r"(\d+)\.[^./]+$", 1).try_cast("long").alias("id")).where("id is not null").distinct()


def json_pages(bodies: DataFrame, body: str, record: str, field: str | None = None) -> DataFrame:
    """Records of API pages: a JSON list, or an object with the list under ``field``; unreadable pages give none."""
    kind = f"array<{record}>" if field is None else f"struct<`{field}`: array<{record}>>"
    parsed = F.from_json(F.col(body), kind)
    return bodies.select(F.explode(parsed if field is None else parsed.getField(field)).alias("_r")).select("_r.*")


def lenient_objects(bodies: DataFrame, body: str) -> DataFrame:
    """``bodies`` with ``object`` (strict JSON text) and ``error``. Only bodies that the JVM can't read go to Python for repair."""
    from ..operators.filters import valid_object

    good = F.coalesce(valid_object(F.col(body)), F.lit(False))
    read = bodies.where(good).withColumn("object", F.col(body)).unionByName(bodies.where(~good).withColumn("object", parsing.lenient_object(F.col(body))))
    return read.withColumn("error", F.when(F.col("object").isNull(), "not an object"))


def xml_rows(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Elements as rows; attributes are fields led by ``_``."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def html_tables(pages: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """A row for each row of a page's tables: ``keys``, its place and a map by the header's names."""
    return pages.select(*keys, F.posexplode(parsing.html_table(F.col(body))).alias("pos", "cells"))


def html_entities(pages: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Title, category, images and list items of pages that describe one thing."""
    return pages.select(*keys, parsing.html_entity(F.col(body)).alias("_e")).select(*keys, "_e.*")


def entity_pages(bodies: DataFrame, body: str, url: str, keys: list[str]) -> DataFrame:
    """The nested value of each entity page (see ``pages.PAGE``), links made whole by the page's ``url``; pages without one are left out."""
    read = bodies.select(*keys, pages.html_page(F.col(body), F.col(url)).alias("_e")).select(*keys, "_e.*")
    return read.where(F.col("category").isNotNull())


def html_numbers(pages: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """A row for each ``"id": N,`` in a body."""
    return pages.select(*keys, F.explode(text.html_ids(F.col(body))).alias("id"))


def tar_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents inside the tar files under a path: ``archive``, ``member``, ``body``."""
    return tar_members(spark.read.format("binaryFile").load(path))


def tar_members(archives: DataFrame) -> DataFrame:
    """The JSON members of archives given as ``path`` and ``content``. A task opens one archive at a time."""

    def unpack(frames):
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    rows = [(archive, m.name, tar.extractfile(m).read().decode("utf-8", "replace")) for m in tar if m.isfile() and m.name.endswith(".json")]
                yield pd.DataFrame(rows, columns=["archive", "member", "body"])

    return archives.select("path", "content").mapInPandas(unpack, "archive string, member string, body string")


def probes(spark: SparkSession, known: DataFrame, key: str, first: int, newest: int) -> DataFrame:
    """Ids from ``first`` to ``newest`` that aren't known."""
    return spark.range(first, newest + 1).select(F.col("id").alias(key)).join(known.select(key), key, "left_anti")


def found_objects(bodies: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """Every object inside a JSON body that has both a name and a path, depth first."""
    import json

    def find(frames):
        def inside(x):
            if isinstance(x, dict):
                if "name" in x and "path" in x:
                    yield x["name"], x["path"]
                for v in x.values():
                    yield from inside(v)
            elif isinstance(x, list):
                for v in x:
                    yield from inside(v)

        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                try:
                    hits = list(inside(json.loads(row[-1]))) if row[-1] else []
                except (ValueError, RecursionError):
                    hits = []
                rows += [(*row[:-1], i, None if n is None else str(n), None if p is None else str(p)) for i, (n, p) in enumerate(hits)]
            yield pd.DataFrame(rows, columns=[*keys, "pos", "name", "path"])

    kinds = dict(bodies.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "pos int", "name string", "path string"])
    return bodies.select(*keys, body).mapInPandas(find, schema)
