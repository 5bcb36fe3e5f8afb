"""Rows into declared shapes: contracts, flattened records, lists by category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce

PLACEHOLDER = T.StructField("__dummy", T.StringType(), True)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The named columns only, under new names, in the order of ``names``."""
    return df.select(*(F.col(old).alias(new) for old, new in names.items()))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the contract: values cast (unreadable: null), missing columns null, others dropped, in its order."""
    have = {f.name: f.dataType for f in df.schema}
    cast = lambda f: F.col(f"`{f.name}`") if have[f.name] == f.dataType else F.col(f"`{f.name}`").try_cast(f.dataType)
    return df.select(*((cast(f) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema))


def through_stored(df: DataFrame, stored: DataFrame) -> DataFrame:
    """``df`` in the stored table's schema, which is the authority."""
    return conform(df, stored.schema)


def flattened(df: DataFrame, nested: dict[str, str]) -> DataFrame:
    """Structs named in ``nested`` spread out, their fields' names led by the given prefix ('' for none); other columns stay."""
    out: list[Column] = []
    for f in df.schema:
        if f.name in nested:
            out += [F.col(f"`{f.name}`.`{g.name}`").alias(f"{nested[f.name]}{g.name}") for g in f.dataType.fields]
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def spread_override(df: DataFrame, explicit: dict[str, Column]) -> DataFrame:
    """All of an item's columns, then explicit ones, which win where names clash."""
    return df.withColumns(explicit)


def categories_joined(tags: Column) -> Column:
    """All lists of a map from category to tags, one behind the other in the map's order."""
    return F.flatten(F.map_values(tags))


def split_by_category(objects: Column, title: str, kind: str, categories: tuple[str, ...]) -> dict[str, Column]:
    """``all`` titles and a list for each category (compared without case); lists are never null."""
    items = F.coalesce(objects, F.filter(F.array(objects.getItem(0)), lambda x: F.lit(False)))

    def titles(category: str) -> Column:
        return F.transform(F.filter(items, lambda x: F.lower(x[kind]) == F.lit(category.lower())), lambda x: x[title])

    return {"all": F.transform(items, lambda x: x[title])} | {c: titles(c) for c in categories}


def composite_key(*parts: str) -> Column:
    """Parts joined by ``/``; null if one is."""
    return F.concat(*(x for i, p in enumerate(parts) for x in ([F.lit("/")] if i else []) + [F.col(p).cast("string")]))


def with_placeholders(kind: T.DataType) -> T.DataType:
    """A type in which empty structs, at every depth, hold one placeholder field, so that it can be stored."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, with_placeholders(f.dataType), f.nullable) for f in kind] or [PLACEHOLDER])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(with_placeholders(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, with_placeholders(kind.valueType), kind.valueContainsNull)
    return kind


def record_from_json(df: DataFrame, body: str) -> DataFrame:
    """Rows with ``id``, ``width``, ``tags`` of lenient JSON objects; a body without a usable id becomes ``error`` text.

    Numbers, blanks and nulls among the tags drop; ids and sizes must be whole numbers.
    """
    parsed = F.try_parse_json(F.col(body))
    items = F.try_variant_get(parsed, "$.tags", "array<variant>")
    texts = F.filter(F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.trim(x.try_cast("string"))), lambda x: x != "")
    number = coerce.int_from_json(F.col(body), "$.id")
    return df.select(
        number.alias("id"),
        coerce.int_from_json(F.col(body), "$.width").alias("width"),
        F.coalesce(texts, F.array().cast("array<string>")).alias("tags"),
        F.when(number.isNull(), F.lit("no usable id")).alias("error"),
    )


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def exploded_attachments(posts: DataFrame, keys: list[str], files: str) -> DataFrame:
    """A row for each distinct path among a post's attachments, first one kept, with its place ``pos``."""
    from .dedup import nested_first

    return posts.select(*keys, F.posexplode(nested_first(F.col(files), "path")).alias("pos", "_f")).select(*keys, "pos", "_f.*")


def pivoted_map(df: DataFrame, column: str, prefix: str, most: int = 500) -> DataFrame:
    """``df`` with a text column for each key of its map ``column``, in order of the keys, ``''`` where a row lacks it.

    The keys are looked up first. More than ``most`` of them are an error: they would be
    data, not columns. Keys that differ only in case make one column, the first non-null
    of their values; a null map has no keys.
    """
    rows = df.select(F.explode(F.map_keys(column)).alias("key")).distinct().orderBy("key").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} keys in {column}")
    named: dict[str, list[str]] = {}
    for r in rows:
        named.setdefault(r["key"].lower(), []).append(r["key"])
    value = lambda keys: F.coalesce(*(F.try_element_at(column, F.lit(k)) for k in keys), F.lit(""))
    kept = [c for c in df.columns if c != column and c.lower() not in {f"{prefix}{k}".lower() for k in named}]
    return df.select(*kept, *(value(keys).alias(f"{prefix}{keys[0]}") for keys in named.values()))
