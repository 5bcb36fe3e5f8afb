"""Queries of projections, filters, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text, times
from ..operators import conform, filters, joins, tags
from .registry import Tables, query

WORDS = "w AS (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS tag FROM part)"


def _words(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", "p_type", F.explode(F.split("p_name", " ")).alias("tag"))


@query("proj_rename", "SELECT p_partkey AS id, p_name AS tags, p_size AS width FROM part")
def proj_rename(t: Tables) -> DataFrame:
    return conform.renamed(t("part"), {"p_partkey": "id", "p_name": "tags", "p_size": "width"})


@query("proj_flatten_prefix", "SELECT l_orderkey, l_linenumber, l_quantity AS file_size, l_shipdate AS file_at, l_discount AS discount, l_tax AS tax FROM lineitem")
def proj_flatten_prefix(t: Tables) -> DataFrame:
    nested = t("lineitem").select("l_orderkey", "l_linenumber", F.struct(F.col("l_quantity").alias("size"), F.col("l_shipdate").alias("at")).alias("file"), F.struct(F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")).alias("score"))
    return conform.flattened(nested, {"file": "file_", "score": ""})


@query("proj_spread_override", "SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 0.5::DOUBLE AS scraped_at FROM orders")
def proj_spread_override(t: Tables) -> DataFrame:
    return conform.spread_override(t("orders"), {"o_orderstatus": F.lower("o_orderstatus"), "scraped_at": F.lit(0.5)})


@query("proj_drop", "SELECT * EXCLUDE (html) FROM pages")
def proj_drop(t: Tables) -> DataFrame:
    return t("pages").drop("html")


CONTRACT = T.StructType([T.StructField("c_name", T.StringType()), T.StructField("c_custkey", T.StringType()), T.StructField("c_acctbal", T.LongType()), T.StructField("c_comment", T.StringType()), T.StructField("c_mktsegment", T.IntegerType())])


@query("proj_conform_schema", "SELECT c_name, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_comment, CAST(NULL AS INTEGER) AS c_mktsegment FROM customer")
def proj_conform_schema(t: Tables) -> DataFrame:
    return conform.conform(t("customer"), CONTRACT)


@query("proj_through_stored_schema", "SELECT s_suppkey AS n_nationkey, CAST(NULL AS VARCHAR) AS n_name, s_nationkey AS n_regionkey FROM supplier")
def proj_through_stored_schema(t: Tables) -> DataFrame:
    fetched = t("supplier").select(F.col("s_suppkey").alias("n_nationkey"), F.col("s_nationkey").alias("n_regionkey"), "s_name")
    return conform.through_stored(fetched, t("nation").withColumn("n_nationkey", F.col("n_nationkey").cast("long")))


@query("proj_array_concat_categories", "SELECT p_partkey, p_name || ' ' || p_brand AS tags FROM part")
def proj_array_concat_categories(t: Tables) -> DataFrame:
    tagged = F.create_map(F.lit("general"), F.split("p_name", " "), F.lit("brand"), F.array("p_brand"))
    return t("part").select("p_partkey", F.array_join(conform.categories_joined(tagged), " ").alias("tags"))


@query("proj_split_by_category", "SELECT p_partkey, p_name AS all_tags, CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE '' END AS artist, split_part(p_name, ' ', 2) AS theme FROM part")
def proj_split_by_category(t: Tables) -> DataFrame:
    word = F.split("p_name", " ")
    objects = F.array(F.struct(word[0].alias("title"), F.when(F.col("p_size") % 2 == 0, "Artist").otherwise("Odd").alias("kind")), F.struct(word[1].alias("title"), F.lit("THEME").alias("kind")))
    made = conform.split_by_category(objects, "title", "kind", ("artist", "theme"))
    return t("part").select("p_partkey", *(F.array_join(c, " ").alias("all_tags" if name == "all" else name) for name, c in made.items()))


@query("proj_composite_key", "SELECT source || '/' || lang || '/' || doc_id AS key FROM documents")
def proj_composite_key(t: Tables) -> DataFrame:
    return t("documents").select(conform.composite_key("source", "lang", "doc_id").alias("key"))


@query("proj_blank_to_null", "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS name FROM part")
def proj_blank_to_null(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", text.blank_to_null(F.when(F.col("p_partkey") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit(" ")))).alias("name"))


@query("coerce_record", "SELECT CASE WHEN doc_id % 4 <> 3 THEN doc_id END AS id, CASE WHEN doc_id % 2 = 0 THEN CAST(1920 AS BIGINT) END AS width, 'a b' AS tags, CASE WHEN doc_id % 4 = 3 THEN 'no usable id' END AS error FROM labels")
def coerce_record(t: Tables) -> DataFrame:
    """Ids as numbers, text and fractions; widths as 1920.0 and true; tags with numbers, blanks and nulls among them."""
    k = F.col("doc_id")
    number = F.when(k % 4 == 3, F.concat(k, F.lit(".5"))).when(k % 2 == 0, F.concat(F.lit('" '), k, F.lit('"'))).otherwise(k.cast("string"))
    body = F.concat(F.lit('{"id": '), number, F.lit(', "width": '), F.when(k % 2 == 0, "1920.0").otherwise("true"), F.lit(', "tags": ["a", 3, " ", null, " b "]}'))
    made = conform.record_from_json(t("labels").select(body.alias("body")), "body")
    return made.withColumn("tags", F.array_join("tags", " "))


@query("coerce_empty_struct", "SELECT doc_id, CAST(NULL AS VARCHAR) AS placeholder FROM labels")
def coerce_empty_struct(t: Tables) -> DataFrame:
    """An object without fields, read with its placeholder."""
    kind = conform.with_placeholders(T.StructType([T.StructField("alternates", T.StructType([]))]))
    read = F.from_json(F.lit('{"alternates": {}}'), kind)
    return t("labels").select("doc_id", read["alternates"]["__dummy"].alias("placeholder"))


@query("flt_recordable", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 3 <> 0")
def flt_recordable(t: Tables) -> DataFrame:
    md5 = F.when(F.col("o_orderkey") % 3 != 0, F.md5(F.col("o_orderkey").cast("string").cast("binary"))).when(F.col("o_orderkey") % 2 == 0, "")
    return t("orders").where(filters.recordable(F.col("o_orderstatus") == "P", md5)).select("o_orderkey")


@query("flt_has_url", "SELECT page_id FROM pages WHERE page_id % 3 = 0")
def flt_has_url(t: Tables) -> DataFrame:
    url = F.when(F.col("page_id") % 3 == 0, F.col("url")).when(F.col("page_id") % 3 == 1, "  ")
    return t("pages").where(filters.has_url(url)).select("page_id")


@query("flt_media_prefix", "SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def flt_media_prefix(t: Tables) -> DataFrame:
    k = F.col("doc_id") % 3
    name = F.when(k == 0, "https://x.example/a.png").when(k == 1, "https://x.example/a.mp4")
    return t("documents").where(filters.is_media(text.guess_mimetype(name), name)).select("doc_id")


@query("flt_sentinel_id", "SELECT doc_id FROM documents WHERE doc_id < 150")
def flt_sentinel_id(t: Tables) -> DataFrame:
    return t("documents").where(filters.real_id(F.col("doc_id"), 150)).select("doc_id")


SETTLED = "SELECT event_id FROM events WHERE event_id % 50 = 0 OR ts + INTERVAL 1 DAY <= TIMESTAMP '2024-01-20'"


@query("flt_settled", SETTLED)
def flt_settled(t: Tables) -> DataFrame:
    at = F.when(F.col("event_id") % 50 != 0, F.col("ts"))
    return t("events").where(times.settled(at, "1 DAY", F.lit("2024-01-20").cast("timestamp_ntz"))).select("event_id")


@query("str_settle_delay", SETTLED)
def str_settle_delay(t: Tables) -> DataFrame:
    """The same rule on a stream of files."""
    from ..sources import writers
    from ..streaming import jobs

    e = t("events").select("event_id", F.when(F.col("event_id") % 50 != 0, F.col("ts")).alias("at"))
    return jobs.through_files(e, writers.scratch(e.sparkSession), lambda stream: jobs.settle(stream, "at", "1 DAY", F.lit("2024-01-20").cast("timestamp_ntz")).select("event_id"))


@query("flt_exclude_value", "SELECT event_id FROM events WHERE event_type IS DISTINCT FROM 'error'")
def flt_exclude_value(t: Tables) -> DataFrame:
    return t("events").where(filters.not_value(F.col("event_type"), "error")).select("event_id")


@query("flt_id_bound", "SELECT o_orderkey FROM orders WHERE o_orderkey < 1000")
def flt_id_bound(t: Tables) -> DataFrame:
    return t("orders").where(filters.below(F.col("o_orderkey"), 1000)).select("o_orderkey")


@query("flt_id_ranges", "SELECT doc_id, lang FROM documents WHERE doc_id BETWEEN 100 AND 110 OR doc_id = 120")
def flt_id_ranges(t: Tables) -> DataFrame:
    wanted = t("region").limit(1).select(F.lit("100-105, 103-110,,120").alias("ids"))
    return t("documents").select("doc_id", "lang").join(filters.id_ranges(wanted).withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")


@query("flt_whole_tag", "SELECT p_partkey FROM part WHERE ' ' || p_name || ' ' LIKE '% widget %'")
def flt_whole_tag(t: Tables) -> DataFrame:
    return t("part").where(text.has_tag(text.wrap_tags(text.split_ws(F.col("p_name"))), "widget")).select("p_partkey")


@query("flt_stale_watermark", "WITH m AS (SELECT user_id, max(ts) AS ts FROM events WHERE user_id % 3 <> 0 AND ts < TIMESTAMP '2024-01-15' GROUP BY 1), c AS (SELECT user_id, max(ts) AS ts FROM events GROUP BY 1) SELECT c.user_id, c.ts FROM c LEFT JOIN m USING (user_id) WHERE m.user_id IS NULL OR m.ts < c.ts")
def flt_stale_watermark(t: Tables) -> DataFrame:
    now = t("events").groupBy("user_id").agg(F.max("ts").alias("ts"))
    marks = t("events").where((F.col("user_id") % 3 != 0) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))).groupBy("user_id").agg(F.max("ts").alias("ts"))
    return joins.stale(now, marks, "user_id", "ts")


@query("flt_valid_object", "SELECT event_id FROM events WHERE event_id % 5 = 0")
def flt_valid_object(t: Tables) -> DataFrame:
    k = F.col("event_id") % 5
    body = F.when(k == 0, F.col("props")).when(k == 1, "<html></html>").when(k == 2, "[1]").when(k == 3, "{}")
    return t("events").where(filters.valid_object(body)).select("event_id")


@query("join_anti_known", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_anti_known(t: Tables) -> DataFrame:
    return joins.unknown(t("documents").select("doc_id", "source"), t("labels"), "doc_id")


@query("join_semi_known", "SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_semi_known(t: Tables) -> DataFrame:
    return joins.known_only(t("documents").select("doc_id", "source"), t("labels"), "doc_id")


DICT = f"{WORDS}, d AS (SELECT tag, CAST(row_number() OVER (ORDER BY tag) AS INTEGER) AS id, CAST(len(tag) AS INTEGER) AS type FROM (SELECT DISTINCT tag FROM w) WHERE len(tag) % 2 = 0)"


def _dictionary(t: Tables) -> DataFrame:
    from ..operators.ordered import numbered

    known = _words(t).select("tag").distinct().where(F.length("tag") % 2 == 0).withColumn("lead", F.ascii("tag"))
    return numbered(known, ["lead", "tag"], "id").select("tag", F.col("id").cast("int").alias("id"), F.length("tag").alias("type"), F.lit(False).alias("ambiguous"))


@query("join_left_dict", f"WITH {DICT} SELECT p_partkey, p_type, w.tag, coalesce(id, -1) AS id, coalesce(type, -1) AS type, false AS ambiguous FROM w LEFT JOIN d ON d.tag = w.tag")
def join_left_dict(t: Tables) -> DataFrame:
    return tags.enriched(_words(t), _dictionary(t))


@query("join_left_dict_composite", f"WITH {WORDS}, d AS (SELECT p_type, tag, count(*) AS total FROM w WHERE p_partkey % 2 = 0 GROUP BY ALL) SELECT p_partkey, w.p_type, w.tag, coalesce(total, -1) AS total FROM w LEFT JOIN d ON d.tag = w.tag AND d.p_type = w.p_type")
def join_left_dict_composite(t: Tables) -> DataFrame:
    known = _words(t).where("p_partkey % 2 = 0").groupBy("p_type", "tag").agg(F.count("*").alias("total"))
    return joins.with_dictionary(_words(t), known, ["p_type", "tag"], {"total": -1})


@query("join_inner_strict", "SELECT n_nationkey, n_name, n_regionkey, r_name, CAST(0 AS BIGINT) AS orphans FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_inner_strict(t: Tables) -> DataFrame:
    lost = joins.orphans(t("nation"), t("region"), "n_regionkey", "r_regionkey").agg(F.count("*").alias("orphans"))
    return joins.strict_inner(t("nation"), t("region").withColumnRenamed("r_regionkey", "key"), "n_regionkey", "key").crossJoin(lost)  # one row


@query("join_tag_ids", "SELECT p_partkey, n_name FROM part JOIN nation ON n_nationkey IN (p_size % 25, p_size % 7) ")
def join_tag_ids(t: Tables) -> DataFrame:
    ids = tags.exploded(t("part"), "p_partkey", F.array(F.col("p_size") % 25, F.col("p_size") % 7)).withColumnRenamed("tag", "n_nationkey")
    return ids.join(t("nation"), "n_nationkey").select("p_partkey", "n_name")


@query("join_lookup_cascade", "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'manifest' WHEN doc_id IN (SELECT item_id FROM benchmark) THEN 'benchmark' ELSE lpad(CAST(doc_id % 1000 AS VARCHAR), 4, '0') END AS place FROM documents")
def join_lookup_cascade(t: Tables) -> DataFrame:
    places = [("manifest", t("labels")), ("benchmark", t("benchmark").withColumnRenamed("item_id", "doc_id"))]
    return joins.lookup_cascade(t("documents").select("doc_id"), "doc_id", places, text.bucket_mod(F.col("doc_id")))


@query("join_coverage", 'SELECT count(*) FILTER (WHERE l AND r) AS "both", count(*) FILTER (WHERE l AND NOT r) AS left_only, count(*) FILTER (WHERE r AND NOT l) AS right_only FROM (SELECT a.id IS NOT NULL AS l, b.id IS NOT NULL AS r FROM (SELECT DISTINCT doc_id AS id FROM labels) a FULL JOIN (SELECT DISTINCT page_id AS id FROM pages) b ON a.id = b.id)')
def join_coverage(t: Tables) -> DataFrame:
    return joins.coverage(t("labels"), t("pages").withColumnRenamed("page_id", "doc_id"), "doc_id")


RENAMES = {"widget": "gadget", "ring": "band"}


def _mapping(t: Tables) -> DataFrame:
    return t("region").limit(1).select(F.explode(F.array(*(F.struct(F.lit(a).alias("tag"), F.lit(b).alias("target")) for a, b in RENAMES.items()))).alias("m")).select("m.*")


@query("join_rename_map", f"WITH {WORDS} SELECT CASE tag WHEN 'widget' THEN 'gadget' WHEN 'ring' THEN 'band' ELSE tag END AS tag, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY 1")
def join_rename_map(t: Tables) -> DataFrame:
    return tags.merged_totals(tags.usage(_words(t)), _mapping(t))


@query("tags_canonical", f"WITH {WORDS} SELECT DISTINCT p_partkey, CASE tag WHEN 'widget' THEN 'gadget' WHEN 'ring' THEN 'band' ELSE tag END AS tag FROM w")
def tags_canonical(t: Tables) -> DataFrame:
    return tags.canonical(_words(t).select("p_partkey", "tag"), _mapping(t), "p_partkey")


@query("join_rejoin_schema", "SELECT l.doc_id, quality, toxic, lang FROM labels l JOIN documents d ON d.doc_id = l.doc_id")
def join_rejoin_schema(t: Tables) -> DataFrame:
    return t("labels").join(t("documents").select("doc_id", "lang"), "doc_id")


@query("set_union_all_same", "SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels")
def set_union_all_same(t: Tables) -> DataFrame:
    return t("labels").select("doc_id").unionByName(t("labels").select("doc_id"))


@query("set_union_widen", "SELECT doc_id, quality, CAST(NULL AS VARCHAR) AS lang FROM labels UNION ALL SELECT doc_id, NULL, lang FROM documents")
def set_union_widen(t: Tables) -> DataFrame:
    return t("labels").select("doc_id", "quality").unionByName(t("documents").select("doc_id", "lang"), allowMissingColumns=True)


@query("set_union_cast", "SELECT c_custkey, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def set_union_cast(t: Tables) -> DataFrame:
    stored = t("customer").select("c_custkey", "c_acctbal")
    fresh = t("supplier").select(F.col("s_suppkey").cast("string").alias("c_custkey"), F.col("s_acctbal").cast("string").alias("c_acctbal"))
    return stored.unionByName(conform.through_stored(fresh, stored))


@query("set_union_distinct", "SELECT doc_id FROM labels UNION SELECT doc_id FROM documents UNION SELECT item_id FROM benchmark")
def set_union_distinct(t: Tables) -> DataFrame:
    return t("labels").select("doc_id").union(t("documents").select("doc_id")).union(t("benchmark").select("item_id")).distinct()


@query("set_except", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def set_except(t: Tables) -> DataFrame:
    return t("documents").select("doc_id").subtract(t("labels").select("doc_id"))


@query("set_intersect", "SELECT doc_id FROM documents INTERSECT SELECT page_id FROM pages")
def set_intersect(t: Tables) -> DataFrame:
    return t("documents").select("doc_id").intersect(t("pages").select("page_id"))
