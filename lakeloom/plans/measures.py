"""Queries of aggregates, window-shaped logic, orders and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import conform, dedup, layout, measures, ordered, tags
from ..sources import writers
from ..streaming import states
from . import report
from .registry import Tables, query

WORDS = "w AS (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS tag, unnest(range(2)) AS pos FROM part)"


def _tags(t: Tables, distinct: bool = True) -> DataFrame:
    return tags.exploded(t("part"), "p_partkey", F.split("p_name", " "), distinct)


@query("agg_tag_count", f"WITH {WORDS} SELECT tag, count(DISTINCT p_partkey) AS n FROM w GROUP BY tag")
def agg_tag_count(t: Tables) -> DataFrame:
    return tags.usage(_tags(t))


@query("agg_tag_count_dup", f"WITH {WORDS} SELECT tag, count(*) AS n FROM w GROUP BY tag")
def agg_tag_count_dup(t: Tables) -> DataFrame:
    return tags.usage(_tags(t, distinct=False))


@query("agg_tag_count_by_cat", f"WITH {WORDS} SELECT p_type AS category, tag, count(*) AS n FROM w GROUP BY ALL")
def agg_tag_count_by_cat(t: Tables) -> DataFrame:
    posts = t("part").select("p_partkey", F.create_map(F.col("p_type"), F.split("p_name", " ")).alias("tags"))
    return tags.usage(tags.by_category(posts, "p_partkey", F.col("tags")), ("category", "tag"))


@query("agg_tag_strict_count", f"WITH {WORDS} SELECT tag, count(*) FILTER (WHERE pos = 0) AS n_primary, count(*) FILTER (WHERE pos > 0) AS n_other FROM w GROUP BY tag")
def agg_tag_strict_count(t: Tables) -> DataFrame:
    placed = t("part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "tag"))
    return tags.strict_usage(placed, F.col("pos") == 0)


@query("agg_type_hist", "SELECT CASE CAST(page_id % 3 AS INTEGER) WHEN 0 THEN 'image' WHEN 1 THEN 'archive' END AS type, count(*) AS n FROM pages GROUP BY 1")
def agg_type_hist(t: Tables) -> DataFrame:
    name = F.when(F.col("page_id") % 3 == 0, "a.png").when(F.col("page_id") % 3 == 1, "a.zip").otherwise("a.xyz")
    return measures.type_histogram(t("pages"), text.file_type(name))


@query("agg_count_distinct", "SELECT count(DISTINCT user_id) AS n_distinct, count(*) AS n_rows FROM events")
def agg_count_distinct(t: Tables) -> DataFrame:
    return measures.distinct_and_rows(t("events"), "user_id")


@query("agg_sum_bytes", "SELECT CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS bytes, count(*) AS files FROM documents")
def agg_sum_bytes(t: Tables) -> DataFrame:
    return measures.total_bytes(t("documents"), "n_chars")


@query("agg_min_max_id", "SELECT min(doc_id) AS min_id, max(doc_id) AS max_id FROM labels")
def agg_min_max_id(t: Tables) -> DataFrame:
    return measures.id_span(t("labels"), "doc_id")


@query("agg_collect_ids", "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL")
def agg_collect_ids(t: Tables) -> DataFrame:
    return measures.distinct_ids(t("events"), "user_id")


@query(
    "agg_volume_stats",
    "SELECT event_id // 100 AS volume, count(*) FILTER (WHERE event_type = 'view') AS n_view, count(*) FILTER (WHERE event_type = 'error') AS n_error, round(count(*) FILTER (WHERE event_type = 'error') / count(*), 9) AS failure_share, count(*) FILTER (WHERE event_type = 'error') / count(*) >= 0.3 AS abort FROM events GROUP BY 1",
)
def agg_volume_stats(t: Tables) -> DataFrame:
    e = t("events").withColumn("volume", F.floor(F.col("event_id") / 100).cast("long"))
    return measures.outcome_stats(e, "volume", "event_type", ("view", "error"), ("error",))


@query("agg_rate_per_week", "SELECT count(*) AS n, round(count(*) / (epoch(max(ts)) - epoch(min(ts))) * 604800, 6) AS per_week FROM events")
def agg_rate_per_week(t: Tables) -> DataFrame:
    return measures.rate_per_week(t("events"), "ts")


@query("agg_density", "SELECT doc_id // 100 AS window, count(DISTINCT doc_id) AS n, round(count(DISTINCT doc_id) / 100.0::DOUBLE, 9) AS fill FROM labels GROUP BY 1")
def agg_density(t: Tables) -> DataFrame:
    return measures.density(t("labels"), "doc_id", 100)


@query(
    "agg_weighted_ema",
    """
WITH e AS (SELECT user_id, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
l AS (SELECT user_id, list(CASE WHEN ok THEN 0.1 ELSE 0.0 END::DOUBLE ORDER BY i) AS xs FROM e GROUP BY user_id)
SELECT user_id, round(list_reduce(list_prepend(1.0::DOUBLE, xs), lambda s, b: greatest(0.35::DOUBLE, s * (1 - 0.1::DOUBLE) + b)), 9) AS score FROM l""",
)
def agg_weighted_ema(t: Tables) -> DataFrame:
    return measures.success_score(t("events"), "user_id", "event_id", F.col("event_type") != "error", 0.1, slice_width=1000)


@query("win_surrogate_id", "SELECT l_orderkey, l_linenumber, 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS file_id FROM lineitem")
def win_surrogate_id(t: Tables) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return ordered.numbered(t("lineitem").select(*order), order, "file_id", 1000).select("l_orderkey", "l_linenumber", "file_id")


@query("win_shard_no", "SELECT shard, count(*) AS n, min(doc_id) AS lo, max(doc_id) AS hi FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 + 3 AS shard FROM documents) GROUP BY shard")
def win_shard_no(t: Tables) -> DataFrame:
    placed = layout.shard_of(t("documents").select("doc_id"), ["doc_id"], 64, sealed=2)
    return placed.groupBy("shard").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))


@query("win_chunk", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id DESC) - 1) // 7 AS chunk FROM labels")
def win_chunk(t: Tables) -> DataFrame:
    made = ordered.numbered(t("labels").select("doc_id"), ["doc_id"], "n", descending=True)
    return made.select("doc_id", F.floor((F.col("n") - 1) / 7).cast("long").alias("chunk"))


@query(
    "win_pack_volumes",
    """
WITH RECURSIVE d AS (SELECT doc_id, n_chars AS size, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
r AS (
  SELECT i, doc_id, CAST(0 AS BIGINT) AS volume, CAST(1 AS BIGINT) AS files, CAST(size AS BIGINT) AS bytes FROM d WHERE i = 1
  UNION ALL
  SELECT d.i, d.doc_id, CASE WHEN f THEN r.volume + 1 ELSE r.volume END, CASE WHEN f THEN 1 ELSE r.files + 1 END, CASE WHEN f THEN d.size ELSE r.bytes + d.size END
  FROM r JOIN (SELECT * FROM d) d ON d.i = r.i + 1, LATERAL (SELECT r.files >= 40 OR r.bytes + d.size > 50000 AS f)
)
SELECT doc_id, volume FROM r""",
)
def win_pack_volumes(t: Tables) -> DataFrame:
    return layout.pack_volumes(t("documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 50_000, 40).select("doc_id", "volume")


@query("win_seal_defer", "SELECT doc_id, w AS written, w - coalesce(n_chars, 0) >= 100000 AS deferred FROM (SELECT doc_id, n_chars, CAST(sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS w FROM documents)")
def win_seal_defer(t: Tables) -> DataFrame:
    return layout.sealed_volumes(t("documents").select("doc_id", "n_chars"), ["doc_id"], "n_chars", 100_000).select("doc_id", "written", "deferred")


@query("win_top_n_per_type", f"WITH {WORDS}, c AS (SELECT p_type, tag, count(*) AS n FROM w GROUP BY ALL) SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY p_type ORDER BY n DESC, tag) AS INTEGER) AS rank FROM c) WHERE rank <= 3")
def win_top_n_per_type(t: Tables) -> DataFrame:
    words = t("part").select("p_type", F.explode(F.split("p_name", " ")).alias("tag"))
    return tags.top_n_per_type(tags.usage(words, ("p_type", "tag")), "p_type", 3)


@query("win_rank_recent", "SELECT doc_id, source FROM documents ORDER BY doc_id DESC LIMIT 50")
def win_rank_recent(t: Tables) -> DataFrame:
    return report.preview(t("documents").select("doc_id", "source"), "doc_id")


STREAK_SQL = """
WITH p AS (SELECT event_id // 20 AS page, count(*) FILTER (WHERE event_id = first) AS n_new FROM (SELECT event_id, min(event_id) OVER (PARTITION BY user_id) AS first FROM events) GROUP BY 1),
b AS (SELECT *, n_new <= {most} AS hit, count(*) FILTER (WHERE n_new > {most}) OVER (ORDER BY page) AS island FROM p)
SELECT page, n_new, CASE WHEN hit THEN row_number() OVER (PARTITION BY island, hit ORDER BY page) ELSE 0 END AS streak FROM b"""


def _pages(t: Tables) -> DataFrame:
    firsts = dedup.first_seen(t("events"), "user_id", "event_id")
    marked = t("events").select("event_id").join(firsts, F.col("event_id") == F.col("first_seen"), "left")
    return marked.groupBy(F.floor(F.col("event_id") / 20).cast("long").alias("page")).agg(F.count("first_seen").alias("n_new"))


@query("win_empty_streak", STREAK_SQL.format(most=0))
def win_empty_streak(t: Tables) -> DataFrame:
    return measures.empty_streaks(_pages(t), "page", "n_new")


@query("str_stop_rule", f"SELECT min(page) AS stop_at FROM ({STREAK_SQL.format(most=1)}) WHERE streak >= 3")
def str_stop_rule(t: Tables) -> DataFrame:
    """A walk over pages that arrive in five parts, a run of the stream for each, until three pages in a row had at most one new user."""
    spark, pages = t("events").sparkSession, _pages(t).withColumn("walk", F.lit("w"))
    place, session = writers.scratch(spark), states.stateful_session(spark)
    top = pages.agg(F.max("page").alias("top"))  # one row
    dealt = pages.join(F.broadcast(top)).withColumn("part", F.floor(F.col("page") * 5 / (F.col("top") + 1)))
    for part in range(5):
        dealt.where(F.col("part") == part).drop("part", "top").coalesce(1).write.mode("append").parquet(f"{place}/in")
        if states.walk_until_empty(session.readStream.schema(pages.schema).parquet(f"{place}/in"), "walk", "page", "n_new", place, 3, 1):
            break
    return spark.read.schema("page long, stop boolean").parquet(f"{place}/out").where("stop").agg(F.min("page").alias("stop_at"))


@query("win_stop_rule", f"SELECT min(page) AS stop_at FROM ({STREAK_SQL.format(most=1)}) WHERE streak >= 3")
def win_stop_rule(t: Tables) -> DataFrame:
    """The same over all pages in one go."""
    return measures.empty_streaks(_pages(t), "page", "n_new", 1).where("streak >= 3").agg(F.min("page").alias("stop_at"))


AIMD_SQL = """
WITH RECURSIVE e AS (SELECT user_id, event_type <> 'error' AS ok, epoch_us(ts) / 1e6 AS at, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
r AS (
  SELECT user_id, CAST(0 AS BIGINT) AS i, 4.0::DOUBLE AS rate, CAST(0 AS BIGINT) AS run, CAST('-infinity' AS DOUBLE) AS cooled FROM e WHERE i = 1
  UNION ALL
  SELECT r.user_id, e.i,
    CASE WHEN e.ok AND r.run + 1 >= 3 THEN least(64.0, r.rate + 0.5) WHEN NOT e.ok AND e.at - r.cooled >= 2.0 THEN greatest(0.5, r.rate * 0.7::DOUBLE) ELSE r.rate END,
    CASE WHEN e.ok THEN (r.run + 1) % 3 WHEN e.at - r.cooled >= 2.0 THEN 0 ELSE r.run END,
    CASE WHEN NOT e.ok AND e.at - r.cooled >= 2.0 THEN e.at ELSE r.cooled END
  FROM r JOIN (SELECT * FROM e) e ON e.user_id = r.user_id AND e.i = r.i + 1
)
SELECT user_id, round(arg_max(rate, i), 9) AS rate FROM r GROUP BY user_id"""


@query("win_aimd", AIMD_SQL)
def win_aimd(t: Tables) -> DataFrame:
    e = t("events").select("user_id", "event_id", (F.col("event_type") != "error").alias("ok"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    return measures.adapted_rate(e, "user_id", "event_id", "ok", every=3)


@query("win_dedup_nested", "WITH f AS (SELECT o_orderkey, unnest(range(3)) AS i, CASE unnest(range(3)) WHEN 1 THEN '/b' ELSE '/a' END AS path FROM orders) SELECT o_orderkey, path, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY min(i)) - 1 AS INTEGER) AS pos, CAST(min(i) AS INTEGER) AS n FROM f GROUP BY o_orderkey, path")
def win_dedup_nested(t: Tables) -> DataFrame:
    """Of three attachments, the first and the last with one path."""
    file = lambda path, n: F.struct(F.lit(path).alias("path"), F.lit(n).alias("n"))
    posts = t("orders").select("o_orderkey", F.array(file("/a", 0), file("/b", 1), file("/a", 2)).alias("files"))
    return conform.exploded_attachments(posts, ["o_orderkey"], "files")


@query("win_first_lang", "SELECT lang, arg_min(source, doc_id) AS first_source FROM documents WHERE source IS NOT NULL GROUP BY lang")
def win_first_lang(t: Tables) -> DataFrame:
    return t("documents").where("source is not null").groupBy("lang").agg(F.min_by("source", "doc_id").alias("first_source"))


@query("sort_id_desc", "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey DESC) AS place FROM customer")
def sort_id_desc(t: Tables) -> DataFrame:
    return ordered.numbered(t("customer").select("c_custkey"), ["c_custkey"], "place", descending=True)


@query("sort_id_asc", "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS place FROM customer")
def sort_id_asc(t: Tables) -> DataFrame:
    return ordered.numbered(t("customer").select("c_custkey"), ["c_custkey"], "place")


@query("sort_count_desc_type_asc", f"WITH {WORDS}, c AS (SELECT p_type, tag, count(*) AS n FROM w GROUP BY ALL) SELECT *, row_number() OVER (ORDER BY n DESC, p_type, tag) AS place FROM c")
def sort_count_desc_type_asc(t: Tables) -> DataFrame:
    words = t("part").select("p_type", F.explode(F.split("p_name", " ")).alias("tag"))
    counts = tags.usage(words, ("p_type", "tag")).withColumn("less", -F.col("n"))
    return ordered.numbered(counts, ["less", "p_type", "tag"], "place").drop("less")


@query("sort_pair_asc", "SELECT n_name, r_name, row_number() OVER (ORDER BY n_regionkey, n_name) AS place FROM nation JOIN region ON n_regionkey = r_regionkey")
def sort_pair_asc(t: Tables) -> DataFrame:
    pairs = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return ordered.numbered(pairs.select("n_regionkey", "n_name", "r_name"), ["n_regionkey", "n_name"], "place").drop("n_regionkey")


@query("sort_other_key", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def sort_other_key(t: Tables) -> DataFrame:
    return ordered.numbered(t("orders").select("o_totalprice", "o_orderkey"), ["o_totalprice", "o_orderkey"], "place", descending=True).drop("o_totalprice")


@query("sort_natural", "SELECT doc_id, name, row_number() OVER (ORDER BY number, doc_id) AS place FROM (SELECT doc_id, doc_id % 100 AS number, 't-' || doc_id % 100 || '.parquet' AS name FROM documents)")
def sort_natural(t: Tables) -> DataFrame:
    named = t("documents").select("doc_id", F.concat(F.lit("t-"), F.col("doc_id") % 100, F.lit(".parquet")).alias("name"))
    keyed = named.withColumn("sort_key", text.natural_key(F.col("name")))
    return ordered.numbered(keyed, ["sort_key", "doc_id"], "place").drop("sort_key")


@query("limit_preview", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey DESC LIMIT 30")
def limit_preview(t: Tables) -> DataFrame:
    return report.preview(t("customer").select("c_custkey", "c_name"), "c_custkey", 30)


@query("sort_prefix_ids", "SELECT doc_id, row_number() OVER (ORDER BY doc_id DESC) AS place FROM (SELECT doc_id FROM labels UNION SELECT doc_id FROM documents)")
def sort_prefix_ids(t: Tables) -> DataFrame:
    ids = t("labels").select("doc_id").union(t("documents").select("doc_id")).distinct()
    return ordered.numbered(ids, ["doc_id"], "place", descending=True)


@query(
    "sink_report",
    f"""WITH {WORDS}, c AS (SELECT p_type, tag, count(*) AS n FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, tag) AS rank FROM c)
SELECT p_type, CAST(rank + 2 AS INTEGER) AS line, '| ' || tag || ' | ' || n || ' |' AS markdown FROM r WHERE rank <= 30
UNION ALL SELECT DISTINCT p_type, CAST(i AS INTEGER), CASE i WHEN 0 THEN '### ' || p_type WHEN 1 THEN '| tag | n |' ELSE '|---|---|' END FROM c, range(3) t(i)""",
)
def sink_report(t: Tables) -> DataFrame:
    """The report's tables of tags, rendered: a line of Markdown each."""
    words = t("part").select("p_type", F.explode(F.split("p_name", " ")).alias("tag"))
    return report.tag_lines(tags.usage(words, ("p_type", "tag")), "p_type")
