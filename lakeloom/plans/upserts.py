"""Queries of the upsert family, over ``orders`` as stored table and a batch made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, layout, tags, upsert
from ..sources import writers
from ..streaming import jobs, states
from ..streaming.tables import MergedTable
from .registry import Tables, query

SPEC = upsert.UpsertSpec("o_orderkey", ("o_orderstatus", "o_orderpriority"))
NEW_KEYS = 50


def batch(orders: DataFrame) -> DataFrame:
    """Every third order as fetched again: every second status is gone, prices drift, some priorities change; and new keys."""
    k = F.col("o_orderkey")
    again = orders.where(k % 3 == 0).select(
        "o_orderkey",
        "o_custkey",
        F.when(k % 2 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 7 == 0, "1-URGENT").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    top = orders.agg(F.max("o_orderkey").alias("top"))  # one row
    fresh = top.select(F.explode(F.sequence(F.lit(1), F.lit(NEW_KEYS))).alias("n"), "top").select(
        (F.col("top") + F.col("n")).cast("long").alias("o_orderkey"),
        F.lit(1).cast("long").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        (F.col("n") * 100.0).cast("double").alias("o_totalprice"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    return again.unionByName(fresh)


B = """
b AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus,
    o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice, o_orderdate,
    CASE WHEN o_orderkey % 7 = 0 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT (SELECT max(o_orderkey) FROM orders) + n, 1, 'O', n * 100.0::DOUBLE, TIMESTAMP '1998-01-01', '5-LOW' FROM range(1, 51) r(n)
)"""
COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
MERGED = ", ".join(f"coalesce(b.{c}, o.{c}) AS {c}" for c in COLUMNS)
APPLY_SQL = f"WITH {B} SELECT {MERGED} FROM orders o FULL JOIN b ON o.o_orderkey = b.o_orderkey"
ACTIONS = f"""{B},
a AS (
  SELECT b.o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'new'
    WHEN b.o_orderstatus IS NOT DISTINCT FROM o.o_orderstatus AND b.o_orderpriority IS NOT DISTINCT FROM o.o_orderpriority THEN 'unchanged'
    WHEN coalesce(b.o_orderstatus, o.o_orderstatus) = o.o_orderstatus AND coalesce(b.o_orderpriority, o.o_orderpriority) = o.o_orderpriority THEN 'no_gain'
    ELSE 'updated' END AS action
  FROM b LEFT JOIN orders o ON o.o_orderkey = b.o_orderkey
)"""


@query("ups_merge_row", f"WITH {B} SELECT {MERGED} FROM b LEFT JOIN orders o ON o.o_orderkey = b.o_orderkey")
def ups_merge_row(t: Tables) -> DataFrame:
    return upsert.merge_rows(t("orders"), batch(t("orders")), SPEC)


@query("ups_apply", APPLY_SQL)
def ups_apply(t: Tables) -> DataFrame:
    return upsert.apply_updates(t("orders"), batch(t("orders")), SPEC)


@query("join_full_outer_merge", APPLY_SQL.replace("SELECT coalesce", "SELECT o.o_orderkey IS NOT NULL AS stored, b.o_orderkey IS NOT NULL AS fetched, coalesce"))
def join_full_outer_merge(t: Tables) -> DataFrame:
    o, b = t("orders"), batch(t("orders"))
    sides = o.alias("o").join(b.alias("b"), F.col("o.o_orderkey") == F.col("b.o_orderkey"), "full_outer")
    return sides.select(F.col("o.o_orderkey").isNotNull().alias("stored"), F.col("b.o_orderkey").isNotNull().alias("fetched"), *(upsert.merge_value(F.col(f"b.{c}"), F.col(f"o.{c}")).alias(c) for c in COLUMNS))


@query("ups_classify", f"WITH {ACTIONS} SELECT * FROM a")
def ups_classify(t: Tables) -> DataFrame:
    return upsert.classify(t("orders"), batch(t("orders")), SPEC)


@query("ups_classify_sealed", f"WITH {ACTIONS} SELECT o_orderkey, CASE WHEN o_orderkey < 300 THEN 'sealed' ELSE action END AS action FROM a")
def ups_classify_sealed(t: Tables) -> DataFrame:
    return upsert.classify(t("orders"), batch(t("orders")), SPEC, sealed=t("orders").where("o_orderkey < 300"))


@query("ups_classify_no_gain_off", f"WITH {ACTIONS} SELECT o_orderkey, CASE action WHEN 'no_gain' THEN 'updated' ELSE action END AS action FROM a")
def ups_classify_no_gain_off(t: Tables) -> DataFrame:
    return upsert.classify(t("orders"), batch(t("orders")), SPEC, need_gain=False)


@query("agg_run_stats", f"WITH {ACTIONS} SELECT action, count(*) AS n FROM a GROUP BY action")
def agg_run_stats(t: Tables) -> DataFrame:
    return upsert.run_stats(ups_classify(t))


@query("ups_unchanged", f"WITH {ACTIONS} SELECT o_orderkey FROM a WHERE action = 'unchanged'")
def ups_unchanged(t: Tables) -> DataFrame:
    return upsert.unchanged(t("orders"), batch(t("orders")), SPEC)


@query("ups_adds_anything", f"WITH {ACTIONS} SELECT o_orderkey FROM a WHERE action IN ('new', 'updated')")
def ups_adds_anything(t: Tables) -> DataFrame:
    return upsert.adds_anything(t("orders"), batch(t("orders")), SPEC)


@query(
    "ups_signature",
    f"""WITH {B} SELECT o_orderkey, sha256('{{"o_orderstatus":' || coalesce('"' || o_orderstatus || '"', 'null') || ',"o_orderpriority":' || coalesce('"' || o_orderpriority || '"', 'null') || '}}') AS signature FROM b""",
)
def ups_signature(t: Tables) -> DataFrame:
    return upsert.signature(batch(t("orders")), SPEC)


@query("ups_replace", f"WITH {B}, u AS (SELECT *, 0 AS p FROM b UNION ALL SELECT *, 1 FROM orders) SELECT * EXCLUDE (p, r) FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY p) AS r FROM u) WHERE r = 1")
def ups_replace(t: Tables) -> DataFrame:
    return upsert.replace(t("orders"), batch(t("orders")), "o_orderkey")


URL_CHANGE = f"WITH {B}, c AS (SELECT b.* FROM b LEFT JOIN orders o USING (o_orderkey) WHERE o.o_orderkey IS NULL OR b.o_orderpriority IS DISTINCT FROM o.o_orderpriority)"


@query("flt_new_or_url_changed", f"{URL_CHANGE} SELECT * FROM c")
def flt_new_or_url_changed(t: Tables) -> DataFrame:
    return upsert.url_changes(t("orders"), batch(t("orders")), "o_orderkey", "o_orderpriority")


@query("ups_url_change", f"{URL_CHANGE} SELECT * FROM c UNION ALL SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c)")
def ups_url_change(t: Tables) -> DataFrame:
    return upsert.replace_changed_urls(t("orders"), batch(t("orders")), "o_orderkey", "o_orderpriority")


@query("ups_insert_only", f"WITH {B} SELECT * FROM orders UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = b.o_orderkey)")
def ups_insert_only(t: Tables) -> DataFrame:
    return upsert.insert_only(t("orders"), batch(t("orders")), "o_orderkey")


@query("sink_guard_no_shrink", f"WITH {B}, u AS ({APPLY_SQL.split(B)[1]}) SELECT count(*) AS n FROM u")
def sink_guard_no_shrink(t: Tables) -> DataFrame:
    return layout.not_shrunk(t("orders"), ups_apply(t)).agg(F.count("*").alias("n"))


@query("sink_skip_when_clean", "SELECT CAST(0 AS BIGINT) AS n_written, false AS wrote")
def sink_skip_when_clean(t: Tables) -> DataFrame:
    """A batch equal to the stored table: nothing is written."""
    actions = upsert.classify(t("orders"), t("orders"), SPEC)
    wrote = writers.publish_if_changed(t("orders"), t("orders"), actions, writers.scratch(actions.sparkSession))
    return actions.where("action in ('new', 'updated')").agg(F.count("*").alias("n_written")).withColumn("wrote", F.lit(wrote))


def _streamed(orders: DataFrame, stored: DataFrame, batches: list[DataFrame]) -> MergedTable:
    """``stored`` after each of the batches arrived as files and was merged, micro-batch by micro-batch."""
    spark, place = orders.sparkSession, writers.scratch(orders.sparkSession)
    table = MergedTable(spark, f"{place}/table", SPEC.key)
    table.write(stored, 0)
    for n, fetched in enumerate(batches):
        fetched.write.mode("append").parquet(f"{place}/fetched")
        stream = spark.readStream.schema(fetched.schema).option("maxFilesPerTrigger", 100 if n else 8).parquet(f"{place}/fetched")
        jobs.upsert_stream(stream, table, SPEC, ["o_totalprice"], f"{place}/state").awaitTermination()
    return table


@query("str_micro_batch_upsert", APPLY_SQL)
def str_micro_batch_upsert(t: Tables) -> DataFrame:
    """The batch as a stream of files, merged micro-batch by micro-batch into the stored table."""
    fetched = batch(t("orders"))
    return _streamed(t("orders"), t("orders"), [fetched.where(F.floor(F.col("o_orderkey") / 3) % 3 == part) for part in range(3)]).read()


@query("str_late_fill", APPLY_SQL)
def str_late_fill(t: Tables) -> DataFrame:
    """Stored rows without a status gain it from a later batch of the stream and never lose it again."""
    orders = t("orders")
    bare = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderstatus")))
    return _streamed(orders, bare, [orders, batch(orders)]).read()


@query("sink_compaction", APPLY_SQL.replace("SELECT coalesce", "SELECT 1 AS n_versions, coalesce", 1))
def sink_compaction(t: Tables) -> DataFrame:
    """The stored table after two merges, compacted to one version; the others are removed."""
    fetched = batch(t("orders"))
    table = _streamed(t("orders"), t("orders"), [fetched.where("o_orderkey % 2 = 0"), fetched.where("o_orderkey % 2 = 1")])
    table.compact(table.versions()[-1] + 1)
    return table.read().withColumn("n_versions", F.lit(len(table.versions())))


def _words(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", "p_type", F.explode(F.split("p_name", " ")).alias("tag"))


def _policy_inputs(t: Tables):
    """Stored tags are words of even parts; seen are all words; the dictionary lacks words with an r in them."""
    words = _words(t("part"))
    stored = words.where("p_partkey % 2 = 0").groupBy("tag").agg(F.count("*").alias("n")).where("tag <> 'widget'")
    stored = stored.select("tag", F.when(F.length("tag") % 2 == 0, -1).otherwise(F.length("tag") + 100).alias("id"), F.lit(3).alias("type"), F.lit(7).alias("total"), "n", F.when(F.length("tag") > 4, F.lit("2020-01-01")).otherwise("2024-01-01").cast("timestamp_ntz").alias("refreshed"))
    seen = words.groupBy("tag").agg(F.count("*").alias("n"))
    dictionary = seen.where("tag not like '%r%'").select("tag", (F.length("tag") + 1000).alias("id"), F.when(F.length("tag") == 4, -1).otherwise(F.length("tag")).alias("type"), F.when(F.length("tag") != 5, F.lit(50)).alias("total"))
    return stored, seen, dictionary


POLICY_SQL = """
WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part),
s AS (SELECT tag, count(*) AS n, CASE WHEN len(tag) % 2 = 0 THEN -1 ELSE len(tag) + 100 END AS id, 3 AS type, 7 AS total,
  CASE WHEN len(tag) > 4 THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2024-01-01' END AS refreshed FROM w WHERE p_partkey % 2 = 0 AND tag <> 'widget' GROUP BY tag),
n AS (SELECT tag, count(*) AS n FROM w GROUP BY tag),
d AS (SELECT tag, len(tag) + 1000 AS id, CASE WHEN len(tag) = 4 THEN -1 ELSE len(tag) END AS type, CASE WHEN len(tag) <> 5 THEN 50 END AS total FROM n WHERE tag NOT LIKE '%r%'),
due AS (SELECT tag FROM s WHERE refreshed + INTERVAL 365 DAYS < TIMESTAMP '2024-06-01' ORDER BY refreshed, tag LIMIT 3),
j AS (SELECT n.tag, s.tag IS NOT NULL AS known, d.tag IS NOT NULL AS found, due.tag IS NOT NULL AS turn, s.id AS si, s.type AS st, s.total AS so, d.id AS di, d.type AS dt, d.total AS dn, coalesce(s.n, 0) + n.n AS uses
  FROM n LEFT JOIN s ON s.tag = n.tag LEFT JOIN d ON d.tag = n.tag LEFT JOIN due ON due.tag = n.tag)
SELECT tag, CAST({id} AS INTEGER) AS id, CAST({type} AS INTEGER) AS type, CAST({total} AS INTEGER) AS total, uses AS n FROM j
"""


def _policy(policy: str, missing: int, known: dict[str, str]) -> None:
    unseen = {"id": "coalesce(di, -1)", "type": "coalesce(dt, -1)", "total": f"coalesce(dn, {missing})"}
    sql = POLICY_SQL.format(**{a: f"CASE WHEN NOT known THEN {unseen[a]} ELSE {known[a]} END" for a in unseen})

    @query(f"ups_policy_{policy}", sql)
    def run(t: Tables) -> DataFrame:
        return tags.refresh(*_policy_inputs(t), policy, asof=F.lit("2024-06-01").cast("timestamp_ntz"), budget=3)


def _where(condition: str, missing: int = 0) -> dict[str, str]:
    return {"id": f"CASE WHEN {condition} THEN coalesce(di, -1) ELSE si END", "type": f"CASE WHEN {condition} THEN coalesce(dt, -1) ELSE st END", "total": f"CASE WHEN {condition} THEN coalesce(dn, {missing}) ELSE so END"}


_policy("overwrite_always", 0, _where("true"))
_policy("overwrite_found", 0, _where("found"))
_policy("overwrite_category", 0, _where("found AND dt <> -1"))
_policy("first_sight", 0, {"id": "si", "type": "st", "total": "so"})
_policy("fill_id", -1, {"id": "CASE WHEN found AND si = -1 THEN di ELSE si END", "type": "st", "total": "CASE WHEN found THEN coalesce(dn, -1) ELSE so END"})
_policy("coalesce", 0, {"id": "coalesce(di, si)", "type": "coalesce(dt, st)", "total": "coalesce(dn, so)"})
_policy("embedded", 0, {"id": "CASE WHEN found THEN coalesce(di, si) ELSE si END", "type": "CASE WHEN found THEN coalesce(dt, st) ELSE st END", "total": "CASE WHEN found THEN coalesce(dn, so) ELSE so END"})
_policy("ttl_budget", 0, _where("turn AND found"))


@query("win_dedup_keep_last", "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r = 1")
def win_dedup_keep_last(t: Tables) -> DataFrame:
    return dedup.keep_last(t("conversations"), ["conv_id"], ["turn"])


@query("win_dedup_keep_first", "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1")
def win_dedup_keep_first(t: Tables) -> DataFrame:
    return dedup.keep_first(t("events"), ["user_id"], ["event_id"])


@query("win_dedup_last_write_wins", "SELECT doc_id, n_chars FROM (SELECT doc_id, 0 AS s, n_chars FROM documents UNION ALL SELECT doc_id, 1, -1 FROM labels) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC) = 1")
def win_dedup_last_write_wins(t: Tables) -> DataFrame:
    later = t("labels").select("doc_id", F.lit(-1).cast("long").alias("n_chars"))
    return dedup.last_write_wins([t("documents").select("doc_id", "n_chars"), later], "doc_id")


@query("win_dedup_first_seen", "SELECT user_id, min(event_id) AS first_seen FROM events GROUP BY user_id")
def win_dedup_first_seen(t: Tables) -> DataFrame:
    return dedup.first_seen(t("events"), "user_id", "event_id")


@query("str_dedup_in_run", "SELECT DISTINCT user_id FROM events")
def str_dedup_in_run(t: Tables) -> DataFrame:
    """Each user once in a stream of files; the horizon spans the whole run."""
    e = t("events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return jobs.through_files(e, writers.scratch(e.sparkSession), lambda stream: jobs.once_in_run(stream, "user_id", "ts", "3650 days").select("user_id"))


#: Every document is fetched on the first day, and those with a label again on the second; each tenth fails at first.
LAST = """
o AS (SELECT doc_id, 1 AS day, doc_id % 10 <> 0 AS ok FROM documents WHERE doc_id IS NOT NULL UNION ALL SELECT doc_id, 2, quality = 1 FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL),
l AS (SELECT doc_id, CAST(count(*) FILTER (WHERE NOT ok) AS INTEGER) AS attempts, arg_max(ok, day) AS ok, max(day) AS day FROM o GROUP BY doc_id)"""
DAY = 86_400


def _letters(t: Tables) -> DataFrame:
    """The two days' outcomes, and a row of much later that lets time pass, as a stream of files."""
    spark, place = t("region").sparkSession, writers.scratch(t("region").sparkSession)
    first = t("documents").select("doc_id", (F.col("doc_id") % 10 != 0).alias("ok"), F.lit("2024-01-01").cast("timestamp").alias("at"))
    second = t("labels").select("doc_id", (F.col("quality") == 1).alias("ok"), F.lit("2024-01-02").cast("timestamp").alias("at"))
    later = t("region").limit(1).select(F.lit(-1).cast("long").alias("doc_id"), F.lit(True).alias("ok"), F.lit("2024-01-08").cast("timestamp").alias("at"))
    session = states.stateful_session(spark)
    for rows in (first, second, later):
        rows.write.mode("append").parquet(f"{place}/in")
        stream = session.readStream.schema(rows.schema).parquet(f"{place}/in")
        made = states.dead_letters(stream, "doc_id", "ok", "at", wait=2 * DAY, expire=30 * DAY)
        made.writeStream.format("parquet").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start(f"{place}/out").awaitTermination()
    return spark.read.schema(f"doc_id long, {states.LETTER}").parquet(f"{place}/out")


@query("str_failed_retry", f"WITH {LAST} SELECT doc_id, CAST(0 AS INTEGER) AS priority FROM l WHERE NOT ok UNION ALL SELECT doc_id, 1 FROM l WHERE ok AND doc_id % 7 = 0")
def str_failed_retry(t: Tables) -> DataFrame:
    """What to fetch in the end: failures whose wait is over before others (each seventh document)."""
    due = states.still_failed(_letters(t), "doc_id").where("due IS NOT NULL")
    return jobs.retry_first(due, t("documents").where("doc_id % 7 = 0").select("doc_id").union(t("labels").where("doc_id % 7 = 0 AND quality IS NOT NULL").select("doc_id")), "doc_id")


@query("str_failed_kept", f"WITH {LAST} SELECT doc_id, attempts, CAST(epoch_ms(TIMESTAMP '2024-01-01' + to_days(day - 1) + to_days(CASE attempts WHEN 1 THEN 2 ELSE 4 END)) AS BIGINT) AS due FROM l WHERE NOT ok")
def str_failed_kept(t: Tables) -> DataFrame:
    """The dead letters after all outcomes, and when each was due; the wait doubles with the second failure."""
    return states.still_failed(_letters(t), "doc_id")


@query("join_failed_first", "SELECT doc_id, CAST(CASE WHEN doc_id % 10 = 0 THEN 0 ELSE 1 END AS INTEGER) AS priority FROM labels UNION SELECT doc_id, 0 FROM documents WHERE doc_id % 10 = 0")
def join_failed_first(t: Tables) -> DataFrame:
    """The same of two tables, in one go."""
    return jobs.retry_first(t("documents").where("doc_id % 10 = 0"), t("labels"), "doc_id")


@query("join_failed_kept", "SELECT doc_id FROM documents WHERE doc_id % 10 = 0 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) UNION SELECT doc_id FROM labels WHERE quality <> 1")
def join_failed_kept(t: Tables) -> DataFrame:
    return jobs.still_failed(t("documents").where("doc_id % 10 = 0"), t("labels"), "doc_id", F.col("quality") == 1)
