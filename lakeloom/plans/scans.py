"""Queries of sources and sinks: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import layout, measures
from ..sources import archives, readers, writers
from ..streaming import jobs
from .functions import VOLUME_PATH
from .registry import QUERIES, Tables, query


def _place(t: Tables) -> tuple:
    spark = t("region").sparkSession
    return spark, writers.scratch(spark)


@query("scan_parquet", "SELECT * FROM orders")
def scan_parquet(t: Tables) -> DataFrame:
    return t("orders")


@query("scan_parquet_pandas", "SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS price FROM part")
def scan_parquet_pandas(t: Tables) -> DataFrame:
    dirty = t("part").select("p_partkey", F.when(F.col("p_partkey") % 4 == 0, float("nan")).otherwise(F.col("p_retailprice")).alias("price"))
    return readers.without_nan(dirty)


def _scan_projected(spark, sf_dir):
    return readers.projected(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"], F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))


query("scan_projected", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'")(lambda t: t("lineitem"))
QUERIES["scan_projected"] = _scan_projected
query("scan_footer_count", "SELECT count(*) AS n FROM lineitem")(lambda t: t("lineitem"))
QUERIES["scan_footer_count"] = lambda spark, sf_dir: readers.row_count(spark, f"{sf_dir}/lineitem.parquet")

query("scan_footer_span", "SELECT count(*) AS n, min(l_orderkey) AS least, max(l_orderkey) AS most FROM lineitem")(lambda t: t("lineitem"))
QUERIES["scan_footer_span"] = lambda spark, sf_dir: readers.footer_span(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey")


def _write_parts(df: DataFrame, place: str, parts: int, key: str) -> None:
    """Files x-0 to x-(parts - 1), as an earlier job would have left them."""
    for i in range(parts):
        df.where(F.col(key) % parts == i).coalesce(1).write.parquet(f"{place}/x-{i}.parquet")


@query("scan_shards", "SELECT c_custkey, CAST(c_custkey % 11 AS INTEGER) AS shard FROM customer WHERE c_custkey % 11 = 10")
def scan_shards(t: Tables) -> DataFrame:
    """Eleven shards, of which 10 is the newest (by number, not by name)."""
    spark, place = _place(t)
    _write_parts(t("customer").select("c_custkey"), place, 11, "c_custkey")
    found = spark.read.parquet(f"{place}/*").withColumn("shard", readers.text.shard_number(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)))
    return readers.newest_shard(found)


@query("scan_csv_gz", "SELECT p_partkey, p_name || chr(10) || '\"q\", ' || p_size AS name, p_retailprice FROM part")
def scan_csv_gz(t: Tables) -> DataFrame:
    spark, place = _place(t)
    rows = t("part").select("p_partkey", F.concat("p_name", F.lit('\n"q", '), F.col("p_size")).alias("name"), "p_retailprice")
    rows.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(place)
    return readers.csv_export(spark, place, "p_partkey bigint, name string, p_retailprice double")


@query("scan_latest_dated_file", "SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS day, 'tags-' || strftime(max(o_orderdate), '%Y-%m-%d') || '.csv.gz' AS name FROM orders")
def scan_latest_dated_file(t: Tables) -> DataFrame:
    """A folder with the last export of each month, named by its day; the listing says which is the newest."""
    spark, place = _place(t)
    days = t("orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.max("o_orderdate").alias("day"), F.count("*").alias("n"))
    days.select("n", F.concat(F.lit("tags-"), F.date_format("day", "yyyy-MM-dd"), F.lit(".csv.gz")).alias("file")).write.partitionBy("file").option("compression", "gzip").csv(place)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv.gz").load(place)
    return readers.latest_dated(listed.select(F.regexp_extract("path", "/file=([^/]+)/", 1).alias("file")), "file")


@query("scan_json_state", "SELECT DISTINCT doc_id AS id FROM labels")
def scan_json_state(t: Tables) -> DataFrame:
    spark, place = _place(t)
    parts = t("labels").groupBy(F.floor(F.col("doc_id") / 1000).alias("part"))  # state documents of a thousand ids at most
    parts.agg(F.sort_array(F.collect_set("doc_id")).alias("exist_ids")).drop("part").repartition(4).write.option("lineSep", "\n").json(place)
    return readers.json_state(spark, place, "exist_ids", lines=True)


@query("sink_json_state", "SELECT DISTINCT user_id FROM events")
def sink_json_state(t: Tables) -> DataFrame:
    spark, place = _place(t)
    writers.write_state(t("events"), place, "user_id")
    return spark.read.schema("user_id bigint").json(place)


@query("scan_json_map_keys", "SELECT doc_id AS id FROM labels")
def scan_json_map_keys(t: Tables) -> DataFrame:
    bodies = t("labels").select(F.concat(F.lit('{"files": {"d/'), F.col("doc_id"), F.lit('.jpg": "x", "d/readme.txt": "y"}}')).alias("body"))
    return readers.map_key_ids(bodies, "body")


@query("scan_json_nested", "SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def scan_json_nested(t: Tables) -> DataFrame:
    pages = t("events").select(F.concat(F.lit('{"posts": [{"id": '), F.col("event_id"), F.lit(', "props": '), "props", F.lit("}]}")).alias("body"))
    return readers.json_pages(pages, "body", "struct<id: bigint, props: struct<k: bigint>>", "posts").select("id", F.col("props.k").alias("k"))


@query("scan_json_lenient", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(json_extract(props, '$.k') AS VARCHAR) WHEN 1 THEN 'a "quoted" tag' END AS value, event_id % 4 > 1 AS bad FROM events""")
def scan_json_lenient(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    body = F.when(k == 0, F.col("props")).when(k == 1, '{"k": "a "quoted" tag", "n": 1}').when(k == 2, "<html>")
    read = readers.lenient_objects(t("events").select("event_id", body.alias("body")), "body")
    return read.select("event_id", F.get_json_object("object", "$.k").alias("value"), F.col("error").isNotNull().alias("bad"))


@query("scan_xml", "SELECT n_nationkey AS id, n_name AS name, n_regionkey % 2 = 0 AS ambiguous FROM nation")
def scan_xml(t: Tables) -> DataFrame:
    spark, place = _place(t)
    rows = t("nation").select(F.col("n_nationkey").alias("_id"), F.col("n_name").alias("_name"), (F.col("n_regionkey") % 2 == 0).alias("_ambiguous"))
    rows.write.format("xml").option("rootTag", "tags").option("rowTag", "tag").save(place)
    read = readers.xml_rows(spark, place, "tag", "_id int, _name string, _ambiguous boolean")
    return read.select(F.col("_id").alias("id"), F.col("_name").alias("name"), F.col("_ambiguous").alias("ambiguous"))


@query("scan_html_table", "SELECT n_nationkey, 0 AS pos, n_name AS alias, 'x & y' AS target FROM nation")
def scan_html_table(t: Tables) -> DataFrame:
    body = F.concat(F.lit("<table><tr><th>Alias</th><th>To</th></tr><tr><td><b>"), "n_name", F.lit("</b></td><td>x &amp; y</td></tr></table>"))
    rows = readers.html_tables(t("nation").select("n_nationkey", body.alias("body")), "body", ["n_nationkey"])
    return rows.select("n_nationkey", "pos", F.col("cells")["Alias"].alias("alias"), F.col("cells")["To"].alias("target"))


@query("scan_html_outline", "SELECT p_partkey, p_name AS title, CASE WHEN p_size % 2 = 0 THEN 'c' || p_size ELSE 'unknown' END AS category, CAST(p_partkey % 3 AS INTEGER) AS n_images, 'a & b|' || p_type AS items FROM part")
def scan_html_outline(t: Tables) -> DataFrame:
    """Pages of the kind that describes one thing: a heading, a class of the second one, images, list items."""
    kind = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("c"), "p_size")).otherwise("x y")
    images = F.array_join(F.transform(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (F.col("p_partkey") % 3).cast("int")), lambda i: F.concat(F.lit('<img src="/'), i, F.lit('.png">'))), "")
    body = F.concat(F.lit("<html><h1> "), "p_name", F.lit('</h1><h2 class="'), kind, F.lit('">k</h2>'), images, F.lit("<ul><li>a &amp; b</li><li> <b>"), "p_type", F.lit("</b></li></ul><p>other"))
    found = readers.html_entities(t("part").select("p_partkey", body.alias("body")), "body", ["p_partkey"])
    return found.select("p_partkey", "title", "category", F.size("images").alias("n_images"), F.array_join("items", "|").alias("items"))


#: By the part: which sections its page has, and what stands in them.
ENTITY_SQL = """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_name || ' <&>' ELSE p_name END AS name,
  CASE WHEN p_partkey % 5 = 1 THEN 'unknown' ELSE 'kind' || p_size END AS category, CASE WHEN p_partkey % 5 = 1 THEN 'two kinds' ELSE 'kind' || p_size END AS raw_category,
  CASE WHEN p_partkey % 3 < 2 THEN CAST(p_partkey AS BIGINT) END AS cover_id, CASE WHEN p_partkey % 3 <> 1 THEN 'https://x.example/img/' || p_partkey || '.jpg' END AS cover_url,
  CASE WHEN p_partkey % 6 = 0 THEN '' ELSE 'web=https://y.example/' || p_partkey || ';chat=https://x.example/chat' END AS socials,
  CASE WHEN p_partkey % 6 = 3 THEN '' ELSE 'About **' || p_type || '** & [more](https://x.example/e/more).' END AS description_md,
  'n' || p_size || '=en:true;' || CASE WHEN p_partkey % 2 = 0 THEN 'second=en:true;' ELSE '' END || 'other=also:false' AS aliases, 'en=n' || p_size AS langs,
  CASE WHEN p_partkey % 4 = 1 THEN '' ELSE 'a b;' || p_size || 'é' END AS related_tags, CASE WHEN p_partkey % 4 = 2 THEN 'coat' ELSE '' END AS outfit_tags
FROM part WHERE p_partkey % 11 <> 0"""


@query("scan_html_entity", ENTITY_SQL)
def scan_html_entity(t: Tables) -> DataFrame:
    """Pages with every section, without some, with a blank or no main one; lists and elements that nothing closes."""
    k, lit = F.col("p_partkey"), F.lit
    parts = layout.spread(t("part"), "p_partkey")  # a few bytes of a part become a page: its file's bytes don't say how many tasks that takes
    part = lambda condition, *texts: F.when(condition, F.concat(*(lit(x) if isinstance(x, str) else x for x in texts))).otherwise("")
    name = F.when(k % 4 == 0, F.concat(lit('<h1><a id="copy-link" data-value="'), "p_name", lit(' &lt;&amp;&gt;">copy</a><span>not this</span></h1>'))).otherwise(F.concat(lit("<h1>The <span> "), "p_name", lit(" </span></h1>")))
    main = F.when(k % 22 == 11, lit('<section id="tag-info-wrapper">  </section>')).when(k % 22 == 0, lit("")).otherwise(
        F.concat(lit('<section class="x" id="tag-info-wrapper"><h2 class="'), F.when(k % 5 == 1, "two kinds").otherwise(F.concat(lit(" kind"), "p_size")), lit('">Of a kind</h2><p>unclosed'))
    )
    body = F.concat(
        lit('<html><body><div id="content">'), name, lit("</b></div>"), main, lit("</section>"),
        part(k % 3 < 2, '<div id="tag-cover-wrapper"><a href="/full/', k, '?x=1">'), part(k % 3 != 1, '<img id="tag-cover" src="/img/', k, '.jpg">'), part(k % 3 < 2, "</a></div>"),
        part(k % 6 != 0, '<div id="socials"><a href="https://y.example/', k, '"><s class="icon web"></s></a><p><a href="/no"><s class="deep"></s></a></p><a href="/none">no mark</a><a href="/chat"><s class="chat"></s></a></div>'),
        part(k % 6 != 3, '<div id="description"><p>About <b>', F.col("p_type"), '</b> &amp; <a href="more">more</a>.</p></div>'),
        lit('<div id="aliases"><ul><li class="language"><i> en </i><span data-value="n'), F.col("p_size"), lit('">shown</span>'),
        part(k % 2 == 0, '<li class="x language"><i>en</i><span data-value="second"></span>'), lit('<li><i>no class</i><span data-value="lost"></span><li class="plain"><i>also</i><span data-value="other"></ul></div>'),
        part(k % 4 != 1, '<ul id="tags"><li><a href="/a+b">A</a></li><li class="more"><a href="/rest">…</a></li><li><a href="https://z.example/q/', F.col("p_size"), '%C3%A9?s=1">B</a></li></ul>'),
        part(k % 4 == 2, '<ul id="outfits"><li><a href="coat">C</a></ul>'),
    )
    found = readers.entity_pages(parts.select("p_partkey", body.alias("body"), lit("https://x.example/e/page").alias("url")), "body", "url", ["p_partkey"])
    listed = lambda column, e: F.array_join(F.transform(column, e), ";")
    return found.select(
        "p_partkey", "name", "category", "raw_category", F.col("cover.image_id").alias("cover_id"), F.col("cover.image_url").alias("cover_url"),
        listed("socials", lambda x: F.concat(x["type"], lit("="), x["url"])).alias("socials"), "description_md",
        listed("aliases", lambda x: F.concat(x["name"], lit("="), x["type"], lit(":"), x["is_language"].cast("string"))).alias("aliases"),
        listed(F.map_entries("langs"), lambda x: F.concat(x["key"], lit("="), x["value"])).alias("langs"), F.array_join("related_tags", ";").alias("related_tags"), F.array_join("outfit_tags", ";").alias("outfit_tags"),
    )


@query("scan_html_links", "SELECT n_nationkey, CAST(i AS INTEGER) AS pos, CASE i WHEN 0 THEN 'http://x.org/a/n/' || n_nationkey WHEN 1 THEN 'http://x.org/top?q=1&r=2' ELSE 'https://y.org/' || n_regionkey END AS href, CASE i WHEN 0 THEN n_name WHEN 1 THEN 'a & b' ELSE '' END AS label FROM nation, range(3) t(i)")
def scan_html_links(t: Tables) -> DataFrame:
    """Relative, rooted and whole links, with marks inside labels, an anchor without a target between them."""
    from ..functions.parsing import absolute_url, html_links

    body = F.concat(F.lit('<p><a href="n/'), "n_nationkey", F.lit('"> <b>'), "n_name", F.lit('</b></a><a name="here">no link</a><a href="/top?q=1&amp;r=2">a &amp; b</a> <a href="https://y.org/'), "n_regionkey", F.lit('"></a>'))
    links = t("nation").select("n_nationkey", F.posexplode(html_links(body)).alias("pos", "link"))
    return links.select("n_nationkey", "pos", absolute_url(F.lit("http://x.org/a/b"), F.col("link.href")).alias("href"), F.col("link.label").alias("label"))


@query("scan_html_pages")
def scan_html_pages(t: Tables) -> DataFrame:
    """Links and headings of the raw web pages."""
    from ..functions.parsing import absolute_url, html_links

    links = t("pages").select("page_id", "url", F.posexplode_outer(html_links(F.col("html"))).alias("pos", "link"))
    heads = readers.html_entities(t("pages"), "html", ["page_id"]).select("page_id", "title", F.size("items").alias("n_items"))
    return links.select("page_id", "pos", absolute_url(F.col("url"), F.col("link.href")).alias("href"), F.col("link.label").alias("label")).join(heads, "page_id")


@query("scan_html_ids", r"SELECT page_id, CAST(unnest(regexp_extract_all(html, 'track\((\d+)\)', 1)) AS BIGINT) AS id FROM pages")
def scan_html_ids(t: Tables) -> DataFrame:
    body = F.regexp_replace("html", r"track\((\d+)\)", '{"id": $1, "x": 0}')
    return readers.html_numbers(t("pages").select("page_id", body.alias("body")), "body", ["page_id"])


@query("scan_tar_json", "SELECT o_orderkey AS id, o_orderpriority AS name FROM orders")
def scan_tar_json(t: Tables) -> DataFrame:
    """Archives of a JSON document for each order, read back member by member."""
    spark, place = _place(t)
    _archived(t, place, F.lit(True))
    return _records(archives.tar_files(spark, place))


def _archived(t: Tables, place: str, which: Column) -> None:
    """Tar files with a document for each of the orders that ``which`` names, 1000 ids a file."""
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")))
    rows = t("orders").where(which).select(F.floor(F.col("o_orderkey") / 1000).alias("volume"), "o_orderkey", F.concat("o_orderkey", F.lit(".json")).alias("file"), body.alias("body"))
    archives.write_volumes(rows, place, "o_orderkey", "file", "body")


def _records(members: DataFrame) -> DataFrame:
    body = F.col("content").cast("string")
    return members.select(F.get_json_object(body, "$.id").cast("long").alias("id"), F.get_json_object(body, "$.name").alias("name"))


@query("str_archive_skip", "SELECT o_orderkey AS id, o_orderpriority AS name FROM orders")
def str_archive_skip(t: Tables) -> DataFrame:
    """Two runs of a stream of archives: the second reads those that are new."""
    spark, place = _place(t)
    half = F.floor(F.col("o_orderkey") / 1000) % 2
    for part in range(2):
        _archived(t, f"{place}/in", half == part)
        read = _records(archives.tar_stream(spark, f"{place}/in"))
        read.writeStream.format("parquet").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start(f"{place}/out").awaitTermination()
    return spark.read.schema("id long, name string").parquet(f"{place}/out")


@query("scan_generator", "SELECT r AS doc_id FROM (SELECT unnest(range(min(doc_id), max(doc_id) + 1)) AS r FROM labels) WHERE r NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def scan_generator(t: Tables) -> DataFrame:
    """Ids from the least to the newest known one that aren't known."""
    span = measures.id_span(t("labels"), "doc_id").first()
    return readers.probes(t("labels").sparkSession, t("labels"), "doc_id", span["min_id"], span["max_id"])


@query("proj_recursive_find", "SELECT doc_id, CAST(i AS INTEGER) AS pos, CASE i WHEN 0 THEN 'a' ELSE 'b' END AS name, CASE i WHEN 0 THEN '/p/' || doc_id ELSE '/q' END AS path FROM labels, range(2) t(i)")
def proj_recursive_find(t: Tables) -> DataFrame:
    body = F.concat(F.lit('{"post": {"file": {"name": "a", "path": "/p/'), F.col("doc_id"), F.lit('"}, "more": [{"x": {"name": "b", "path": "/q"}}]}}'))
    return readers.found_objects(t("labels").select("doc_id", body.alias("body")), "body", ["doc_id"])


@query("sink_single_parquet", "SELECT c_custkey, c_name FROM customer")
def sink_single_parquet(t: Tables) -> DataFrame:
    spark, place = _place(t)
    writers.write_sorted(t("customer").select("c_custkey", "c_name"), place, "c_custkey")
    return spark.read.parquet(place)


@query("sink_shard_rotate", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 64 + 3 AS INTEGER) AS shard FROM documents")
def sink_shard_rotate(t: Tables) -> DataFrame:
    _, place = _place(t)
    return writers.write_shards(t("documents").select("doc_id"), place, ["doc_id"], 64, sealed=2).select("doc_id", F.col("shard").cast("int").alias("shard"))


@query("sink_shard_startup_rotate", "SELECT n_nationkey, CAST(CASE WHEN n_nationkey >= 20 THEN 8 ELSE 7 END AS INTEGER) AS at_cap, CAST(CASE WHEN n_nationkey > 20 THEN 8 ELSE 7 END AS INTEGER) AS beyond_cap FROM nation")
def sink_shard_startup_rotate(t: Tables) -> DataFrame:
    """The shard that a run writes, for every number of rows in the open one."""
    choose = lambda at_cap: layout.next_shard_of(F.col("n_nationkey"), F.lit(7), 20, at_cap).cast("int")
    return t("nation").select("n_nationkey", choose(True).alias("at_cap"), choose(False).alias("beyond_cap"))


@query("sink_dated_snapshot", "SELECT CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS ym, CAST(strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS INTEGER) AS ymd, count(*) AS n FROM orders GROUP BY ALL")
def sink_dated_snapshot(t: Tables) -> DataFrame:
    """Snapshots of all orders, one for each month."""
    _, place = _place(t)
    rows = t("orders").select("o_orderkey", "o_orderdate")
    return writers.write_snapshot(rows, place, F.trunc("o_orderdate", "month").cast("timestamp_ntz")).groupBy(F.col("ym").cast("int").alias("ym"), F.col("ymd").cast("int").alias("ymd")).agg(F.count("*").alias("n"))


VOLUMES_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, n_chars AS size, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
r AS (
  SELECT i, CAST(size AS BIGINT) AS size, CAST(0 AS BIGINT) AS volume, CAST(1 AS BIGINT) AS files, CAST(size AS BIGINT) AS bytes FROM d WHERE i = 1
  UNION ALL
  SELECT d.i, d.size, CASE WHEN f THEN r.volume + 1 ELSE r.volume END, CASE WHEN f THEN 1 ELSE r.files + 1 END, CASE WHEN f THEN d.size ELSE r.bytes + d.size END
  FROM r JOIN (SELECT * FROM d) d ON d.i = r.i + 1, LATERAL (SELECT r.files >= 100 OR r.bytes + d.size > 200000 AS f)
)
SELECT volume, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, {path} AS path FROM r GROUP BY volume"""


#: The payload's own sizes; a volume's files as they must come back from it.
PAYLOAD_SQL = VOLUMES_SQL.replace("n_chars AS size", "strlen(coalesce(text, '')) AS size, sha256(coalesce(text, '')) AS sha").replace("SELECT volume, count(*) AS files", "SELECT volume, count(*) AS files, count(*) AS n_intact, sha256(string_agg(d.sha, '' ORDER BY i)) AS digest").replace("CAST(sum(size) AS BIGINT)", "CAST(sum(r.size) AS BIGINT)").replace("FROM r GROUP BY", "FROM r JOIN d USING (i) GROUP BY")


@query("sink_volumes", PAYLOAD_SQL.format(path=VOLUME_PATH))
def sink_volumes(t: Tables) -> DataFrame:
    """The texts packed into tar files; every file read back by its offset and held against its digest."""
    spark, place = _place(t)
    docs = t("documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    packed = layout.pack_volumes(docs, "doc_id", "size", 200_000, 100).withColumn("file", F.concat("doc_id", F.lit(".txt")))
    manifest = archives.write_volumes(packed, place, "doc_id", "file", "text")
    read = archives.fetched(archives.volume_files(spark, place), place)
    number = F.regexp_extract("name", "^[0-9]+", 0).cast("long")
    back = read.groupBy("volume").agg(
        F.count_if((F.sha2("content", 256) == F.col("sha256")) & (F.length("content") == F.col("size"))).alias("n_intact"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(number, "sha256"))), lambda x: x["sha256"]), "").cast("binary"), 256).alias("digest"),
    )  # a volume has 100 files at most
    return manifest.join(back, "volume")


@query("sink_volume_plan", VOLUMES_SQL.format(path=VOLUME_PATH))
def sink_volume_plan(t: Tables) -> DataFrame:
    """Only the plan: which file goes where."""
    _, place = _place(t)
    packed = layout.pack_volumes(t("documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 200_000, 100)
    return writers.write_volumes(packed, place, "doc_id", "n_chars")


@query("str_file_skip", "SELECT c_custkey FROM customer")
def str_file_skip(t: Tables) -> DataFrame:
    """Two runs of one file stream: the second reads only the files that are new."""
    spark, place = _place(t)
    rows = t("customer").select("c_custkey")
    for part in range(2):
        rows.where(F.col("c_custkey") % 2 == part).coalesce(1).write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{place}/in")
        stream.writeStream.format("parquet").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start(f"{place}/out").awaitTermination()
    return spark.read.parquet(f"{place}/out")


@query("str_cursor_resume", "SELECT event_id FROM events")
def str_cursor_resume(t: Tables) -> DataFrame:
    """Files of the newest ids first; a run that stops after two of them, and one that goes on from the stored cursor."""
    spark, place = _place(t)
    ids, span = t("events").select("event_id"), measures.id_span(t("events"), "event_id").first()
    width = (span["max_id"] - span["min_id"]) // 5 + 1
    for part in reversed(range(5)):
        ids.where(F.floor((F.col("event_id") - span["min_id"]) / width) == part).coalesce(1).write.mode("append").parquet(f"{place}/in")
    for most in (2, None):
        jobs.in_batches(spark.readStream.schema(ids.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/in"), place, most)
    return spark.read.parquet(f"{place}/out").drop("batch")


@query("str_windowed_counts", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def str_windowed_counts(t: Tables) -> DataFrame:
    """Event-time windows over a stream of files; the whole result of each micro-batch replaces the one before."""
    spark, place = _place(t)
    e = t("events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    e.repartition(4).write.parquet(f"{place}/in")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(f"{place}/in")
    counts = jobs.windowed_counts(stream, "ts", "event_type", "1 day")
    counts.writeStream.outputMode("complete").option("checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{place}/out")).start().awaitTermination()
    return spark.read.parquet(f"{place}/out").withColumn("start", F.col("start").cast("timestamp_ntz"))
