"""Operators on small made-up rows: the rules, and nulls, ties, repeats and empty tables."""

import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import coerce, outcomes, pages, parsing, text, times
from lakeloom.operators import conform, dedup, filters, joins, layout, measures, ordered, tags, upsert
from lakeloom.plans import report
from lakeloom.sources import readers, writers
from lakeloom.streaming import jobs
from lakeloom.streaming.tables import MergedTable

POST = "id long, md5 string, tags array<string>, deleted boolean, score int, url string"
SPEC = upsert.UpsertSpec("id", ("md5", "tags", "deleted"), ("tags",))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame([(1, "a", ["x", "y"], False, 5, "u1"), (2, "b", [], True, None, None), (3, None, None, None, 0, "u3"), (4, "d", ["z"], False, 1, "u4")], POST)


def test_nulls_never_overwrite_but_empty_values_do(spark, stored):
    batch = spark.createDataFrame([(1, None, [], None, 0, ""), (2, "", None, False, 7, "u2"), (9, "n", None, None, None, None)], POST)
    got = {r.id: tuple(r)[1:] for r in upsert.apply_updates(stored, batch, SPEC).collect()}
    assert got[1] == ("a", [], False, 0, "") and got[2] == ("", [], False, 7, "u2")
    assert got[9] == ("n", None, None, None, None) and got[4] == ("d", ["z"], False, 1, "u4") and len(got) == 5


def test_applying_twice_changes_nothing(spark, stored):
    batch = spark.createDataFrame([(1, "q", None, True, None, None), (7, None, ["k"], None, 1, None)], POST)
    once = upsert.apply_updates(stored, batch, SPEC)
    assert rows(upsert.apply_updates(once, batch, SPEC)) == rows(once)
    assert {r.action for r in upsert.classify(once, batch, SPEC).collect()} <= {"unchanged", "no_gain"}


def test_actions(spark, stored):
    batch = spark.createDataFrame([(1, "a", ["y", "x"], False, 99, "new"), (2, None, [], True, 1, None), (3, None, [], None, 0, "u3"), (4, "e", ["z"], False, 1, "u4"), (5, "f", None, None, None, None)], POST)
    act = lambda **k: {r.id: r.action for r in upsert.classify(stored, batch, SPEC, **k).collect()}
    assert act() == {1: "unchanged", 2: "no_gain", 3: "updated", 4: "updated", 5: "new"}
    assert act(need_gain=False)[2] == "updated"
    assert act(sealed=stored.where("id = 4"))[4] == "sealed"
    lists = upsert.UpsertSpec("id", ("tags",))
    assert upsert.classify(stored, batch.where("id = 1"), lists).first().action == "updated"
    assert upsert.classify(stored, batch.drop("md5"), SPEC).where("id = 1").first().action == "no_gain"


def test_signatures_tell_null_from_empty(spark):
    df = spark.createDataFrame([(1, None, [], None, 0, ""), (2, None, None, None, 0, ""), (3, "", None, None, 0, ""), (4, None, ["a", "b"], None, 0, ""), (5, None, ["b", "a"], None, 0, "")], POST)
    made = {r.id: r.signature for r in upsert.signature(df, SPEC).collect()}
    assert made[4] == made[5] and len(set(made.values())) == 4
    assert upsert.signature(df.drop("tags"), SPEC).count() == 5


def test_maps_compare_without_order(spark):
    spec = upsert.UpsertSpec("id", ("m",))
    one = spark.sql("select 1L as id, map('a', 1, 'b', 2) as m")
    assert upsert.classify(one, spark.sql("select 1L as id, map('b', 2, 'a', 1) as m"), spec).first().action == "unchanged"


def test_replace_insert_only_and_urls(spark, stored):
    batch = spark.createDataFrame([(1, None, None, None, None, "u1"), (2, "n", None, None, None, "u2"), (8, None, None, None, None, None)], POST)
    assert {r.id: r.md5 for r in upsert.replace(stored, batch, "id").collect()} == {1: None, 2: "n", 3: None, 4: "d", 8: None}
    assert {r.id for r in upsert.url_changes(stored, batch, "id", "url").collect()} == {2, 8}
    assert {r.id: r.md5 for r in upsert.insert_only(stored, batch, "id").collect()} == {1: "a", 2: "b", 3: None, 4: "d", 8: None}


def test_upsert_of_empty_tables(spark, stored):
    none = stored.limit(0)
    assert rows(upsert.apply_updates(none, stored, SPEC)) == rows(stored) == rows(upsert.apply_updates(stored, none, SPEC))
    assert upsert.classify(stored, none, SPEC).count() == 0


def test_keep_last_and_first(spark):
    df = spark.createDataFrame([(0, 3, "a"), (1, 1, "b"), (2, 2, "c"), (3, 1, "B"), (4, 3, "A"), (None, 3, "n"), (5, None, "x"), (6, None, "y")], "seq int, id int, mark string")
    assert {r.id: r.mark for r in dedup.keep_last(df, ["id"], ["seq"]).collect()} == {1: "B", 2: "c", 3: "A", None: "y"}
    assert {r.id: r.mark for r in dedup.keep_first(df, ["id"], ["seq"]).collect()} == {1: "b", 2: "c", 3: "n", None: "x"}
    assert dedup.keep_last(df.limit(0), ["id"], ["seq"]).count() == 0


@pytest.mark.parametrize("ranges", [1, 4, 64])
def test_numbers_run_through_ranges(spark, ranges):
    rng = random.Random(1)
    data = [(rng.choice([None, 1, 1, 1, *range(50)]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, i int")
    order = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = ordered.running(df, ["k", "i"], {"n": F.lit(1), "s": F.col("i")}, ranges=ranges).collect()
    assert [(r.k, r.i) for r in sorted(got, key=lambda r: r.n)] == order and sorted(r.n for r in got) == list(range(1, 301))
    assert max(got, key=lambda r: r.n).s == sum(range(300))
    assert ordered.numbered(df.limit(0), ["k", "i"]).count() == 0
    with pytest.raises(ValueError):
        ordered.chunked(df, ["k", "i"], 0)


@pytest.mark.parametrize("lead", [1, None])
def test_one_lead_value_is_parted_by_the_other_columns(spark, lead):
    """All rows agree in the first column; no range holds more than a few of them."""
    from pyspark.sql.window import Window

    df = spark.range(3000).select(F.lit(lead).cast("int").alias("k"), F.to_timestamp_ntz(F.concat(F.lit("2024-01-01 00:00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"))).alias("at"), F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("tag"))
    sizes = [r["count"] for r in ordered.dealt(df, ["k", "at", "tag"], ranges=16).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3000 / 16 * 2
    got = ordered.numbered(df, ["k", "at", "tag"], "n").withColumn("m", F.row_number().over(Window.orderBy("k", "at", "tag")))
    assert got.where("n <> m").count() == 0 and got.count() == 3000


def test_many_ranges_of_seven_columns(spark):
    """The plan doesn't grow with the ranges, and the numbers are those of one sort."""
    from pyspark.sql.window import Window

    order = ["a", "b", "c", "d", "e", "f", "id"]
    df = spark.range(20_000).select(F.lit(1).alias("a"), (F.col("id") % 2).alias("b"), F.when(F.col("id") % 5 > 0, F.col("id") % 5 / 3.0).alias("c"), F.concat(F.lit("x"), F.col("id") % 7).alias("d"), F.to_date(F.lit("2024-01-01")).alias("e"), (F.col("id") % 3 == 0).alias("f"), "id")
    placed = ordered.dealt(df, order, ranges=1000)
    assert placed.select("_range").distinct().count() > 900
    nulls_last = [F.col(c).asc_nulls_last() for c in order]
    got = ordered.numbered(df, order, "n", ranges=1000)
    assert got.withColumn("m", F.row_number().over(Window.orderBy(*nulls_last))).where("n <> m").count() == 0 and got.count() == 20_000
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 20_000


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_streaks_run_through_ranges(spark, ranges):
    rng = random.Random(9)
    data = [(i, rng.choice([None, True, True, True, True, False]) if i < 150 else True) for i in range(300)]
    got = {r.i: r.streak for r in ordered.streaks(spark.createDataFrame(data, "i int, hit boolean"), ["i"], F.col("hit"), ranges=ranges).collect()}
    run = 0
    for i, hit in data:
        run = run + 1 if hit else 0
        assert got[i] == run
    assert ordered.streaks(spark.createDataFrame([], "i int, hit boolean"), ["i"], F.col("hit")).count() == 0


def test_the_open_shard_of_many_tables(spark):
    df = spark.createDataFrame([(19,), (20,), (21,)], "n int")
    for at_cap in (True, False):
        got = [r.s for r in df.select(layout.next_shard_of(F.col("n"), F.lit(7), 20, at_cap).alias("s")).collect()]
        assert got == [layout.next_shard(n, 7, 20, at_cap) for n in (19, 20, 21)]


def test_quotes_are_repaired_in_linear_time(spark):
    import time

    from lakeloom.functions import parsing

    body = '{"k": "' + 'a "b" ' * 60_000 + '"}'
    began = time.perf_counter()
    assert parsing.repair_quotes(body) == '{"k": "' + 'a \\"b\\" ' * 60_000 + '"}'
    assert time.perf_counter() - began < 5


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from lakeloom.session import shared_folder

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("spark://host:7077", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError):
        shared_folder(session("spark://host:7077"))


def plain_volumes(sizes, budget, cap):
    out, volume, files, held = [], -1, 0, 0
    for s in sizes:
        s = s or 0
        if volume < 0 or files >= cap or (files and held + s > budget):
            volume, files, held = volume + 1, 0, 0
        files, held = files + 1, held + s
        out.append(volume)
    return out


@pytest.mark.parametrize(("budget", "cap", "seed"), [(100, 7, 1), (100, 1, 2), (30, 50, 3), (10**6, 9, 4), (10**6, 10**4, 5)])
def test_packing_equals_the_sequential_fold(spark, budget, cap, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([None, 0, 1, 100, 30, 70, 250, rng.randint(1, 60)]) for _ in range(400)]
    ids = sorted(rng.sample(range(5000), 400))
    df = spark.createDataFrame(list(zip(ids, sizes, strict=True)), "id long, size long").repartition(5)
    for ranges in (1, 3, 60):
        got = [r.volume for r in layout.pack_volumes(df, "id", "size", budget, cap, ranges).orderBy("id").collect()]
        assert got == plain_volumes(sizes, budget, cap)
    assert layout.pack_volumes(df.limit(0), "id", "size", budget, cap).count() == 0


def test_shards_keep_all_rows_below_the_cap(spark, tmp_path):
    df = spark.range(20)
    got = writers.write_shards(df, str(tmp_path / "t"), ["id"], 4, sealed=1).groupBy("shard").count().collect()
    assert sorted((r.shard, r["count"]) for r in got) == [(k, 4) for k in range(2, 7)]
    assert layout.next_shard(4, 1, 4) == 2 and layout.next_shard(4, 1, 4, full_at_cap=False) == 1


def test_a_shrunk_table_is_refused(spark, tmp_path):
    with pytest.raises(PySparkException):
        writers.publish(spark.range(5), spark.range(4), str(tmp_path / "p"))
    writers.publish(spark.range(5), spark.range(6), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 6


def test_score_equals_a_plain_fold(spark):
    rng = random.Random(3)
    data = [(k, i, rng.random() < 0.4) for i in range(600) for k in (1, 2)]
    got = {r.k: r.score for r in measures.success_score(spark.createDataFrame(data, "k int, i long, ok boolean"), "k", "i", F.col("ok"), 0.1, slice_width=50).collect()}
    for key in (1, 2):
        s = 1.0
        for k, _, ok in data:
            if k == key:
                s = max(0.35, s + 0.1 * ((1 if ok else 0) - s))
        assert got[key] == pytest.approx(s, abs=1e-8)


def test_rate_adapts(spark):
    data = [("h", i, True, float(i)) for i in range(50)] + [("h", 50, False, 50.0), ("h", 51, False, 51.0), ("h", 52, False, 52.5), ("g", 0, False, 0.0)]
    df = spark.createDataFrame(data, "host string, seq int, ok boolean, at double")
    assert {r.host: r.rate for r in measures.adapted_rate(df, "host", "seq", "ok").collect()} == {"h": pytest.approx(5 * 0.7 * 0.7), "g": pytest.approx(2.8)}


def test_streaks_reset(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 5), (4, 0), (5, None), (6, 0), (7, 0)], "page int, n int")
    assert [r.streak for r in measures.empty_streaks(df, "page", "n").orderBy("page").collect()] == [1, 2, 0, 1, 0, 1, 2]


def test_conform(spark):
    df = spark.createDataFrame([("7", None, 2.5, "x")], "id string, gone string, score double, extra string")
    want = T.StructType([T.StructField("id", T.LongType()), T.StructField("score", T.IntegerType()), T.StructField("added", T.ArrayType(T.StringType())), T.StructField("gone", T.BooleanType())])
    made = conform.conform(df, want)
    assert made.dtypes == [("id", "bigint"), ("score", "int"), ("added", "array<string>"), ("gone", "boolean")] and made.first().id == 7
    empty = T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.ArrayType(T.StructType([])))]))])
    assert conform.with_placeholders(empty).simpleString() == "struct<a:struct<b:array<struct<__dummy:string>>>>"


def test_ranges_of_ids(spark):
    of = lambda s: sorted(r.id for r in filters.id_ranges(spark.createDataFrame([(s,)], "ids string")).collect())
    assert of("100-105,200, 103") == [100, 101, 102, 103, 104, 105, 200] and of(" , ") == [] and of(None) == []
    for bad in ("9-1", "1-2000000", "abc"):
        with pytest.raises(PySparkException):
            of(bad)


def test_coercions(spark):
    of = lambda body: spark.range(1).select(coerce.int_from_json(F.lit(body), "$.v").alias("v")).first().v
    assert [of(f'{{"v": {x}}}') for x in ("true", "8.5", "8.0", '"42"', '" 7 "', '"8.0"', "null", "[]")] == [None, None, 8, 42, 7, None, None, None]
    assert of("not json") is None


def test_durations(spark):
    of = lambda s, **k: spark.range(1).select(times.duration_seconds(F.lit(s).cast("string"), **k).alias("v")).first().v
    assert [of(s) for s in ("5h", "48min", "2d", "1h30m", "90")] == [18000, 2880, 172800, 5400, 90]
    assert of("none", allow_none=True) is None and of(None, allow_none=True) is None
    with pytest.raises(PySparkException):
        of("bad-duration")


def test_iso_times(spark):
    of = lambda s: spark.range(1).select(times.iso_epoch(F.lit(s).cast("string")).alias("v")).first().v
    assert of("2024-01-01T00:00:00.5+09:00") == 1704034800.5 and of("2024-01-01T00:00:00Z") == 1704067200
    assert [of(s) for s in (None, "", "soon")] == [None] * 3


def test_tags_wrap_and_split(spark):
    of = lambda w: spark.createDataFrame([(w,)], "w array<string>").select(text.wrap_tags(F.col("w")).alias("v")).first().v
    assert of(["a", "b"]) == " a b " and of([]) == " "
    split = spark.createDataFrame([(None,), ("",), ("  ",), (" a　b a ",)], "s string").select(text.split_ws(F.col("s")).alias("v")).collect()
    assert [r.v for r in split] == [None, [], [], ["a", "b", "a"]]


def test_files_and_colors(spark):
    df = spark.createDataFrame([("x-12.parquet", [255, 0, 10]), ("x.parquet", [1, 2]), (None, None), ("a/b.tar.gz", [1, 2, 300])], "p string, c array<int>")
    got = df.select(text.shard_number(F.col("p")).alias("n"), text.hex_color(F.col("c")).alias("c"), text.file_type(F.col("p")).alias("t")).collect()
    assert [(r.n, r.c, r.t) for r in got] == [(12, "#ff000a", None), (-1, None, None), (-1, None, None), (-1, None, "archive")]


def test_lenient_json(spark):
    bodies = ['{"t": "a "b" c", "id": 1}', '{"id": 2}', "<html>", "[1]", "", None, "{}", "[" * 5000]
    got = readers.lenient_objects(spark.createDataFrame([(b,) for b in bodies], "body string"), "body").collect()
    by = {r.body: (r.object, r.error) for r in got}
    assert '\\"b\\"' in by[bodies[0]][0] and by[bodies[1]] == (bodies[1], None)
    assert all(by[b][0] is None and by[b][1] for b in bodies[2:])


def test_links_and_markdown(spark):
    page = '<h1>T</h1><p>See <a href="/x?a=1">it</a> <b>now</b>'
    df = spark.createDataFrame([(page, "https://x.example/d/"), (None, None)], "h string, u string")
    got = df.select(parsing.html_links(F.col("h")).alias("k"), parsing.html_to_markdown(F.col("h"), F.col("u")).alias("m")).collect()
    assert got[0].k[0].href == "/x?a=1" and "[it](https://x.example/x?a=1) **now**" in got[0].m
    assert got[1].m is None


def test_outcomes(spark):
    df = spark.createDataFrame([(404, None), (410, "x"), (403, None), (429, None), (503, None), (None, "undecodable"), (None, "size_mismatch"), (None, None)], "s int, k string")
    assert [r.o for r in df.select(outcomes.classify_error(F.col("s"), F.col("k")).alias("o")).collect()] == ["permanent", "permanent", "blocked", "rate_limit", "rate_limit", "permanent", "transient", "transient"]


def test_strict_join_raises_and_coverage_counts(spark):
    children, parents = spark.createDataFrame([(1, 1), (2, 9)], "c int, p int"), spark.createDataFrame([(1, "x")], "id int, name string")
    assert rows(joins.strict_inner(children.where("c = 1"), parents, "p", "id")) == [(1, 1, "x")]
    with pytest.raises(PySparkException):
        joins.strict_inner(children, parents, "p", "id").collect()
    assert rows(joins.coverage(spark.range(5), spark.range(3, 9), "id")) == [(2, 3, 4)]
    assert rows(joins.coverage(spark.range(0), spark.range(0), "id")) == [(0, 0, 0)]


def test_renamed_tags_add_up(spark):
    totals = spark.createDataFrame([("a", 2), ("b", 5)], "tag string, n long")
    assert rows(tags.merged_totals(totals, spark.createDataFrame([("a", "b")], "tag string, target string"))) == [("b", 7)]
    with pytest.raises(ValueError):
        tags.refresh(totals, totals, totals, "no such policy")


def test_report_renders(spark):
    posts = spark.createDataFrame([(1, "a|b"), (2, None)], "id int, name string")
    made = report.markdown_report("posts", posts, "id", spark.createDataFrame([("x", "t", 3)], "tag string, type string, n long"), "type")
    assert "2 rows (n<1K)" in made and "a\\|b" in made and "### t" in made


def test_a_stream_of_files_merges_once(spark, tmp_path, stored):
    batch = spark.createDataFrame([(1, "z", None, None, 1, None), (1, "y", None, None, 2, None), (6, "n", None, None, 1, None)], POST)
    batch.write.parquet(str(tmp_path / "in"))
    table = MergedTable(spark, str(tmp_path / "table"), "id")
    table.write(stored, 0)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
        jobs.upsert_stream(stream, table, SPEC, ["score"], str(tmp_path / "state")).awaitTermination()
    assert {r.id: r.md5 for r in table.read().collect()} == {1: "y", 2: "b", 3: None, 4: "d", 6: "n"}


def test_versions_stay_until_they_go(spark, tmp_path):
    rows_ = spark.createDataFrame([(i, "a", i) for i in range(100)] + [(None, "n", 1)], "id long, mark string, n long")
    table = MergedTable(spark, str(tmp_path / "t"), "id")
    table.write(rows_, 0, bits=3)
    change = spark.createDataFrame([(3, "b", None), (200, "new", 5), (None, "m", 2)], "id long, mark string, n int")
    for version in (1, 2, 2):  # the last one runs again
        table.merge(change, version)
    assert table.versions() == [0, 1, 2]
    content = lambda v=None: sorted(map(tuple, table.read(v).collect()), key=repr)
    expected = sorted([*((i, "b" if i == 3 else "a", i) for i in range(100)), (200, "new", 5), (None, "n", 1), (None, "m", 2), (None, "m", 2)], key=repr)
    assert content() == expected and table.read(0).where("mark = 'b'").count() == 0 and table.read(0).count() == 101
    assert sum(p["kind"] == "part" and p["version"] > 0 for p in table.parts(2)) == 0  # nothing stored was written again
    table.compact(3, keep=2)
    assert table.versions() == [2, 3] and content() == content(2) == expected
    assert not any(p["kind"] == "batch" for p in table.parts(3))
    table.compact(4)
    assert table.versions() == [4] and content() == expected


def test_random_merges_equal_one_after_another(spark, tmp_path):
    """Batches of random keys write little, parts are split and joined to stay within bounds, and the rows are those of plain upserts."""
    rng = random.Random(3)
    schema = "id long, mark string, n long, body string"
    stored = {i: (i, "a", None, "x" * 200) for i in range(2000)}
    table = MergedTable(spark, str(tmp_path / "t"), "id", part_bytes=8_000, most_batches=2)
    table.write(spark.createDataFrame(list(stored.values()), schema), 0, bits=1)
    size = lambda v: sum(p["bytes"] for p in table.parts(v) if p["version"] == v)
    for version in range(1, 9):
        some = {i: (i, rng.choice([None, f"m{version}"]), rng.choice([None, version]), "".join(rng.choices("abcdefgh", k=300))) for i in rng.sample(range(4000), 60)}
        table.merge(spark.createDataFrame(list(some.values()), schema), version)
        for i, new in some.items():
            stored[i] = tuple(n if n is not None else o for n, o in zip(new, stored.get(i, new), strict=True))
        if version < 3:
            assert all(p["kind"] == "batch" for p in table.parts(version) if p["version"] == version) and size(version) < 60 * 300 * 3
        assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(stored.values(), key=repr)
    assert len({(p["bits"], p["slot"]) for p in table.parts(8) if p["kind"] == "part"}) > 2
    assert len([p for p in table.parts(8) if p["kind"] == "batch"]) <= 5
    old = table.read(3)
    before = sorted(map(tuple, old.collect()), key=repr)
    table.compact(9, keep=10)
    assert sorted(map(tuple, table.read(3).collect()), key=repr) == before
    held = [p["bytes"] for p in table.parts(9) if p["kind"] == "part"]
    assert sum(held) / len(held) <= 2 * 8_000 and max(held) < 6 * 8_000
    small = MergedTable(spark, str(tmp_path / "t"), "id", part_bytes=1 << 24)
    small.compact(10)
    assert len(small.parts(10)) == 1 and sorted(map(tuple, small.read().collect()), key=repr) == sorted(stored.values(), key=repr)


def test_an_empty_table_takes_batches(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path / "t"), "id")
    table.write(spark.createDataFrame([], "id long, mark string"), 0)
    table.merge(spark.createDataFrame([], "id long, mark string"), 1)
    table.merge(spark.createDataFrame([(1, "a")], "id long, mark string"), 2)
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")]
    table.compact(3)
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")]


def test_a_run_that_stops_goes_on_from_its_cursor(spark, tmp_path):
    place = str(tmp_path)
    for k in range(6):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(f"{place}/in")
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{place}/in")
    ids = lambda: sorted(r.id for r in spark.read.schema("id long").parquet(f"{place}/out").collect())
    done = jobs.in_batches(stream(), place, most_batches=2)
    assert 2 <= done < 6 and len(ids()) < 60
    assert jobs.in_batches(stream(), place) == 6 and ids() == list(range(60))
    spark.range(60, 65).coalesce(1).write.mode("append").parquet(f"{place}/in")
    assert jobs.in_batches(stream(), place) == 7 and ids() == list(range(65))
    assert jobs.in_batches(stream(), place) == 7


def test_streams_of_windows_dedup_and_rates(spark, tmp_path):
    data = [(i, "h", i % 3 != 0, float(i), datetime(2024, 1, 1, 0, i)) for i in range(12)] * 2
    df = spark.createDataFrame(data, "id int, host string, ok boolean, at double, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))

    def run(stream, name, mode):
        stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start().awaitTermination()
        return spark.table(name).collect()

    assert sum(r.n for r in run(jobs.windowed_counts(read(), "ts", "host"), "windows", "complete")) == 24
    assert len(run(jobs.once_in_run(read(), "id", "ts"), "once", "append")) == 12
    assert 0.5 <= run(jobs.adapted_rates(read(), "host", "ok", "at"), "rates", "update")[0].rate <= 64


def test_pages_as_trees():
    page = pages.tree('<div id="a" class="x y"><p>one<p>two <b>bold</b></div></i><ul><li>1<li class="more">2<img src="s"></ul><br/>tail')
    assert [e.tag for e in page.elements()] == ["div", "p", "p", "b", "ul", "li", "li", "img", "br"]
    assert [e.text() for e in page.find("div.x.y#a > p")] == ["one", "two bold"]
    assert page.find("div b") and not page.find("div > b") and page.first("li.more").find("img")[0].attrs == {"src": "s"}
    assert page.first("div").inner_html() == "<p>one</p><p>two <b>bold</b></p>" and page.first("none") is None
    assert pages.tree('<p title="&lt;a&gt;">x &amp; &lt;y&gt;</p>').inner_html() == '<p title="&lt;a&gt;">x &amp; &lt;y&gt;</p>'
    deep = pages.tree("<div>" * 20_000 + "x")
    assert deep.text() == "x" and sum(1 for _ in deep.elements()) == 20_000 and deep.inner_html().count("</div>") == 20_000


def test_entity_pages_with_missing_parts():
    base = "https://x.example/e/"
    assert pages.entity_of(None, base) is None and pages.entity_of("", base) is None
    assert pages.entity_of('<section id="tag-info-wrapper"> </section>', base) is None
    bare = pages.entity_of('<section id="tag-info-wrapper">x</section>', base)
    assert bare == (None, "unknown", None, (None, None), [], "", [], {}, [], [])
    odd = pages.entity_of('<section id="tag-info-wrapper"><h2 class="a,b">x</h2></section><div id="tag-cover-wrapper"><a href="/no/number">y</a></div><ul id="tags"><li>no link</li><li><a>none</a></li><li><a href="http://[">bad</a></li></ul><div id="aliases"><ul><li class="language">z</li></ul></div>', base)
    assert odd[1:4] == ("unknown", "a,b", (None, None)) and odd[6:] == ([(None, "", True)], {"": None}, [], [])


def test_footers_answer_counts(spark, tmp_path):
    place = str(tmp_path / "t")
    spark.range(1000).select("id", F.concat(F.lit("x"), "id").alias("s")).repartition(3).write.parquet(place)
    counted = readers.row_count(spark, place)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and counted.first().n == 1000
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert tuple(readers.footer_span(spark, place, "id").first()) == (1000, 0, 999)
    spark.range(5).write.option("parquet.column.statistics.enabled", "false").parquet(str(tmp_path / "bare"))
    assert tuple(readers.footer_span(spark, str(tmp_path / "bare"), "id").first()) == (5, 0, 4)
    spark.range(0).write.parquet(str(tmp_path / "none"))
    assert readers.row_count(spark, str(tmp_path / "none")).first().n == 0 and tuple(readers.footer_span(spark, str(tmp_path / "none"), "id").first()) == (0, None, None)


def test_a_map_becomes_columns(spark):
    df = spark.createDataFrame([(1, {"en": "a", "ja": "b"}), (2, {"JA": "c", "é x": None}), (3, None), (4, {})], "id int, langs map<string,string>")
    made = conform.pivoted_map(df, "langs", "lang_")
    assert made.columns == ["id", "lang_JA", "lang_en", "lang_é x"]
    assert sorted(map(tuple, made.collect())) == [(1, "b", "a", ""), (2, "c", "", ""), (3, "", "", ""), (4, "", "", "")]
    with pytest.raises(ValueError):
        conform.pivoted_map(df, "langs", "lang_", most=2)
    assert conform.pivoted_map(df.limit(0), "langs", "lang_").columns == ["id"]


def test_size_labels_end_where_the_query_says(spark):
    counts = spark.createDataFrame([(9_999_999,), (10_000_000,), (36_000_000,), (10**12,)], "n long")
    of = lambda **labels: [r[0] for r in counts.orderBy("n").select(text.size_bucket(F.col("n"), **labels)).collect()]
    assert of() == ["1M<n<10M", "10M<n<100M", "10M<n<100M", "n>1T"]
    assert of(last="10M", beyond="more") == ["1M<n<10M", "more", "more", "more"]


def test_the_size_query_labels_ten_million_rows_as_its_sql(spark, tmp_path):
    from lakeloom.plans.catalog import QUERIES

    for name, n in (("orders", 10_000_000), ("region", 5), ("lineitem", 1000)):
        spark.range(n).write.parquet(str(tmp_path / f"{name}.parquet"))
    made = QUERIES["fn_size_bucket"](spark, str(tmp_path)).collect()
    assert {r.table_name: r.size_bucket for r in made} == {"orders": "more", "region": "n<1K", "lineitem": "1K<n<10K"}


def test_a_part_is_written_by_many_tasks(spark, tmp_path):
    """However few parts a table has at first, no task holds all of one."""
    table = MergedTable(spark, str(tmp_path / "t"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.write(spark.range(20_000), 0, bits=0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(table.parts(0)) == 1 and len(list((tmp_path / "t/v0/parts/slot=0").glob("*.parquet"))) > 1
    assert table.read().count() == 20_000
