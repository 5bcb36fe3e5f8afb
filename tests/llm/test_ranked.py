"""Ranked search against every document scored, cuts against every cut, and what is skipped."""

import random
import re

import duckdb
import numpy as np
import pytest

from lakeloom.llm import oracles, ranked


def plain_cost(x, ends, penalty):
    cost, lo = 0, 0
    for hi in ends:
        cost += max(x[lo:hi]) * (hi - lo) - sum(x[lo:hi]) + penalty
        lo = hi
    return cost


def least_cost(x, penalty, longest):
    best = [0.0] + [np.inf] * len(x)
    for j in range(1, len(x) + 1):
        best[j] = min(best[i] + max(x[i:j]) * (j - i) - sum(x[i:j]) + penalty for i in range(max(0, j - longest), j))
    return best[-1]


@pytest.mark.parametrize("cells", [1, 40, 10_000])
def test_blocks_have_the_least_error(cells):
    rng = random.Random(2)
    lists = [np.array([rng.randint(1, 9) ** 3 for _ in range(rng.choice([0, 1, 2, 5, 17, 40]))], dtype=np.int64) for _ in range(30)]
    for x, ends in zip(lists, ranked.block_ends(lists, 150, 8, cells), strict=True):
        assert (len(x) == 0) == (len(ends) == 0)
        if len(x):
            assert ends[-1] == len(x) and all(np.diff(np.r_[0, ends.astype(int)]) > 0) and max(np.diff(np.r_[0, ends.astype(int)])) <= 8
            assert plain_cost(x.tolist(), ends.tolist(), 150) == least_cost(x.tolist(), 150, 8)


def test_terms():
    text = "Ab-ÀB c9_d\x00é漢 \U0001f600x y Z"
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    assert [t.decode() for t in ranked.terms_of(text)] == re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)
    assert ranked.terms_of(None) == ranked.terms_of("") == ranked.terms_of(" ._") == []


def by_sql(folder):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    return sorted(con.execute(oracles.RANKED_SQL).fetchall(), key=repr)


@pytest.fixture(scope="module")
def tables(spark, docs_of, odd_rows, tmp_path_factory):
    folder = tmp_path_factory.mktemp("ranked")
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "漢字", "the"]
    odds = [1 / (1 + i) for i in range(len(words))]
    rows = [(k, " ".join(rng.choices(words, odds, k=rng.randint(0, 90)))) for k in range(500)] + [(1000 + (i or 0), t) for i, t in odd_rows]
    rows += [(5, "w3 w4 w5"), (5, "w3 w4 w5"), (None, "w3 w4 w5"), (600, "w59 " * 500)]
    docs_of(rows, 5).write.parquet(f"{folder}/documents.parquet")
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(20)] + [(3, "w3 W3, w4"), (None, "the THE w7"), (30, None), (31, ""), (32, "absent"), (33, "é É 漢字 passage twice")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.mark.parametrize("settings", [{}, {"shard_docs": 7, "longest": 3, "penalty": 10_000}, {"most_terms": 3, "shard_docs": 50}, {"items_per_block": 4, "shard_docs": 64, "penalty": 0}])
def test_search_equals_every_document_scored(spark, tables, settings):
    docs, items = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "benchmark"))
    got = ranked.rank_documents(docs, items, **settings).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=repr) == by_sql(tables)


def test_query_and_its_sql(spark, tables):
    got = ranked.op11_block_max_wand(spark, tables)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_sql(tables)


def test_empty_and_clashing(spark, docs_of, clashing):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert ranked.rank_documents(docs_of([]), items).count() == 0
    assert ranked.rank_documents(docs_of([(1, "one")]), items.limit(0)).count() == 0
    made = ranked.rank_documents(clashing(docs_of([(1, "one"), (2, "two two"), (3, "three")])), clashing(items)).collect()
    assert [(r["rank"], r.doc_id) for r in sorted(made, key=lambda r: r["rank"])] in ([(1, 1), (2, 2)], [(1, 2), (2, 1)])


def test_ranges_are_skipped():
    """Of documents in runs of like impacts only the runs that reach the threshold are scored, with the same result."""
    rng = np.random.default_rng(1)
    n = 4000
    shard = ranked.Shard(np.arange(n), np.zeros(n, np.uint8))
    level = np.repeat(rng.integers(1, 100, n // 50), 50)
    score = np.zeros(n, np.int64)
    for t in range(6):
        docs = np.sort(rng.choice(n, 2500, replace=False))
        x = (level[docs] * 1000 + rng.integers(0, 500, len(docs))).astype(np.int64)
        ends = ranked.block_ends([x], 20_000, 64)[0]
        tops = np.maximum.reduceat(x, np.r_[0, ends[:-1]].astype(np.int64))
        shard.add(f"t{t}", docs.astype("<u4").tobytes(), x.astype("<u4").tobytes(), ends.tobytes(), tops.astype("<u4").tobytes())
        score[docs] += (t + 1) * x
    (scores, _, ids), scored, of = shard.search([(f"t{t}", t + 1) for t in range(6)], 20, 1, ranked.NONE)
    expected = np.lexsort((np.arange(n), -score))[:20]
    assert ids.tolist() == expected.tolist() and scores.tolist() == score[expected].tolist()
    assert of == n and scored < n / 4
    assert shard.search([("t0", 1)], 20, int(score.max()) + 1, ranked.NONE)[1] == 0
