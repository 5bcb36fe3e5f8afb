"""Mixing against a plain walk, flows against every split of small cases."""

import itertools
import random
import re
import struct

import pytest
import xxhash

from lakeloom.llm import mixing


def content(doc_id, words):
    """Spark's hash of (7, doc_id, words), nulls left out, without its last four bits."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", 7), 42)
    for v in (doc_id, words):
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return h >> 4


def plain_targets(sizes):
    """The level at which sources filled in proportion to their weights hold all words, found by halving."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, lo, hi = 1.5 * sum(sizes.values()), 0.0, 2.0 * max(sizes.values(), default=0) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * sizes[s], weight[s] * mid) for s in order) < total else (lo, mid)
    return {s: min(2 * sizes[s], weight[s] * hi) for s in order}


def plain_mix(rows):
    """(doc_id, size, source_size, target, taken) of (doc_id, source, text) rows."""
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in rows]
    sizes = {}
    for _, s, n in sized:
        sizes[s] = sizes.get(s, 0) + n
    want = plain_targets(sizes)
    out = []
    for s in sizes:
        mine = sorted((r for r in sized if r[1] == s), key=lambda r: content(r[0], r[2]))
        whole, left = divmod(round(want[s]), sizes[s]) if sizes[s] else (0, 0)
        for i, _, n in mine:
            more = 0 < n <= left
            left -= n * more
            out.append((i, n, sizes[s], round(want[s], 3), n * (whole + more)))
    return sorted(out, key=repr)


def of(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 3), r.taken) for r in df.collect()), key=repr)


def test_query_equals_the_plain_walk(spark, sf_dir):
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert of(mixing.op13_flow_mixing(spark, sf_dir)) == plain_mix(rows)


def test_odd_rows_and_hot_copies(spark, odd_rows, clashing):
    rows = [(i, s, t) for (i, t), s in zip(odd_rows, itertools.cycle(["b", None, "a", "\U0001f600", "￿"]))]
    rows += [(None, "hot", "one two three")] * 300 + [(9, "hot", "one")] + [(k, "hot", "w " * (k % 7)) for k in range(100)] + [(1, "none", None), (2, "none", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    expected = plain_mix(rows)
    assert of(mixing.mix_documents(clashing(df).repartition(5))) == expected
    assert of(mixing.mix_documents(df.coalesce(1))) == expected
    assert mixing.mix_documents(df.limit(0)).count() == 0


def test_refined_bins(spark):
    """Few rows around a boundary: bins are refined down to equal rows, which only their own numbers part."""
    rng = random.Random(3)
    rows = [(k, f"s{k % 4}", "w " * rng.randint(1, 9)) for k in range(3000)] + [(None, "s1", "w w w")] * 2000
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    made = [of(mixing.mix_documents(d, near=near)) for d, near in ((df, 8), (df.repartition(7), 8), (df, 4096))]
    assert made[0] == made[1]
    for each in made:
        taken, want = {}, {}
        for _, size, source_size, target, words in each:
            taken[source_size] = taken.get(source_size, 0) + words
            want[source_size] = target
            assert words <= 2 * size
        assert all(abs(taken[s] - want[s]) <= 9 for s in want)


def test_overlapping_sources(spark):
    """A document of two sources serves the one that lacks words; nothing is repeated while unused words would serve."""
    rows = [(k, ["a"], 10) for k in range(50)] + [(k, ["b", "a", "b"], 10) for k in range(50, 150)] + [(200, [], 4), (201, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, at array<string>, words long")
    from pyspark.sql import functions as F

    made = mixing.mix(df, F.coalesce("at", F.array()), F.col("words"), [F.col("doc_id")], weights=(1.0, 1.0), share=0.6)
    by = {}
    for r in made.collect():
        by[tuple(r.at or ())] = by.get(tuple(r.at or ()), 0) + r.taken
        assert r.copies <= 1
    assert sum(by.values()) == round(0.6 * 2500) and by[()] == 0


@pytest.mark.parametrize("seed", range(30))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    sources = "abc"[: rng.randint(1, 3)]
    sizes = {tuple(rng.sample(sources, rng.randint(1, len(sources)))): rng.randint(0, 3) for _ in range(rng.randint(1, 3))}
    quotas = {s: rng.randint(0, 5) for s in sources}
    flow = mixing.cheapest_flow(sizes, quotas, 2)
    given = {p: sum(flow[p].values()) for p in sizes}
    assert all(g <= 2 * sizes[p] for p, g in given.items()) and all(v >= 0 and s in p for p in sizes for s, v in flow[p].items())
    assert all(sum(flow[p].get(s, 0) for p in sizes) <= quotas[s] for s in sources)

    def splits(p):
        return [dict(zip(p, x, strict=True)) for x in itertools.product(range(2 * sizes[p] + 1), repeat=len(p)) if sum(x) <= 2 * sizes[p]]

    cost = lambda g: sum(max(0, g[p] - sizes[p]) for p in sizes)
    best = max((sum(g.values()), -cost(g)) for choice in itertools.product(*map(splits, sizes)) if all(sum(c.get(s, 0) for c in choice) <= quotas[s] for s in sources) for g in [{p: sum(c.values()) for p, c in zip(sizes, choice, strict=True)}])
    assert (sum(given.values()), -cost(given)) == best
