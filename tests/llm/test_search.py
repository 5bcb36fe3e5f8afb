"""Exact top-k, fingerprints and licenses against plain versions."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from lakeloom.llm import knn, licenses, prefix_hash


def plain_top(rows, k):
    ok = [(i, [np.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, w) in enumerate(ok):
        if q % 20:
            continue
        scores = []
        for other, (i, v) in enumerate(ok):
            if other != at:
                n = min(len(v), len(w))
                scores.append((-int(sum(int(a) * int(b) for a, b in zip(w[:n], v[:n], strict=True))), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["clusters", "noise", "large"])
def test_top_k_equals_brute_force(spark, kind):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 8)) * 3
    rows = []
    for i in range(400):
        v = centres[i % 6] + rng.normal(size=8) * 0.05 if kind == "clusters" else rng.normal(size=8) * (2e6 if kind == "large" else 1)
        rows.append((i, [float(x) for x in v]))
    rows += [(500, rows[20][1]), (520, rows[20][1]), (540, None), (560, [1.0, None]), (580, [float("nan")] * 8), (600, [float("inf")] * 8), (620, []), (None, rows[3][1]), (640, [0.0] * 8), (20, rows[7][1]), (20, rows[7][1]), (21, rows[8][1]), (21, rows[9][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for limit in (8192, 3):
        got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in knn.top_k(df, 20, group_limit=limit).collect())
        assert got == plain_top(rows, 20)


def test_queries_pass_over_what_cannot_reach_them():
    """Of clustered data a query scores less than a third, of any data the best are found."""
    rng = np.random.default_rng(3)
    for spread, most_share in ((0.05, 0.3), (5.0, 1.0)):
        centres = rng.normal(size=(12, 16)) * 40
        x = np.floor(centres[rng.integers(0, 12, 6000)] + rng.normal(size=(6000, 16)) * spread * 10)
        q = x[::20]
        top = (x * x).sum(1).max()
        pivots, lift = x[:24], np.sqrt(top - (x[:24] ** 2).sum(1))
        d = knn._distances(x, np.sqrt(top - (x * x).sum(1)), pivots, lift)
        cell, numbers = d.argmin(1), np.arange(6000)
        blocks = []
        for c in range(24):
            some = numbers[cell == c]
            some = some[np.argsort(d[some, c])]
            for lo in range(0, len(some), 100):
                pick = some[lo : lo + 100]
                blocks.append((c, d[pick[0], c], d[pick[-1], c], lambda pick=pick: (pick, pick, x[pick])))
        found, scored = knn.solved((numbers[::20], q), blocks, pivots, lift, top, 20)
        assert scored <= most_share * len(q) * 6000
        for i, each in enumerate(found):
            scores, ids = np.concatenate([e[0] for e in each]), np.concatenate([e[1] for e in each])
            every = x @ q[i]
            every[20 * i] = -np.inf
            assert ids[knn.best(scores, ids, 20)].tolist() == np.lexsort((numbers, -every))[:20].tolist()


def test_rows_that_share_an_id_equal_sql(spark, tmp_path):
    import duckdb

    from lakeloom.llm import oracles

    rows = [(0, [1.0, 2.0]), (0, [3.0, 1.0]), (1, [1.0, 1.0]), (1, [5.0, 5.0]), (2, [0.5, 0.1])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(map(tuple, knn.op4_voronoi_knn(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == sorted(con.execute(oracles.KNN_SQL).fetchall())
    assert [r for r in got if r[1] == 1] == [(0, 1, 1, 61440), (0, 1, 1, 81920)]


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in knn.top_k(df).collect()] == [(0, 1, 1, 64 * 64 * 5)]
    assert knn.top_k(df.limit(0)).count() == 0
    assert knn.top_k(df.where("vec_id = 1")).count() == 0


def test_spans_and_extensions():
    text = "the cat sat on the cat mat the cat sat"
    h = prefix_hash.PrefixHash(text)
    for n in (1, 3, 7):
        for a in range(len(text) - n + 1):
            for b in range(len(text) - n + 1):
                assert (h.span(a, n) == h.span(b, n)) == (text[a : a + n] == text[b : b + n])
    spans = h.spans(5)
    for a in range(len(spans)):
        assert spans[a] == h.span(a, 5)[0] << 31 | h.span(a, 5)[1]
    for a in range(len(text)):
        for b in range(len(text)):
            n = 0
            while a + n < len(text) and b + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert h.extension(a, h, b) == n


def in_order(rows):
    """Descending ids, nulls last; ties by the digest of the text."""
    digest = lambda t: (d := xxhash.xxh64_intdigest((t or "").encode(), 42)) - (2**64 if d >> 63 else 0)
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), digest(r[1]), r[1] or ""))


def plain_next(rows):
    order = in_order(rows)
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 2
        edited = t[: len(t) - cut] + n[:cut]
        s = lambda x: prefix_hash.sketch(prefix_hash.PrefixHash(x))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prefix_hash.as_text(s(t)), prefix_hash.likeness(s(t), s(edited)), prefix_hash.likeness(s(t), s(n))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_each_document_meets_the_next(docs_of, odd_rows, clashing, ranges):
    rows = [(i * 3, f"text {i} " * (i % 7)) for i in range(40)] + [(1000 + (i or 0), t) for i, t in odd_rows] + [(None, "z"), (None, None)]
    got = prefix_hash.with_next(clashing(docs_of(rows)), ranges).collect()
    made = sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest(), r.fingerprint, r.near_edited, r.near_next) for r in got), key=repr)
    assert made == plain_next(rows)


def test_rows_of_one_id_and_rows_without_are_dealt_over_tasks(docs_of):
    rows = [(7, f"text of seven {k}") for k in range(400)] + [(None, f"no id {k}") for k in range(300)] + [(k, f"other {k}") for k in range(100)] + [(7, "text of seven 3")]
    got = prefix_hash.with_next(docs_of(rows), 20)
    assert sorted(((r.doc_id, r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest(), r.fingerprint, r.near_edited, r.near_next) for r in got.collect()), key=repr) == plain_next(rows)


def test_one_document_is_its_own_next(docs_of):
    r = prefix_hash.with_next(docs_of([(5, "abcdef")])).first()
    assert (r.edited_text, r.near_next) == ("abcabc", 1.0)
    assert prefix_hash.with_next(docs_of([])).count() == 0


def test_likeness_follows_common_text():
    rng = np.random.default_rng(1)
    base = "".join(rng.choice(list("abcdefgh "), 4000))
    s = lambda t: prefix_hash.sketch(prefix_hash.PrefixHash(t))
    near, far = base[:3800] + "x" * 200, "".join(rng.choice(list("ijklmno "), 4000))
    assert prefix_hash.likeness(s(base), s(near)) > 0.7 > 0.2 > prefix_hash.likeness(s(base), s(far))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for label, phrase, _ in licenses.BASE:
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


LICENSE_ROWS = [
    (10, "CC-BY cc by, cc/by. All rights reserved! (general public  license) x"),
    (11, "Licensed under the Apache License, Version 2.0 (the License)"),
    (12, "SPDX-License-Identifier: GPL-3.0-or-later"),
    (13, "acc by the cc byte; call rights reserved?"),
    (14, "cc by " * 4000),
    (15, "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    (16, "Creative Commons Attribution-ShareAlike 4.0 and cc by-sa 4.0"),
]


def license_queries(spark, sf_dir, rows, docs_of, tmp_path):
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    return licenses.op6_license_rules(spark, str(tmp_path))


def test_base_phrases_equal_plain(spark, docs_of, odd_rows, tmp_path):
    rows = LICENSE_ROWS + odd_rows
    df = license_queries(spark, None, rows, docs_of, tmp_path)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()), key=repr) == sorted(((i, *plain_base(t)) for i, t in rows), key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    by = {r.doc_id: r for r in df.collect()}
    assert by[11].labels == "apache-2.0" and by[11].base_labels == ""
    assert "gpl-3.0" in by[12].labels and "mit" in by[15].labels and "cc-by-sa-4.0" in by[16].labels
    assert all(0 <= r.score <= 1 for r in by.values())


def test_hundreds_of_rules_and_none_without_an_anchor():
    made = licenses.rules()
    assert len(made) >= 200
    for _, pattern, keywords, _ in made:
        assert keywords and re.compile(pattern)
