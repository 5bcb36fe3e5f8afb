"""Spelling variants against all pairs, and the query against its SQL."""

import random
import zlib

import duckdb
import pytest

from lakeloom.llm import oracles, variants


def one_apart(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def some_words(seed, n, letters, shortest=0, longest=7):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest))) for _ in range(n)})


@pytest.mark.parametrize("seed", range(12))
def test_trie_equals_all_pairs(seed):
    words = some_words(seed, 150, "ab" if seed % 3 == 0 else "abcé\U0001f600")
    got = list(variants.near_pairs(words, 0))
    assert len(got) == len(set(got))
    assert sorted(got) == [(i, j) for i in range(len(words)) for j in range(len(words)) if one_apart(words[i], words[j])]
    inner = ["prefix" + w for w in words]
    assert sorted(variants.near_pairs(inner, 6)) == sorted(got)
    assert list(variants.near_pairs([], 0)) == []


@pytest.mark.parametrize("part_words", [1, 3, 20, 4000])
def test_cuts_lose_no_pair(spark, part_words):
    words = [w for w in some_words(5, 260, "abcd", 1, 6) if w] + ["x" * 3000, "x" * 2999, "x" * 2998 + "y"] * (part_words > 3)
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = [tuple(r) for r in variants.near_words(df, part_words).collect()]
    assert len(got) == len(set(got))
    assert sorted(got) == sorted((a, b, j + 1) for a in words for j, b in enumerate(words) if one_apart(a, b))


def plain(rows):
    counts = {}
    for i, t in rows:
        run, runs = "", []
        for c in (t or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "\u0080" else c
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            counts[word] = counts.get(word, 0) + 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, each in near.items():
        best = min(each, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(out, key=repr)


def in_sql(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return sorted(con.execute(oracles.VARIANTS_SQL).fetchall(), key=repr)


def test_query_equals_plain_and_sql(docs_of, odd_rows, spark, tmp_path):
    rng = random.Random(1)
    stems = ["Reading", "readings", "reeding", "ÉCOLIERS", "écoliers", "Écoliers", "straßen", "strassen"]
    rows = [(k, " ".join(rng.choice(stems) for _ in range(200)) + " reaing readingss readimgs readimgs") for k in range(120)]
    rows += [(200, "spellings " * 300), (201, "spelings " * 25), (202, "spelngs spelngs speling speling spelligs2spelligs"), *odd_rows, (203, "q" * 5000), (204, "q" * 5000)]
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in variants.op12_trie_variants(spark, str(tmp_path)).collect()), key=repr)
    assert got == plain(rows)
    assert got == in_sql(tmp_path)
    assert any(r[2] not in (r[0], r[1]) for r in got)


def test_empty_and_clashing(docs_of, clashing):
    assert variants.variants(docs_of([])).count() == 0
    made = variants.variants(clashing(docs_of([(1, "example example"), (2, "exampel exampel example")]))).collect()
    assert {(r.word, r.form) for r in made} == {("example", None), ("exampel", None)}
    with pytest.raises(ValueError):
        variants.variants(docs_of([]), ratio=1)
