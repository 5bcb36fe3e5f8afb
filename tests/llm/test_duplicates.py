"""Near and exact duplicates against plain versions: SimHash, suffixes, units."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from lakeloom.llm import components, simhash, substrings, suffix_sort, units


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    fps = {f for _, f in rows}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return sorted(((i, f, least.get(find(f))) for i, f in rows), key=repr)


def near_texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.randint(30, 120))] for _ in range(n // 6)]
    out = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize("limit", [4096, 12])
def test_simhash_equals_all_pairs(docs_of, spark, odd_rows, limit):
    rows = near_texts(3, 150) + [(1000 + (i or 0), t) for i, t in odd_rows]
    marked = [(i, plain_fingerprint(t)) for i, t in rows]
    fps = spark.createDataFrame([(simhash._signed(f),) for f in {f for _, f in marked}], "fp long")
    edges = simhash.links(fps, 4, limit)
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    expected = plain_components(marked)
    root_of = lambda f: roots.get(simhash._signed(f), simhash._signed(f))
    least = {}
    for i, f in marked:
        least[root_of(f)] = min(least.get(root_of(f), i), i)
    assert sorted(((i, f, least[root_of(f)]) for i, f in marked), key=repr) == expected
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs_of(rows)).collect()), key=repr)
    assert got == expected


def test_simhash_null_ids_empty_and_clashes(docs_of, odd_rows, clashing):
    marked = [(i, plain_fingerprint(t)) for i, t in odd_rows]
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(clashing(docs_of(odd_rows))).collect()), key=repr)
    assert got == plain_components(marked)
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_query_gives_hex_fingerprints_and_least_ids(spark, sf_dir):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in simhash.op7_covering_simhash(spark, sf_dir).collect()), key=repr)
    assert got == sorted(((i, f"{f:016x}", c) for i, f, c in plain_components(rows)), key=repr)


def test_a_cloud_that_finer_keys_do_not_part_goes_by_blocks(spark):
    """Fingerprints that agree in all bits but 14."""
    rng = random.Random(7)
    fps = {0xABCD << 48 | sum(rng.getrandbits(1) << b for b in range(0, 42, 3)) for _ in range(700)}
    edges = simhash.links(spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long"), 4, 60)
    roots = {r.node: r.root for r in components.connected_components(edges).collect()}
    groups = {}
    for i, f, c in plain_components([(k, f) for k, f in enumerate(sorted(fps))]):
        groups.setdefault(c, set()).add(roots.get(simhash._signed(f), simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_every_pair_within_the_radius_meets_in_a_table():
    rng = random.Random(1)
    masks = simhash.covering_masks(4)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def plain_substrings(rows, window):
    data = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, d in data:
        for k in range(len(d) - window + 1):
            w = d[k : k + window]
            rank = substrings.LAST if i is None else i
            least[w] = min(least.get(w, rank), rank)
    out = []
    for i, d in data:
        gone = np.zeros(len(d), dtype=bool)
        for k in range(len(d) - window + 1):
            if least[d[k : k + window]] < (substrings.LAST if i is None else i):
                gone[k : k + window] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, int(gone.sum()), spans, bytes(np.frombuffer(d, dtype=np.uint8)[~gone])))
    return sorted(out, key=repr)


def shared_texts(seed, alphabet, n):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    pool = [make(rng.randint(20, 120)) for _ in range(8)]
    return [(i // 2 if i % 5 == 0 else i, "".join(rng.choice(pool)[rng.randint(0, 9) :] if rng.random() < 0.5 else make(rng.randint(0, 60)) for _ in range(rng.randint(0, 8)))) for i in range(n)]


@pytest.mark.parametrize(("alphabet", "seed"), [("ab", 1), ("abcdefgh é", 2), ("a", 3)])
def test_suffix_dedup_equals_brute_force(docs_of, alphabet, seed):
    rows = shared_texts(seed, alphabet, 60)
    got = substrings.dedup_substrings(docs_of(rows), block_bytes=1500, memory=500).collect()
    assert sorted(((r.doc_id, r.n_removed, len(r.spans), bytes(r.text_bytes)) for r in got), key=repr) == plain_substrings(rows, 50)


def test_suffix_dedup_odd_rows(docs_of, odd_rows, clashing):
    got = substrings.dedup_substrings(clashing(docs_of(odd_rows))).collect()
    assert sorted(((r.doc_id, r.n_removed, len(r.spans), bytes(r.text_bytes)) for r in got), key=repr) == plain_substrings(odd_rows, 50)
    assert substrings.dedup_substrings(docs_of([])).count() == 0


@pytest.mark.parametrize("memory", [50, 10**6])
def test_induced_order_is_the_order_of_suffixes(memory):
    rng = np.random.default_rng(5)
    for high in (2, 4, 200):
        body = rng.integers(1, high + 1, 700)
        body[100:200] = body[300:400]
        text = np.append(body, 0).astype(np.uint16)
        order = suffix_sort.sort_suffixes(text, high + 2, 50, memory, most_symbols=64)
        assert sorted(order.tolist()) == list(range(701))
        heads = [tuple(text[i : i + 50].tolist()) for i in order]
        assert heads == sorted(heads)


def plain_units(rows):
    """Lines, and the clauses of those that stay, in order of all rows; a repeat is one whose normal form stood earlier."""
    in_order = sorted(range(len(rows)), key=lambda k: (-(2**63) if rows[k][0] is None else rows[k][0], hashlib.md5((rows[k][1] or "").encode()).hexdigest()[:15], k))
    rank = {k: place for place, k in enumerate(in_order)}
    normal = lambda u: re.sub(r"[ \t\r\n]+", " ", u).strip(" ").lower()
    words = lambda u: [w for w in re.split(r"[ \t\r\n]+", u) if w]
    cut = []
    for i, t in rows:
        lines = re.findall(r"[^\n]*\n+|[^\n]+", t or "")
        clauses = [(k, c) for k, line in enumerate(lines) for c in re.findall(r"[^.,!?\n]*[.,!?]+\n*|[^.,!?\n]*\n+|[^.,!?\n]+", line)]
        assert "".join(c for _, c in clauses) == (t or "")
        cut.append((i, t, lines, clauses))
    first = {}
    for at, (_, _, lines, clauses) in enumerate(cut):
        for kind, of in ((0, lines), (1, [c for _, c in clauses])):
            for pos, u in enumerate(of):
                first[kind, normal(u)] = min(first.get((kind, normal(u)), (rank[at], pos)), (rank[at], pos))
    out = []
    for at, (i, t, lines, clauses) in enumerate(cut):
        again = lambda kind, u, pos, at=at: (rank[at], pos) > first[kind, normal(u)]
        line_gone = [again(0, u, k) and bool(words(u)) for k, u in enumerate(lines)]
        state = ["line" if line_gone[k] else "again" if again(1, c, pos) else "new" for pos, (k, c) in enumerate(clauses)]
        gone = []
        for kind, run in itertools.groupby(range(len(clauses)), key=lambda p: state[p]):  # noqa: B023
            sizes = [len(words(clauses[p][1])) for p in run]
            gone += [kind == "line" or (kind == "again" and (max(sizes) >= 12 or sum(sizes) >= 20))] * len(sizes)
        kept, spans, start = "", [], 0
        for is_gone, run in itertools.groupby(range(len(clauses)), key=lambda p: gone[p]):  # noqa: B023
            body = "".join(clauses[p][1] for p in run)
            if is_gone:
                spans.append((start, len(body)))
            else:
                kept += body
            start += len(body)
        out.append((i, None if t is None else kept, spans))
    return sorted(out, key=repr)


def test_unit_dedup_equals_plain(docs_of, odd_rows, clashing):
    rng = random.Random(8)
    sentences = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(rng.randint(1, 25))) + rng.choice([".", ",", "!\n", "? ", "\n", "\n\n.", "?!"]) for _ in range(40)]
    rows = [(i // 2 if i % 7 == 0 else i, "".join(rng.choice(sentences) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(1000 + (i or 0), t) for i, t in odd_rows] + [(None, sentences[0] * 2), (2000, "\n\nx"), (2001, "\n\nx"), (2002, ".,\n!a b")]
    got = units.dedup_units(clashing(docs_of(rows))).collect()
    assert sorted(((r.doc_id, r.text, [(s.start, s.length) for s in r.removed_spans]) for r in got), key=repr) == plain_units(rows)
    assert {"fp", "score"} <= set(got[0].asDict())
    assert units.dedup_units(docs_of([])).count() == 0


def test_unit_query_equals_sql_on_odd_rows(docs_of, odd_rows, spark, tmp_path):
    """Blanks beyond ASCII are no blanks, short lines go, and both sides say so."""
    import duckdb

    from lakeloom.llm import oracles

    wide = " ".join(f"w{k}" for k in range(14))
    rows = [(10, wide + "."), (11, f"own text, {wide}."), (12, "Accept all cookies\nmine"), (13, "yours\naccept  all cookies\n"), (14, "one two\n"), (15, "one two\nand"), *odd_rows]
    one_rank = ["accept all cookies\nalpha", "accept all cookies\nbeta", "gamma\naccept all cookies"]
    rows += [(i, t) for i in (None, 7) for t in one_rank] + [(None, f"{wide}.\nof its own")] * 5
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    df = units.op10_unit_dedup(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    made = con.execute(oracles.UNITS_SQL)
    names = [d[0] for d in made.description]
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted((tuple(r[names.index(c)] for c in df.columns) for r in made.fetchall()), key=repr)
    made = {r.doc_id: r for r in df.collect()}
    spans = {i: r.removed_spans for i, r in made.items()}
    assert sum("accept all cookies" in (r.text or "").lower() for r in units.dedup_units(docs_of(rows)).collect()) == 1
    assert (spans[12], spans[13], spans[15]) == ("0+19", "6+20", "0+8")


def test_the_two_hashes_of_a_unit_are_independent(spark):
    """Texts with one first hash must not share the second: it is no function of the first."""
    row = spark.sql("SELECT xxhash64('second', 1, 'text') AS h2, xxhash64(xxhash64(1, 'text')) AS again, xxhash64(1, 'text', 'second') AS after").first()
    assert len({row.h2, row.again, row.after}) == 3
    assert xxhash.xxh64_intdigest(b"text", xxhash.xxh64_intdigest(b"second", 42)) == spark.sql("SELECT xxhash64('second', 'text') AS h").first().h % 2**64


def test_components_of_a_long_chain_and_a_star(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and all(got[1000 + i] == 1000 for i in range(1, 300))
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
