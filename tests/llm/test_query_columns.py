"""What the thin queries return, column by column, against plain versions."""

import hashlib
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakeloom.llm import bpe, knn, prefix_hash, substrings
from lakeloom.llm.common import default_tokenizer

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_duplicates import plain_substrings  # noqa: E402
from test_search import in_order, plain_top  # noqa: E402

sha = lambda data: hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_encoding_query_equals_the_library(spark, sf_dir, rows):
    library = Tokenizer.from_file(default_tokenizer())
    library.no_padding()
    library.no_truncation()
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    got = bpe.op2_chunk_reuse_bpe(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_suffix_query_equals_brute_force(spark, sf_dir, rows):
    expected = [(i, len(dict(rows)[i].encode()), removed, spans, sha(kept)) for i, removed, spans, kept in plain_substrings(rows, 50)]
    got = substrings.op8_suffix_dedup(spark, sf_dir).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def plain_sketch(text):
    """Min-hash over the polynomial hashes of all spans, each worked out by itself."""
    out = [0] * 64
    best = {}
    n = min(prefix_hash.SPAN, len(text))
    for k in range(len(text) - n + 1 if text else 0):
        pair = [sum((ord(c) + 1) * pow(base, i, p) for i, c in enumerate(text[k : k + n])) % p for p, base in zip(prefix_hash.PRIMES, prefix_hash.BASES, strict=True)]
        h = (pair[0] << 31 | pair[1]) * int(prefix_hash.MIX) % 2**64
        h ^= h >> 29
        h = h * int(prefix_hash.MIX) % 2**64
        best[h >> 58] = min(best.get(h >> 58, h), h)
    for slot, h in best.items():
        out[slot] = max(1, h >> 42 & 0xFFFF)
    return out


def plain_likeness(a, b):
    used = [x or y for x, y in zip(a, b, strict=True)]
    return sum(x == y and bool(u) for x, y, u in zip(a, b, used, strict=True)) / sum(map(bool, used)) if any(used) else 1.0


def test_fingerprint_query_equals_plain_min_hash(spark, rows, docs_of, tmp_path, odd_rows):
    some = [(i, t) for i, t in sorted(rows) if len(t or "") < 6000][:50] + [(10_000 + (i or 0), t) for i, t in odd_rows if len(t or "") < 6000]
    docs_of(some).write.parquet(str(tmp_path / "documents.parquet"))
    order = in_order(some)
    hexed = lambda s: "".join(f"{v:04x}" for v in s)
    expected = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 2
        edited = t[: len(t) - cut] + n[:cut]
        own, changed = plain_sketch(t), plain_sketch(edited)
        expected.append((i, len(t), sha(edited.encode()), hexed(own), hexed(changed), plain_likeness(own, changed), plain_likeness(own, plain_sketch(n))))
    got = prefix_hash.op9_prefix_fingerprints(spark, str(tmp_path)).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_top_k_with_clashing_columns(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(2)
    data = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(60)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("v", "n", "sq", "query", "cell", "score", "rank")})
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in knn.top_k(df).collect()) == plain_top(data, 20)
