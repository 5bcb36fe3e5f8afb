"""What a bucket and a block of op8 hold in memory, and that cutting them finer changes no answer."""

import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.llm import substrings

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_duplicates import plain_substrings  # noqa: E402

WINDOW = 50


def texts_of(seed, n, phrase_bytes=400, alphabet="abcdefghijklmnop "):
    """One phrase inside all of them, cut anywhere, so that a few minimizers have most strings."""
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choices(alphabet, k=k)).encode()
    phrase = make(phrase_bytes)
    return [make(rng.randint(0, 60)) + phrase[rng.randint(0, 40) : phrase_bytes - rng.randint(0, 40)] + make(rng.randint(0, 60)) for _ in range(n)]


def strings_of(texts):
    """Distinct strings of one minimizer each, with the least number of a text that has them."""
    first, count, of, _ = substrings.window_runs(b"".join(texts), np.array([len(t) for t in texts]), WINDOW)
    body, least = b"".join(texts), {}
    for a, k, i in zip(first.tolist(), count.tolist(), of.tolist(), strict=True):
        s = body[a : a + k + WINDOW - 1]
        least[s] = min(least.get(s, i), i)
    return least


def row_of(least):
    ranks, strings = np.array(list(least.values()), "<i8"), list(least)
    q = substrings._squeezed
    return (7, 0, 1, q(np.arange(len(strings)).astype("<u4")), q(ranks), q(np.array([len(s) for s in strings], "<u2")), substrings.zstandard.compress(b"".join(strings)))


def plain_masks(least):
    lowest = {}
    for s, rank in least.items():
        for j in range(len(s) - WINDOW + 1):
            lowest[s[j : j + WINDOW]] = min(lowest.get(s[j : j + WINDOW], rank), rank)
    return [sum((lowest[s[j : j + WINDOW]] < rank) << j for j in range(len(s) - WINDOW + 1)) for s, rank in least.items()]


def answered(least):
    batches = substrings._batch(substrings.STRINGS, [row_of(least)]).to_batches()
    (made,) = substrings._sort_bucket(WINDOW, 4_000_000)((pa.scalar(0),), iter(batches))
    return substrings._opened(made.to_pylist()[0]["ranks"], "<u8").tolist()


@pytest.mark.parametrize("most", [3_000, 20_000, 10**7])
@pytest.mark.parametrize("alphabet", ["abcdefghijklmnop ", "ab"])
def test_strings_of_one_minimizer_dealt_anew_get_the_same_answers(monkeypatch, most, alphabet):
    sorted_bytes, deals = [], []
    sort, deal = substrings.earlier_windows, substrings._dealt_anew
    monkeypatch.setattr(substrings, "SORTED", most)
    monkeypatch.setattr(substrings, "earlier_windows", lambda s, *a: sorted_bytes.append(sum(map(len, s))) or sort(s, *a))
    monkeypatch.setattr(substrings, "_dealt_anew", lambda *a: deals.append(1) or deal(*a))
    least = strings_of(texts_of(3, 700, alphabet=alphabet))
    assert answered(least) == plain_masks(least)
    assert sorted_bytes
    assert bool(deals) == (most < 10**7)
    assert max(sorted_bytes) < (3 * most if most == 3_000 else most)  # after the last deal what is left is sorted whatever it is


def test_a_buckets_memory_is_a_few_times_its_strings():
    least = strings_of(texts_of(5, 25_000, phrase_bytes=120))
    total = sum(map(len, least))
    assert total > 7_000_000
    tracemalloc.start()
    try:
        answered(least)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 22 * total


@pytest.mark.parametrize("window", [24, 50, 79])
def test_runs_go_on_over_slices(monkeypatch, window):
    texts = [*texts_of(8, 30, phrase_bytes=90), b"", b"a" * 700, b"short", *texts_of(9, 20, 60, "ab")]
    sizes = np.array([len(t) for t in texts])
    whole = substrings.window_runs(b"".join(texts), sizes, window)
    monkeypatch.setattr(substrings, "SLICE", 101)
    for a, b in zip(whole, substrings.window_runs(b"".join(texts), sizes, window), strict=True):
        assert a.tolist() == b.tolist()
    assert whole[1].sum() == np.maximum(sizes - window + 1, 0).sum()


def test_buckets_follow_the_bytes(docs_of, spark):
    rows = [(i, t.decode()) for i, t in enumerate(texts_of(4, 60))]
    docs = docs_of(rows)
    blocks = docs.select("doc_id", "text").mapInArrow(substrings._blocks(2_000), substrings.BLOCK)
    parts = substrings.shuffle_partitions(docs)
    assert substrings.bucket_count(blocks, 10**9) == parts and substrings.bucket_count(blocks, 300) > 3 * parts
    got = substrings.dedup_substrings(docs, block_bytes=2_000, bucket_bytes=300).collect()
    assert sorted(((r.doc_id, r.n_removed, len(r.spans), bytes(r.text_bytes)) for r in got), key=repr) == plain_substrings(rows, 50)
