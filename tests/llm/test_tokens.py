"""BPE against the tokenizers library, packing invariants."""

import random
import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from lakeloom.llm import bpe, packing
from lakeloom.llm.common import byte_bpe, default_tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def texts(sf_dir, spark, n=60):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(n).collect()]


def test_ids_and_round_trip_equal_the_library(docs_of, odd_rows, library, sf_dir, spark, clashing):
    odd = [(900, "x" * 30000), (901, "\n" * 500), (902, "don't  stop\t\r\n  now "), (903, "a<|endoftext|>b" * 300), (904, "漢字" * 4000), (905, " lead")]
    rows = texts(sf_dir, spark) + [(1000 + (i or 0), t) for i, t in odd_rows] + odd + [(None, "no id")]
    made = bpe.decode_ids(bpe.encode_documents(clashing(docs_of(rows)), default_tokenizer(), block_bytes=40_000, memo_bytes=100_000), default_tokenizer()).collect()
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.doc_id, list(r.ids), r.text) for r in made), key=repr) == sorted(expected, key=repr)


def test_encode_nothing(docs_of):
    assert bpe.encode_documents(docs_of([]), default_tokenizer()).count() == 0


def test_null_ids_decode_to_null(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in bpe.decode_ids(df, default_tokenizer()).collect()) == [(1, None), (2, "")]


def check_pieces(rows, pieces, library, seq_len=1024):
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for i, t in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids[i])
            assert zlib.crc32(ids[i][at : at + p.length].tobytes()) == p.ids_crc32
            at += p.length
        assert at == len(ids[i])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= seq_len
    total = sum(len(x) for x in ids.values())
    return total, len(by_seq)


def test_pieces_cover_all_ids_with_little_padding(docs_of, odd_rows, library, sf_dir, spark, clashing):
    rows = texts(sf_dir, spark) + [(2000 + k, t) for k, (_, t) in enumerate(odd_rows)]
    pieces = packing.pack_documents(clashing(docs_of(rows, 2)), default_tokenizer(), shard_tokens=50_000).collect()
    total, sequences = check_pieces(rows, pieces, library)
    assert sequences <= total // 1024 + 10 * (2 + total // 50_000 + 1)
    assert packing.pack_documents(docs_of([]), default_tokenizer()).count() == 0


def plain_balance(lengths, sizes, linear, quadratic):
    """Descending pieces, each to the cheapest of the sequences with room, by looking at all."""
    room, cost, out = list(sizes), [0.0] * len(sizes), [[] for _ in lengths]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[i]
        while left:
            fit = [s for s in range(len(room)) if room[s] >= left] or [s for s in range(len(room)) if room[s]]
            s = min(fit, key=lambda s: (cost[s], s))
            take = min(left, room[s])
            out[i].append((start, take, s, sizes[s] - room[s]))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return out


@pytest.mark.parametrize("lengths", [[900] * 60 + [490] * 184 + [110] * 40 + [20] * 60, [1024], [1], [1024, 1023, 3], [700] * 9, list(range(1, 400)), [5] * 333])
def test_each_piece_goes_to_the_cheapest_sequence_with_room(lengths):
    sizes = packing.capacities(sum(lengths), 1024)
    assert sum(sizes) == sum(lengths) and all(s & (s - 1) == 0 for s in sizes)
    placed = packing.balance(lengths, 1024, 1.0, 1 / 1024)
    assert placed == plain_balance(lengths, sizes, 1.0, 1 / 1024)
    filled = defaultdict(int)
    for parts in placed:
        for _, length, s, _ in parts:
            filled[s] += length
    assert [filled[s] for s in range(len(sizes))] == sizes


def test_query_packs_every_document(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    pieces = packing.op3_cost_balanced_packing(spark, sf_dir).collect()
    total, _ = check_pieces(rows, pieces, library)
    filled = defaultdict(int)
    for p in pieces:
        filled[p.sequence_id] += p.length
    assert sum(filled.values()) == total and all(n & (n - 1) == 0 for n in filled.values())


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 300, 400).tolist()
    placed = packing.balance(lengths, 1024, 1.0, 1 / 1024)
    cost = defaultdict(float)
    for parts in placed:
        for _, length, s, _ in parts:
            cost[s] += length + length * length / 1024
    values = sorted(cost.values())
    assert values[-1] < 1.3 * np.mean(values)
    assert all(sum(p[1] for p in parts) == n for parts, n in zip(placed, lengths, strict=True))


CONTEXTS = ["", " ", "\n", "'", "it's", "1", "x", "漢", "。", "  \n ", "é", "<|", "|>", "..", "'ll"]


def test_every_sync_place_cuts_in_every_context():
    """Ids left and right of a place are those of the whole, with anything before and behind."""
    rng = random.Random(5)
    coder = byte_bpe(default_tokenizer())
    inside = bpe.pairs_inside(coder.specials)
    pieces = ["ab", "Zq", "12", "7", "'", "'s", "'ll", "'re5", "\"", "+/=", "...", " ", "\n", "\t", "漢字", "中文句子", "，", "。", "é", "ß", "<|endoftext|>", "<|", "|>", "endoftext", "\U0001f600", "x_y", "٣"]
    n = 0
    for _ in range(800):
        text = "".join(rng.choices(pieces, k=rng.randint(2, 12)))
        whole = (rng.choice(CONTEXTS) + text + rng.choice(CONTEXTS)).encode()
        ids = coder.encode(whole.decode()).tolist()
        for at in bpe.all_sync_places(whole, inside).tolist():
            n += 1
            assert coder.encode(whole[:at].decode()).tolist() + coder.encode(whole[at:].decode()).tolist() == ids
    assert n > 1500


@pytest.mark.parametrize("kind", ["chinese", "base64", "code"])
def test_texts_without_blanks_reuse_their_chunks(kind, monkeypatch):
    """Of many texts around one passage far less is encoded than they have, and the ids are the library's."""
    rng = random.Random(kind)
    if kind == "chinese":
        some = lambda n: "".join("".join(chr(rng.randint(0x4E00, 0x9F00)) for _ in range(rng.randint(3, 20))) + rng.choice("，。！") for _ in range(n // 30))
    elif kind == "base64":
        some = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
    else:
        some = lambda n: "".join(rng.choice(["function", "a1", "(b", ",c){", "return", "!0}", ";var", "x=", "[]", "'s'"]) for _ in range(n // 4))
    shared = some(30_000)
    texts = [some(300) + shared + some(300) for _ in range(12)]
    coder = byte_bpe(default_tokenizer())
    encoded = []
    plain = coder.encode

    def counted(text):
        encoded.append(len(text.encode()))
        return plain(text)

    monkeypatch.setattr(bpe, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    coder.encode = counted
    try:
        cut = bpe._cut(1, 100_000)([pa.record_batch([pa.array(range(12), pa.int64()), pa.array(texts)], names=["doc_id", "text"])])
        coded = pa.Table.from_batches(list(bpe._encode(default_tokenizer(), 48_000_000)(cut)))
        got = {}
        for home in set(coded.column("home").to_pylist()):
            for batch in bpe._assemble(default_tokenizer())((home,), iter(coded.filter(pc.equal(coded.column("home"), home)).to_batches())):
                got |= dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    finally:
        del coder.encode
    assert [got[i] for i in range(12)] == [plain(t).tolist() for t in texts]
    assert sum(encoded) < sum(len(t.encode()) for t in texts) / 4
