"""BPE encoding and decoding with reuse of content-defined chunks.

A task cuts its documents where a rolling hash of the last 32 bytes says so, so
that passages which documents share give the same chunks wherever they stand. The
distinct chunks of each block of documents go, packed by bucket of their digest,
to the task that owns the bucket. There each chunk is encoded once for all
documents, and the ids go back to the blocks that asked.

A chunk's own ids are right only away from its ends: a word cut in two encodes
otherwise. Where letters, digits, other marks and blanks meet, the pre-tokeniser
cuts whatever stands around (``all_sync_places``), so ids of whole stretches between two
such places are the document's own. A chunk is therefore encoded from its first such
place to its last; what lies before and after is joined to the neighbouring chunk's end,
and each join is re-encoded over a window that grows until it reaches such a place on
both sides, where it agrees exactly with the chunks' ids.

Sizes: a block is ``block_bytes`` of text, a bucket task keeps at most
``memo_bytes`` of chunks (beyond that it forgets and encodes again), so memory is
bounded. A chunk that many documents share travels once for each block, never
once for each document.

Defined cases: a null text is empty and has no ids; a text without any such place
is one window; repeated rows give one result row each; a null doc_id stays null;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_bpe, default_tokenizer, shuffle_partitions, table

SCHEMA = "home long, bucket int, kind int, numbers binary, sizes binary, body binary"
LEAST, MOST, MEAN_BITS = 192, 8192, 10
LEVEL = 9


def gear_hash(data: np.ndarray) -> np.ndarray:
    """For each byte a hash of the 32 bytes that end there (fewer at the start)."""
    gear = np.random.default_rng(32).integers(0, 2**32, 256, dtype=np.uint32)
    h = gear[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] += h[:-width] << np.uint32(width)
    return h


def chunk_ends(marks: np.ndarray, start: int, end: int) -> list[int]:
    """Ends of the chunks of ``start`` to ``end``, given sorted places where the hash allows a cut."""
    ends, at = [], start
    while end - at > MOST or (end - at > LEAST and len(marks)):
        k = int(np.searchsorted(marks, at + LEAST))
        cut = min(int(marks[k]) if k < len(marks) else end, at + MOST, end)
        if cut >= end:
            break
        ends.append(cut)
        at = cut
    if end > at or not ends:
        ends.append(end)
    return ends


def _kinds() -> np.ndarray:
    """Of each byte: letter, digit, other visible ASCII (1 to 3), blank or line feed (4), or neither (0)."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[0x21:0x7F] = 3
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kind[0x30:0x3A] = 2
    kind[[0x20, 0x0A]] = 4
    return kind


KINDS = _kinds()
#: Marks that end a run of Chinese characters.
CJK_MARKS = "、。，！？：；"


def pairs_inside(specials: Collection[str]) -> np.ndarray:
    """Which two bytes stand next to one another in a special string: between these there is no sure cut."""
    found = np.zeros((256, 256), dtype=bool)
    for s in specials:
        raw = np.frombuffer(s.encode(), dtype=np.uint8)
        found[raw[:-1], raw[1:]] = True
    return found


def all_sync_places(data: bytes, inside: np.ndarray | None = None) -> np.ndarray:
    """Places where every pre-tokenisation cuts, whatever stands around.

    Runs of letters, of digits and of other marks end where the next kind begins, and
    before a blank. Only an apostrophe may take letters with it. The same holds between
    Chinese characters and the marks of CJK_MARKS. No place is in a special string.
    """
    x = np.frombuffer(data, dtype=np.uint8)
    if len(x) < 2:
        return np.zeros(0, dtype=np.int64)
    before, after = x[:-1], x[1:]
    a, b = KINDS[before], KINDS[after]
    hit = (a >= 1) & (a <= 3) & (b >= 1) & (a != b) & ~((before == 0x27) & (b == 1))
    if inside is not None:
        hit &= ~inside[before, after]
    places = np.flatnonzero(hit) + 1
    if len(x) >= 6 and (x >= 0xE3).any():
        # Three bytes each: a character from U+4E00 to U+9F7F, a mark.
        lead, second = x[:-2], x[1:-1]
        han = ((lead == 0xE4) & (second >= 0xB8)) | ((lead >= 0xE5) & (lead <= 0xE8)) | ((lead == 0xE9) & (second <= 0xBD))
        triple = (lead.astype(np.int32) << 16) | (second.astype(np.int32) << 8) | x[2:]
        mark = np.isin(triple, [int.from_bytes(m.encode(), "big") for m in CJK_MARKS])
        changed = np.flatnonzero((han[:-3] & mark[3:]) | (mark[:-3] & han[3:])) + 3
        places = np.union1d(places, changed)
    return places


def sync_places(data: bytes, inside: np.ndarray | None = None) -> tuple[int, int] | None:
    """First and last of ``all_sync_places``, or None."""
    places = all_sync_places(data, inside)
    return (int(places[0]), int(places[-1])) if len(places) else None


def packed_ids(ids: np.ndarray, sizes: np.ndarray, ends: bytes) -> bytes:
    """Ids by their rank of frequency here, with the chunks' four sizes each and their ends, compressed."""
    known, ranks, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(known), dtype=np.int64)
    place[order] = np.arange(len(known))
    kind = "<u2" if len(known) <= 65536 else "<u4"
    head = np.array([len(ids), len(known), len(sizes)], dtype="<u4").tobytes()
    body = known[order].astype("<u4").tobytes() + np.ascontiguousarray(sizes.T).tobytes() + place[ranks].astype(kind).tobytes() + ends
    return head + zstandard.compress(body, LEVEL)


def unpacked_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray, bytes]:
    """What ``packed_ids`` was given."""
    n, k, chunks = np.frombuffer(packed[:12], dtype="<u4").tolist()
    body = zstandard.decompress(packed[12:])
    known = np.frombuffer(body, dtype="<u4", count=k)
    sizes = np.frombuffer(body, dtype="<u4", count=4 * chunks, offset=4 * k).reshape(4, chunks).T
    at = 4 * k + 16 * chunks
    kind = np.dtype("<u2" if k <= 65536 else "<u4")
    ids = known[np.frombuffer(body, dtype=kind, count=n, offset=at)]
    return ids, sizes, body[at + kind.itemsize * n :]


def _record(rows: list[tuple]) -> pa.RecordBatch:
    names = ("home", "bucket", "kind", "numbers", "sizes", "body")
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=list(names))


def _cut(buckets: int, block_bytes: int):
    """Rows of kind 0: a block's documents as lists of chunk numbers; of kind 1: its distinct chunks of one bucket."""

    def block(home: int, ids: list, texts: list[bytes]):
        joined = b"".join(texts)
        marks = np.flatnonzero((gear_hash(np.frombuffer(joined, dtype=np.uint8)) >> np.uint32(32 - MEAN_BITS)) == 0) + 1
        number: dict[bytes, int] = {}
        refs: list[int] = []
        counts = []
        at = 0
        for text in texts:
            here = marks[np.searchsorted(marks, at, side="right") : np.searchsorted(marks, at + len(text))]
            start = at
            ends = chunk_ends(here, at, at + len(text)) if text else []
            for end in ends:
                refs.append(number.setdefault(joined[start:end], len(number)))
                start = end
            counts.append(len(ends))
            at += len(text)
        named = pa.array(ids, pa.int64())
        plan = np.array([len(ids), *counts, *refs], dtype="<u4").tobytes()
        keys = np.array(named.fill_null(0).to_numpy(zero_copy_only=False), dtype="<i8").tobytes() + bytes(i is None for i in ids)
        yield home, home % buckets, 0, plan, keys, b""
        dealt: dict[int, list] = {}
        for chunk, k in number.items():
            dealt.setdefault(int.from_bytes(hashlib.blake2b(chunk, digest_size=4).digest(), "little") % buckets, []).append((k, chunk))
        for bucket, group in dealt.items():
            yield home, bucket, 1, np.array([k for k, _ in group], dtype="<u4").tobytes(), np.array([len(c) for _, c in group], dtype="<u4").tobytes(), zstandard.compress(b"".join(c for _, c in group), LEVEL)

    def task(batches):
        home = TaskContext.get().partitionId() << 24
        ids: list = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append((text.as_py() or "").encode())
                held += len(texts[-1])
                if held >= block_bytes:
                    yield from (_record([r]) for r in block(home, ids, texts))
                    home, ids, texts, held = home + 1, [], [], 0
        if ids:
            yield from (_record([r]) for r in block(home, ids, texts))

    return task


def _encode(tokenizer: str, memo_bytes: int):
    """Encodes each distinct chunk once; rows of kind 2 hold ids where rows of kind 1 held texts."""

    def task(batches):
        bpe = byte_bpe(tokenizer)
        inside = pairs_inside(bpe.specials)
        memo: dict[bytes, tuple[np.ndarray, int, int]] = {}
        held = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    yield _record([tuple(row.values())])
                    continue
                body, at = zstandard.decompress(row["body"]), 0
                heads, tails, cores, sizes = [], [], [], []
                for size in np.frombuffer(row["sizes"], dtype="<u4").tolist():
                    chunk, at = body[at : at + size], at + size
                    if chunk not in memo:
                        if held > memo_bytes:
                            memo.clear()
                            held = 0
                        places = sync_places(chunk, inside)
                        if places is None:
                            memo[chunk] = (np.zeros(0, np.uint32), size, size)
                        else:
                            memo[chunk] = (bpe.encode(chunk[places[0] : places[1]].decode("utf-8", "replace")), *places)
                        held += 3 * size + 200
                    ids, first, last = memo[chunk]
                    heads.append(chunk[:first])
                    tails.append(chunk[last:])
                    cores.append(ids)
                    sizes.append((first, len(ids), size - last, first == size))
                ends = b"".join(heads) + b"".join(tails)
                yield _record([(row["home"], row["bucket"], 2, row["numbers"], b"", packed_ids(np.concatenate(cores), np.array(sizes, dtype="<u4"), ends))])

    return task


def _assemble(tokenizer: str):
    """A block's documents from its chunks' ids, the joins re-encoded."""

    def block(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        chunks: dict[int, tuple[bytes, np.ndarray, bytes, bool]] = {}
        plan = keys = b""
        for part in parts:
            for row in part.to_pylist():
                if row["kind"] == 0:
                    plan, keys = row["numbers"], row["sizes"]
                    continue
                core, sizes, ends = unpacked_ids(row["body"])
                head_at, core_at, tail_at = 0, 0, int(sizes[:, 0].sum())
                for k, (first, n, last, bare) in zip(np.frombuffer(row["numbers"], dtype="<u4").tolist(), sizes.tolist(), strict=True):
                    chunks[k] = (ends[head_at : head_at + first], core[core_at : core_at + n], ends[tail_at : tail_at + last], bool(bare))
                    head_at, core_at, tail_at = head_at + first, core_at + n, tail_at + last
        numbers = np.frombuffer(plan, dtype="<u4")
        n = int(numbers[0])
        counts, refs = numbers[1 : 1 + n].tolist(), numbers[1 + n :].tolist()
        joins: dict[bytes, np.ndarray] = {b"": np.zeros(0, np.uint32)}

        def joined(window: bytes) -> np.ndarray:
            if window not in joins:
                joins[window] = bpe.encode(window.decode("utf-8", "replace"))
            return joins[window]

        docs, at = [], 0
        for count in counts:
            window, out = b"", []
            for k in refs[at : at + count]:
                head, core, tail, bare = chunks[k]
                window += head
                if not bare:  # the chunk has a place where all agree: the window ends there
                    out += [joined(window), core]
                    window = tail
            out.append(joined(window))
            docs.append(np.concatenate(out).astype(np.int32))
            at += count
        ids = np.frombuffer(keys[: 8 * n], dtype="<i8")
        absent = np.frombuffer(keys[8 * n :], dtype=np.uint8).astype(bool)
        for lo in range(0, n, 1000):  # batches of bounded size
            some = docs[lo : lo + 1000]
            offsets = np.concatenate([[0], np.cumsum([len(d) for d in some])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, np.concatenate(some) if some else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo : lo + 1000], mask=absent[lo : lo + 1000]), lists], names=["doc_id", "ids"])

    return block


def encode_documents(docs: DataFrame, tokenizer: str, block_bytes: int = 12_000_000, memo_bytes: int = 48_000_000) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every document's whole text."""
    parts = shuffle_partitions(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_cut(parts, block_bytes), SCHEMA)
    encoded = rows.repartition(parts, "bucket").mapInArrow(_encode(tokenizer, memo_bytes), SCHEMA)
    return encoded.groupBy("home").applyInArrow(_assemble(tokenizer), "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``; null ids give a null text, bytes that are not UTF-8 the replacement character."""

    def task(batches):
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            values, offsets, absent = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist(), lists.is_null().to_pylist()
            texts = [None if gone else bpe.decode_bytes(values[lo:hi].tolist()).decode("utf-8", "replace") for lo, hi, gone in zip(offsets, offsets[1:], absent, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, ids array<int>, text string")


def op2_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = default_tokenizer()
    both = decode_ids(encode_documents(table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
