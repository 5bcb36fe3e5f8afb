"""Exact substring deduplication over suffixes, sorted by induction in part.

A byte goes if it lies in a string of ``window`` bytes that also starts in a
document of smaller doc_id. Documents are stored in blocks, and then:

1. Seeds. Each window has a minimizer: the least hash among its substrings of
   ``SEED`` bytes. Equal windows have equal minimizers, so a window whose
   minimizer stands in one document only is unique. Blocks send their distinct
   minimizer hashes to buckets and learn which are shared.
2. Strings. Neighbouring windows with one minimizer form one string. Blocks send
   each distinct string of a shared minimizer once, with the least doc_id that has
   it there, to the minimizer's bucket; so equal windows meet, in one task.
3. Suffixes. Strings whose minimizer no other distinct string of the bucket has are
   done; the others are sorted (module ``suffix_sort``: by induction, with queues that
   spill to disk, but for levels of many names, which go by prefix doubling), those of
   some minimizers at a time, ``SORTED`` bytes; neighbours in the order with a common prefix of ``window`` bytes form a
   class. A class's least doc_id says, for each window of each string, whether an
   earlier document has it. Strings of one minimizer that are more than that are first
   cut and dealt by minimizers of another hash, as texts are. There are as many buckets
   as keep the distinct strings of one, which are in memory, about as many however
   large the table is.
4. Cut. The answers, a bit for each window, go back to the blocks.

A string that many documents share travels once for each block. Hash collisions
cost work only: what is removed is decided by comparing bytes.

Defined cases: a null text is empty; a text shorter than the window stays whole;
rows that share a doc_id are separate documents, neither smaller; a null doc_id
counts as larger than all; a row's windows are judged on the input; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, checkpointed_by, forgotten, shuffle_partitions, table
from .suffix_sort import common_prefixes, sort_suffixes

SEED = 16
LEVEL = 3
#: Windows whose hashes are worked out at a time.
SLICE = 1 << 19
#: Bytes of strings that are sorted together, and how often strings of one minimizer are dealt anew by another hash.
SORTED, DEALS = 1_000_000, 6
LAST = np.iinfo(np.int64).max
BLOCK = "home long, ids binary, sizes binary, body binary"
SEEDS = "home long, bucket int, count int, hashes binary, shared binary"
STRINGS = "home long, bucket int, kind int, numbers binary, ranks binary, sizes binary, body binary"
CUT = "doc_id long, text_bytes binary, n_removed long, spans array<struct<start: long, length: long>>"


def _batch(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _squeezed(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), LEVEL)


def _opened(body: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(body), dtype=kind) if body else np.zeros(0, kind)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows, one in memory at a time beside its batch."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _mixed(first: np.ndarray, second: np.ndarray, deal: int = 0) -> np.ndarray:
    """Hashes of strings of ``SEED`` bytes, given as their two halves; others for each ``deal``."""
    h = (first ^ np.uint64(deal * 0xA0761D6478BD642F % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h += second
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def _blocks(block_bytes: int):
    """Rows of whole documents: ids with a mark for null, sizes, and the bytes."""

    def row(home: int, ids: list, texts: list[bytes]):
        ranks = np.array([LAST if i is None else i for i in ids], dtype="<i8")
        return home, ranks.tobytes() + bytes(i is None for i in ids), np.array([len(t) for t in texts], dtype="<i8").tobytes(), zstandard.compress(b"".join(texts), LEVEL)

    def task(batches):
        home = TaskContext.get().partitionId() << 24
        ids: list = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                texts.append((text.as_py() or "").encode())
                held += len(texts[-1]) + 16
                if held >= block_bytes:
                    yield from _batch(BLOCK, [row(home, ids, texts)]).to_batches()
                    home, ids, texts, held = home + 1, [], [], 0
        if ids:
            yield from _batch(BLOCK, [row(home, ids, texts)]).to_batches()

    return task


def window_runs(text: bytes, sizes: np.ndarray, window: int, deal: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows that share a minimizer, of texts that stand one behind the other: the
    place of the first window, how many there are, the number of the text, and the minimizer."""
    ends, total = np.cumsum(sizes), len(text)
    firsts, befores, seeds = ([np.zeros(0, kind)] for kind in (np.int64, np.int64, np.uint64))
    valid = np.ones(max(total - window + 1, 0), dtype=bool)
    for lo, hi in zip(np.maximum(ends - window + 1, ends - sizes).tolist(), ends.tolist(), strict=True):
        valid[lo:hi] = False  # windows that would cross a document's end
    words = np.ndarray((max(total - 7, 0),), dtype="<u8", buffer=text, strides=(1,)) if total > 7 else np.zeros(0, "<u8")
    place_bits = np.uint64(32)  # the same for all blocks, so that equal windows choose alike everywhere
    seen, last_at, last_place = 0, -2, -1
    for lo in range(0, len(valid), SLICE):
        at = np.flatnonzero(valid[lo : lo + SLICE])
        if not len(at):
            continue
        upto = min(lo + SLICE, len(valid)) + window - SEED
        h = _mixed(words[lo:upto], words[lo + 8 : upto + 8], deal)
        # The hash above, the place below: the least is the leftmost of the least hash.
        key = (h >> place_bits) << place_bits | np.arange(lo, upto, dtype=np.uint64)
        span, reach = window - SEED + 1, 1
        while reach * 2 <= span:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        if span > reach:
            key = np.minimum(key[: len(key) - (span - reach)], key[span - reach :])
        place = (key[at] & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
        at += lo
        new = np.empty(len(at), dtype=bool)
        new[0] = place[0] != last_place or at[0] != last_at + 1
        new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
        cuts = np.flatnonzero(new)
        firsts.append(at[cuts])
        befores.append(cuts + seen)
        seeds.append(h[place[cuts] - lo])
        seen, last_at, last_place = seen + len(at), int(at[-1]), int(place[-1])
    first = np.concatenate(firsts)
    return first, np.diff(np.append(np.concatenate(befores), seen)), np.searchsorted(ends, first, side="right"), np.concatenate(seeds)


class Block:
    """One block's documents and the runs of windows that share a minimizer."""

    def __init__(self, ids: bytes, sizes: bytes, body: bytes, window: int):
        self.sizes = np.frombuffer(sizes, dtype="<i8")
        n = len(self.sizes)
        self.ranks = np.frombuffer(ids[: 8 * n], dtype="<i8")
        self.absent = np.frombuffer(ids[8 * n :], dtype=np.uint8).astype(bool)
        self.text = zstandard.decompress(body)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.first, self.count, self.doc, self.seed = window_runs(self.text, self.sizes, window)

    def seeds(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimizers, and whether more than one document here has each."""
        order = np.lexsort((self.doc, self.seed))
        seed, doc = self.seed[order], self.doc[order]
        starts = np.flatnonzero(np.append(True, seed[1:] != seed[:-1])) if len(seed) else np.zeros(0, np.int64)
        return seed[starts], (np.maximum.reduceat(doc, starts) != doc[starts]) if len(starts) else np.zeros(0, bool)


def _send_seeds(window: int, buckets: int):
    def task(batches):
        for row in _each(batches):
            seeds, shared = Block(row["ids"], row["sizes"], row["body"], window).seeds()
            bucket = (seeds % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                pick = order[cuts[b] : cuts[b + 1]]
                # Six bytes of each hash: enough to be rarely shared by chance.
                narrow = (seeds[pick] >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows.append((row["home"], b, len(pick), np.ascontiguousarray(narrow).tobytes(), np.packbits(shared[pick]).tobytes()))
            yield from _batch(SEEDS, rows).to_batches()

    return task


def _answer_seeds(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    wide = np.zeros((sum(r["count"] for r in rows), 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(b"".join(r["hashes"] for r in rows), dtype=np.uint8).reshape(-1, 6)
    known, number, times = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    own = np.concatenate([np.unpackbits(np.frombuffer(r["shared"], dtype=np.uint8), count=r["count"]).astype(bool) for r in rows])
    shared = times > 1
    shared[number[own]] = True
    answer, at, out = shared[number], 0, []
    for r in rows:
        out.append((r["home"], r["bucket"], r["count"], b"", np.packbits(answer[at : at + r["count"]]).tobytes()))
        at += r["count"]
    yield from _batch(SEEDS, out).to_batches()


def _send_strings(window: int, buckets: int):
    """A block's distinct strings of shared minimizers, by bucket; a row of kind 0 keeps which run has which string."""

    def block(key: tuple[pa.Scalar, ...], answers: pa.Table, blocks: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for row in blocks.to_pylist():
            own = Block(row["ids"], row["sizes"], row["body"], window)
            seeds, _ = own.seeds()
            bucket = (seeds % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            shared = np.zeros(len(seeds), dtype=bool)
            for a in answers.to_pylist():
                pick = order[cuts[a["bucket"]] : cuts[a["bucket"] + 1]]
                shared[pick] = np.unpackbits(np.frombuffer(a["shared"], dtype=np.uint8), count=a["count"]).astype(bool)
            runs = np.flatnonzero(shared[np.searchsorted(seeds, own.seed)])
            number: dict[bytes, int] = {}
            text = own.text
            of_run = np.fromiter((number.setdefault(text[a : a + k], len(number)) for a, k in zip(own.first[runs].tolist(), (own.count[runs] + window - 1).tolist(), strict=True)), dtype=np.int64, count=len(runs))
            least = np.full(len(number), LAST)
            np.minimum.at(least, of_run, own.ranks[own.doc[runs]])
            rows.append((row["home"], int(((row["home"] >> 24) + row["home"]) % buckets), 0, _squeezed(runs.astype("<u4"), of_run.astype("<u4")), _squeezed(least.astype("<i8")), b"", b""))
            place = np.zeros(len(number), dtype=np.int64)
            place[of_run] = (own.seed[runs] % np.uint64(buckets)).astype(np.int64)
            strings = list(number)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                pick = order[cuts[b] : cuts[b + 1]]
                some = [strings[i] for i in pick.tolist()]
                rows.append((row["home"], b, 1, _squeezed(pick.astype("<u4")), _squeezed(least[pick].astype("<i8")), _squeezed(np.array([len(s) for s in some], dtype="<u2")), zstandard.compress(b"".join(some), LEVEL)))
        return _batch(STRINGS, rows)

    return block


def whole_masks(counts: np.ndarray) -> np.ndarray:
    """Masks of the first ``counts`` windows, of 1 to 64."""
    return ~np.uint64(0) >> (64 - counts).astype(np.uint64)


def minimizers(strings: list[bytes], window: int, deal: int = 0) -> np.ndarray:
    """Of strings whose windows have one minimizer each, that of the first window: its upper half, since the lower may decide ties by place."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    data = np.frombuffer(b"".join(strings) + b"\0" * 16, dtype=np.uint8)
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    starts = np.cumsum(sizes) - sizes
    seed = np.full(len(strings), ~np.uint64(0))
    for j in range(window - SEED + 1):
        np.minimum(seed, _mixed(words[starts + j], words[starts + j + 8], deal), out=seed)
    return (seed >> np.uint64(32)).astype(np.uint32)


def earlier_masks(strings: list[bytes], least: np.ndarray, window: int, memory: int, deal: int = 0) -> np.ndarray:
    """For each distinct string a mask of its windows: those that a string of a smaller rank has.

    Only strings of one minimizer can have a window in common. Those of a few minimizers
    are sorted at a time; those of one that are too many are dealt anew.
    """
    masks = np.zeros(len(strings), dtype=np.uint64)
    if not strings:
        return masks
    seed = minimizers(strings, window, deal)
    order = np.argsort(seed, kind="stable")
    heads = np.flatnonzero(np.append(True, np.diff(seed[order]) != 0))
    ends = np.append(heads[1:], len(order))
    weights = np.add.reduceat(np.array([len(s) + 1 for s in strings], dtype=np.int64)[order], heads)
    several = np.flatnonzero(ends - heads > 1)
    waiting, held = [], 0

    def settle(how) -> None:
        nonlocal waiting, held
        if waiting:
            some = np.concatenate(waiting)
            masks[some] = how([strings[i] for i in some.tolist()], least[some], window, memory)
        waiting, held = [], 0

    for lo, hi, weight in zip(heads[several].tolist(), ends[several].tolist(), weights[several].tolist(), strict=True):
        if held + weight > SORTED:
            settle(earlier_windows)
        waiting.append(order[lo:hi])
        held += weight
        if held > SORTED and deal < DEALS:  # of one minimizer, since all others are settled
            settle(lambda *a: _dealt_anew(*a, deal + 1))
    settle(earlier_windows)
    return masks


def _dealt_anew(strings: list[bytes], least: np.ndarray, window: int, memory: int, deal: int) -> np.ndarray:
    """``earlier_masks`` of strings of one minimizer by those of another hash: cut into runs of windows as texts are, each distinct run once."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    text = b"".join(strings)
    first, count, of, _ = window_runs(text, sizes, window, deal)
    number: dict[bytes, int] = {}
    piece = np.fromiter((number.setdefault(text[a : a + k], len(number)) for a, k in zip(first.tolist(), (count + window - 1).tolist(), strict=True)), dtype=np.int64, count=len(first))
    lowest = np.full(len(number), LAST)
    np.minimum.at(lowest, piece, least[of])
    told = earlier_masks(list(number), lowest, window, memory, deal)
    told = np.where(least[of] > lowest[piece], whole_masks(count), told[piece])
    masks = np.zeros(len(strings), dtype=np.uint64)
    np.bitwise_or.at(masks, of, told << (first - (np.cumsum(sizes) - sizes)[of]).astype(np.uint64))
    return masks


def earlier_windows(strings: list[bytes], least: np.ndarray, window: int, memory: int) -> np.ndarray:
    """``earlier_masks`` by one sort of all suffixes."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    data = np.frombuffer(b"\0".join(strings) + b"\0" * (window + 16), dtype=np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    symbols = data[: total + 1].astype(np.uint16) + np.uint16(2)
    symbols[starts[1:] - 1] = 1
    symbols[total - 1] = 1
    symbols[total] = 0
    order = sort_suffixes(symbols, 258, window, memory).astype(np.int64)
    counts = sizes - window + 1
    is_window = np.zeros(total + 1, dtype=bool)
    owner = np.repeat(np.arange(len(strings)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(first[-1]) - first[owner] + starts[owner]
    is_window[at] = True
    of_place = np.zeros(total + 1, dtype=np.int64)
    of_place[at] = np.arange(len(at))
    order = order[is_window[order]]
    prefixes = common_prefixes(data, order[:-1], order[1:], window)
    heads = np.flatnonzero(np.append(True, prefixes < window))
    ranks = least[owner[of_place[order]]]
    lowest = np.repeat(np.minimum.reduceat(ranks, heads), np.diff(np.append(heads, len(order))))
    found = np.zeros(len(at), dtype=bool)
    found[of_place[order]] = lowest < ranks
    return np.bitwise_or.reduceat(found.astype(np.uint64) << (np.arange(len(at)) - first[owner]).astype(np.uint64), first[:-1])


def _sort_bucket(window: int, memory: int):
    """Answers each string with a bit for each window; rows of kind 0 pass through."""

    def bucket(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        parts, least = [], np.zeros(0, np.int64)
        for row in _each(batches):
            if row["kind"] == 0:
                yield from _batch(STRINGS, [tuple(row.values())]).to_batches()
                continue
            body, at, of = zstandard.decompress(row["body"]), 0, []
            for size in _opened(row["sizes"], "<u2").tolist():
                of.append(number.setdefault(body[at : at + size], len(number)))
                at += size
            of = np.array(of, dtype=np.int32)
            if len(number) > len(least):
                least = np.append(least, np.full(max(len(number) - len(least), len(least)), LAST))
            np.minimum.at(least, of, _opened(row["ranks"], "<i8"))
            parts.append((row["home"], row["bucket"], row["numbers"], row["ranks"], of))
        if not parts:
            return
        strings = list(number)
        del number
        every = whole_masks(np.array([len(s) - window + 1 for s in strings]))
        masks = earlier_masks(strings, least[: len(strings)], window, memory)
        for home, place, numbers, ranks, of in parts:
            mask = np.where(_opened(ranks, "<i8") > least[of], every[of], masks[of])
            yield from _batch(STRINGS, [(home, place, 2, numbers, _squeezed(mask.astype("<u8")), b"", b"")]).to_batches()

    return bucket


def _cut(window: int):
    """A block's documents without the bytes that earlier documents have."""
    kinds = pa.schema([("doc_id", pa.int64()), ("text_bytes", pa.binary()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))])

    def block(key: tuple[pa.Scalar, ...], answers: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        for row in blocks.to_pylist():
            own = Block(row["ids"], row["sizes"], row["body"], window)
            told = answers.to_pylist()
            plan = next((a for a in told if a["kind"] == 0), None)
            covered = np.zeros(len(own.text), dtype=bool)
            if plan is not None:
                runs, of_run = np.split(_opened(plan["numbers"], "<u4").astype(np.int64), 2)
                least = _opened(plan["ranks"], "<i8")
                masks = np.zeros(len(least), dtype=np.uint64)
                for a in told:
                    if a["kind"] == 2:
                        masks[_opened(a["numbers"], "<u4")] = _opened(a["ranks"], "<u8")
                first, count, rank = own.first[runs], own.count[runs], own.ranks[own.doc[runs]]
                mask = np.where(rank > least[of_run], whole_masks(count), masks[of_run])
                for j in range(int(count.max(initial=0))):
                    covered[first[(mask >> np.uint64(j) & np.uint64(1)).astype(bool)] + j] = True
            upto = np.append(np.int32(0), np.cumsum(covered, dtype=np.int32))  # windows that start before a byte
            gone = upto[1:] > 0
            gone[window - 1 :] = upto[window:] > upto[: max(len(upto) - window, 0)]
            for k, (lo, hi) in enumerate(zip(own.starts.tolist(), own.ends.tolist(), strict=True)):
                part = gone[lo:hi]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], part.view(np.int8), [0]])))
                body = own.text[lo:hi]
                out[0].append(None if own.absent[k] else int(own.ranks[k]))
                out[1].append(body if not len(edges) else np.frombuffer(body, dtype=np.uint8)[~part].tobytes())
                out[2].append(int(part.sum()))
                out[3].append([{"start": a, "length": b - a} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds.types, strict=True)], schema=kinds)

    return block


def bucket_count(blocks: DataFrame, bucket_bytes: int) -> int:
    """At least as many as shuffles have partitions, and so many that a bucket's share of the compressed texts is ``bucket_bytes``."""
    stored = blocks.agg(F.sum(F.length("body").cast("long"))).first()[0] or 0
    return max(shuffle_partitions(blocks), -(-stored // bucket_bytes))


def dedup_substrings(docs: DataFrame, window: int = 50, block_bytes: int = 4_000_000, memory: int = 4_000_000, bucket_bytes: int = 8_000_000) -> DataFrame:
    """For every row its ``doc_id``, remaining ``text_bytes``, ``n_removed`` and removed ``spans`` (bytes of the original).

    ``window`` is 24 to 79: a string's windows must fit one mask of 64 bits.
    """
    if not SEED + 8 <= window <= SEED + 63:
        raise ValueError("window must be 24 to 79")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The texts are dealt by home once, not again for each cogroup.
    blocks = checkpointed_by(read.mapInArrow(_blocks(block_bytes), BLOCK), shuffle_partitions(docs), "home")
    forgotten(blocks, wait=True)
    buckets = bucket_count(blocks, bucket_bytes)
    # Each step's answers are written, so that the shuffle files of what was asked can go before the next step.
    seeds = checkpointed(blocks.mapInArrow(_send_seeds(window, buckets), SEEDS).groupBy("bucket").applyInArrow(_answer_seeds, SEEDS))
    forgotten(seeds, wait=True)
    strings = seeds.groupBy("home").cogroup(blocks.groupBy("home")).applyInArrow(_send_strings(window, buckets), STRINGS)
    answers = checkpointed(strings.groupBy("bucket").applyInArrow(_sort_bucket(window, memory), STRINGS))
    del seeds, strings
    forgotten(answers)
    return answers.groupBy("home").cogroup(blocks.groupBy("home")).applyInArrow(_cut(window), CUT)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.length("text_bytes") + F.col("n_removed")).cast("long").alias("n_bytes"),
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("text_bytes", 256).alias("kept_sha256"),
    )
