"""Document fingerprints from prefix polynomial hashes.

For the code points c of a text, the array C[j] = sum of (c_i + 1) * B^i over
i < j (each term modulo a prime p) gives the hash of any span: the difference of
two entries, modulo p, times B^-start. Two primes give 62 bits. Spans of one
text or of two are equal if their hashes are; the longest common extension from
two places is found by binary search.

A fingerprint is a sketch of the hashes of all spans of ``SPAN`` code points: the
hash's top bits choose one of 64 slots, each slot keeps 16 bits of its least
hash. Likeness is the share of slots that agree among those that either uses, an
estimate of the share of common spans (one-permutation min-hash).

``with_next`` compares each document with the next one in descending doc_id (the
last with the first). Documents are dealt by ranges of doc_id, with bounds from
approximate percentiles; an id that fills several ranges, and rows without an id,
are parted by the texts' digests, which are even. The first document of each range is
also sent to the range before it. Text moves once, and a task streams its sorted rows.

Defined cases: texts of any length are read whole; a null text is empty; a text shorter
than a span is one span, an empty one has the empty sketch (like another empty one to 1,
any other to 0); among rows of one doc_id the order is that of their texts' digests, then
of their texts (equal rows are in one task), and null ids come last;
a table's only row is its own next; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_partitions, table

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
SPAN, SLOT_BITS = 12, 6
SLOTS = 1 << SLOT_BITS
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Values expected to survive the cut before the sketch's sort; a slot left empty by it is looked for again.
SORTED = 640

_POWERS: list[list[np.ndarray]] = [[np.ones(1, np.uint64), np.ones(1, np.uint64)] for _ in PRIMES]


def powers(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo prime ``k`` for i < n; the tables grow by doubling."""
    p, held = PRIMES[k], _POWERS[k]
    for at, base in ((0, BASES[k]), (1, pow(BASES[k], -1, p))):
        while len(held[at]) < n:
            step = np.uint64(pow(base, len(held[at]), p))
            held[at] = np.concatenate([held[at], held[at] * step % np.uint64(p)])
    return held[0][:n], held[1][:n]


class PrefixHash:
    """Prefix arrays of one text; answers any span in constant time."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums = []
        for k, p in enumerate(PRIMES):
            c = np.zeros(self.n + 1, dtype=np.uint64)
            np.cumsum(codes * powers(k, self.n)[0] % np.uint64(p), out=c[1:])
            self.sums.append(c)

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of ``length``, by start."""
        count = self.n - length + 1
        out = []
        for k, p in enumerate(PRIMES):
            c = self.sums[k]
            out.append((c[length:] - c[:count]) % np.uint64(p) * powers(k, count)[1] % np.uint64(p))
        return out[0] << np.uint64(31) | out[1]

    def span(self, start: int, length: int) -> tuple[int, int]:
        """The hash of one span, as a pair."""
        return tuple((int(c[start + length]) - int(c[start])) % p * int(powers(k, start + 1)[1][start]) % p for k, (p, c) in enumerate(zip(PRIMES, self.sums, strict=True)))

    def extension(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Length of the longest common extension from the two places."""
        lo, hi = 0, min(self.n - start, other.n - other_start)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.span(start, mid) == other.span(other_start, mid):
                lo = mid
            else:
                hi = mid - 1
        return lo


def sketch(hashed: PrefixHash) -> np.ndarray:
    """64 values of 16 bits, 0 where a slot has no span."""
    out = np.zeros(SLOTS, dtype=np.uint16)
    if not hashed.n:
        return out
    h = hashed.spans(min(SPAN, hashed.n)) * MIX
    h ^= h >> np.uint64(29)
    h *= MIX
    low_bits = 64 - SLOT_BITS
    edges = np.arange(SLOTS, dtype=np.uint64) << np.uint64(low_bits)
    some = h
    if len(h) > 2 * SORTED:
        some = h[(h << np.uint64(SLOT_BITS)) < np.uint64((1 << 64) // len(h) * SORTED)]
    for values in (some, h):
        values = np.sort(values)
        at = np.searchsorted(values, edges)
        slots = values[np.minimum(at, len(values) - 1)] if len(values) else edges * 0
        full = (at < len(values)) & (slots >> np.uint64(low_bits) == np.arange(SLOTS, dtype=np.uint64))
        if full.all():
            break
    out[full] = np.maximum(1, slots[full] >> np.uint64(low_bits - 16) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    used = (a != 0) | (b != 0)
    return float(((a == b) & used).sum() / used.sum()) if used.any() else 1.0


def as_text(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


SCHEMA = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_prefix long"


def _compare(batches):
    """Over rows sorted by (part, head, doc_id descending, digest, text): each document against the next."""
    part_now, before, headed = None, None, False
    for batch in batches:
        rows: list[tuple] = []
        for part, head, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != part_now:
                part_now, before, headed = part, None, False
            if head and headed:
                continue
            mine = None
            if before is not None:
                last, last_text, last_hash, last_sketch = before
                cut = last_hash.n // 2
                edited = last_text[: last_hash.n - cut] + text[:cut]
                edited_hash = PrefixHash(edited)
                edited_sketch = sketch(edited_hash)
                hashed = PrefixHash(text)
                mine = (hashed, sketch(hashed))
                rows.append((last, last_hash.n, edited, as_text(last_sketch), as_text(edited_sketch), likeness(last_sketch, edited_sketch), likeness(last_sketch, mine[1]), last_hash.extension(0, edited_hash, 0)))
            if head:
                headed = True
            else:
                if mine is None:
                    hashed = PrefixHash(text)
                    mine = (hashed, sketch(hashed))
                before = (doc, text, *mine)
        columns = list(zip(*rows, strict=True)) if rows else [()] * 8
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Each document with its fingerprint, its edit by the next document and the likenesses; see the module's text."""
    parts = shuffle_partitions(docs)
    ranges = ranges or 4 * parts
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    # One number for each range: a bounded list, whatever the table's size.
    shares = [i / ranges for i in range(1, ranges)]
    found = texts.agg(F.percentile_approx("doc_id", shares, 10000).alias("cuts"), F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    bounds, times = np.unique(np.array(found["cuts"] or [], dtype=np.int64), return_counts=True)
    # A range holds what lies above the bound before it, up to its own; the bound's id itself has as many ranges as percentiles.
    width = np.ones(2 * len(bounds) + 2, dtype=np.int64)
    width[1:-1:2] = times
    width[-1] = max(1, -(-ranges * found["nulls"] // max(1, found["n"])))
    first_part = np.concatenate([[0], np.cumsum(width)])

    def part_of(ids: pa.Array, digests: pa.Array) -> np.ndarray:
        """Ranges count downwards, as the order does; null ids come last."""
        values, gone = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        left, right = np.searchsorted(bounds, values, side="left"), np.searchsorted(bounds, values, side="right")
        slot = np.where(gone, len(width) - 1, 2 * len(bounds) - left - right)  # even: between bounds, odd: a bound
        upper = (digests.to_numpy(zero_copy_only=False).astype(np.float64) + 2.0**63) / 2.0**64
        return first_part[slot] + np.minimum((upper * width[slot]).astype(np.int64), width[slot] - 1)

    def placed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part_of(batch.column(0), batch.column(1)), pa.int64()), *batch.columns], names=["part", "doc_id", "digest"])

    # The least of the order in each range; "absent" first, so that null ids come last.
    order = F.struct(F.col("doc_id").isNull().alias("absent"), F.bitwise_not("doc_id").alias("down"), "digest", "doc_id")
    least = texts.select("doc_id", "digest").mapInArrow(placed, "part long, doc_id long, digest long").groupBy("part").agg(F.min(order).alias("first")).orderBy("part").collect()
    also: dict[tuple, list[int]] = {}
    for k, row in enumerate(least):  # the first document of a range is the next of the one before's last
        also.setdefault((row["first"]["doc_id"], row["first"]["digest"]), []).append(least[k - 1]["part"])
    ids_also = np.array(sorted({i for i, _ in also if i is not None}), dtype=np.int64)

    def deal(batches):
        for batch in batches:
            ids, digests, body = batch.column("doc_id"), batch.column("digest"), batch.column("text")
            some = np.flatnonzero(np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), ids_also) | ids.is_null().to_numpy(zero_copy_only=False))
            heads = [(i, target) for i in some.tolist() for target in also.get((ids[i].as_py(), digests[i].as_py()), ())]
            names = ["part", "head", "doc_id", "digest", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(part_of(ids, digests), pa.int64()), pa.array(np.zeros(len(ids), np.int32)), ids, digests, body], names=names)
            if heads:
                at = pa.array([i for i, _ in heads])
                yield pa.RecordBatch.from_arrays([pa.array([t for _, t in heads], pa.int64()), pa.array(np.ones(len(heads), np.int32)), ids.take(at), digests.take(at), body.take(at)], names=names)

    dealt = texts.mapInArrow(deal, "part long, head int, doc_id long, digest long, text string").repartition(parts, "part")
    return dealt.sortWithinPartitions("part", "head", F.col("doc_id").desc_nulls_last(), "digest", "text").select("part", "head", "doc_id", "text").mapInArrow(_compare, SCHEMA)


def op9_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", "shared_prefix"
    )
