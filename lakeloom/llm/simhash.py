"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint's bit is set if more than half of the text's word shingles (repeats
included) have it set in their XXH64. Two fingerprints are linked if they differ
in at most ``radius`` bits.

Candidates come from 2^(radius+1) - 1 tables. Bit i has the nonzero code
m(i) = i mod (2^(radius+1) - 1) + 1, and table v keeps the bits whose code has an
odd number of ones in common with v. At most ``radius`` differing bits span no
more than ``radius`` dimensions, so some nonzero v is orthogonal to all their
codes, and that table's key leaves all of them out: every pair within the radius
collides in some table, none is missed.

Equal fingerprints are collapsed first, so copies never meet in a bucket. A
bucket's fingerprints are linked by a forest (each new member is compared with
those not yet reached), not by all pairs, which keeps the components exact. A
bucket beyond ``bucket_limit`` is dealt again by ``radius`` + 1 segments of the
bits that its key leaves out: one segment of any linked pair is equal. What is too
large still is cut into blocks, and each task links two blocks of at most
``bucket_limit`` fingerprints. The components are then joined as tables.

Defined cases: texts of any length are read whole; a null text is empty; a text without words has fingerprint zero
and is linked like any other; a text of fewer words than a shingle has one, the
whole sequence; repeated rows give one result row each; a null doc_id takes part,
and never is the least of its component unless all are null (then null); other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, shuffle_partitions, table
from .components import connected_components

BITS = 64


def shingle_hashes(text: str, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of each word shingle in order; of a text of fewer words, of the whole sequence."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII blanks only
    if not words:
        return np.zeros(0, dtype="<u8")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)), dtype="<u8", count=n)


def simhash(hashes: np.ndarray) -> int:
    """The majority of each bit, unsigned; zero of nothing."""
    votes = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 15):
        votes += np.unpackbits(hashes[lo : lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: str, shingle: int, seed: int) -> int:
    """The SimHash of one whole text, unsigned."""
    return simhash(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row."""

    def task(batches):
        for batch in batches:
            made = np.array([fingerprint(t or "", shingle, seed) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64), pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """For each table the bits that its key keeps."""
    codes = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if ((i % codes + 1) & v).bit_count() & 1) for v in range(1, codes + 1)]


def finer_masks(kept: int, radius: int) -> list[int]:
    """``kept`` with one more of ``radius`` + 1 segments of the other bits each."""
    out = [kept] * (radius + 1)
    for k, i in enumerate(i for i in range(BITS) if not kept >> i & 1):
        out[k % (radius + 1)] |= 1 << i
    return out


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges within the radius that connect exactly the components of distinct ``fps``."""
    a, b = [], []
    left = fps
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                hit, left = left[near], left[~near]
                a.append(np.full(len(hit), x))
                b.append(hit)
                reached.extend(hit)
    if not a:
        return fps[:0], fps[:0]
    return np.concatenate(a), np.concatenate(b)


def _link_buckets(radius: int, limit: int):
    """Over rows sorted by (mask, key): edges of each bucket (kind 0); buckets beyond ``limit`` pass on as rows of kind 1, with their mask in ``v``."""

    def task(batches):
        mask_now, key_now, held, large = None, None, [], False

        def close():
            if held and not large:
                fps = np.concatenate(held)
                if len(fps) > 1:
                    return [(0, *forest(fps, radius))]
            return []

        for batch in batches:
            masks, keys, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp"))
            fps = fps.view(np.uint64)
            cuts = np.flatnonzero((np.diff(masks) != 0) | (np.diff(keys) != 0)) + 1
            out = []
            for lo, hi in zip([0, *cuts], [*cuts, len(fps)], strict=True):
                if hi == lo:
                    continue
                if masks[lo] != mask_now or keys[lo] != key_now:
                    out += close()
                    mask_now, key_now, held, large = masks[lo], keys[lo], [], False
                held.append(fps[lo:hi])
                if large or sum(map(len, held)) > limit:
                    large = True
                    rows = np.concatenate(held)
                    out.append((1, rows, np.full(len(rows), mask_now).view(np.uint64)))
                    held = [rows[:0]]
            yield _edges(out)
        yield _edges(close())

    return task


def _edges(parts) -> pa.RecordBatch:
    parts = [p for p in parts if len(p[1])]
    column = lambda i: np.concatenate([p[i] for p in parts]).view(np.int64) if parts else np.zeros(0, np.int64)
    kinds = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int32) if parts else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(column(1)), pa.array(column(2))], names=["kind", "u", "v"])


EDGES = "kind int, u long, v long"
KEYED = "mask long, key long, fp long"


def _finer(radius: int):
    """Rows of large buckets, as (fp, mask), under each finer key."""

    def task(batches):
        for batch in batches:
            fps, masks = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("u", "v"))
            out: list[tuple] = []
            for mask in np.unique(masks).tolist():
                some = fps[masks == mask]
                out += [(np.full(len(some), m, np.uint64), some & np.uint64(m), some) for m in finer_masks(mask, radius)]
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.uint64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["mask", "key", "fp"])

    return task


def _bucketed(rows: DataFrame, radius: int, limit: int, parts: int) -> DataFrame:
    return checkpointed(rows.repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_link_buckets(radius, limit), EDGES))


def _block_forest(radius: int):
    def task(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _edges([(0, *forest(np.concatenate([b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]), radius))])

    return task


def _blocks(large: DataFrame, radius: int, limit: int) -> DataFrame:
    """Edges of buckets (fp, mask) of any size: each pair of a bucket's blocks by itself."""
    keyed = large.select(F.col("v").alias("mask"), F.col("u").bitwiseAND(F.col("v")).alias("key"), F.col("u").alias("fp"))
    counted = checkpointed(keyed.groupBy("mask", "key").agg(F.ceil(2 * F.count("*") / F.lit(limit)).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = keyed.join(counted, ["mask", "key"]).select("mask", "key", "fp", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pair = dealt.select("mask", "key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp")
    return pair.groupBy("mask", "key", "a", "b").applyInArrow(_block_forest(radius), EDGES)


def links(fps: DataFrame, radius: int = 4, bucket_limit: int = 4096) -> DataFrame:
    """Edges ``u``, ``v`` between distinct values of ``fp``; they connect what all links would."""
    parts = shuffle_partitions(fps)
    tables = F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in covering_masks(radius)))
    found = _bucketed(fps.select(F.inline(tables), "fp"), radius, bucket_limit, parts)
    edges = found.where("kind = 0")
    large = found.where("kind = 1")
    if not large.isEmpty():
        found = _bucketed(large.select("u", "v").mapInArrow(_finer(radius), KEYED), radius, bucket_limit, parts)
        edges = edges.unionByName(found.where("kind = 0"))
        large = found.where("kind = 1")
        if not large.isEmpty():
            edges = edges.unionByName(_blocks(large, radius, bucket_limit))
    return edges.select("u", "v")


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the least doc_id reachable) of every row."""
    marked = checkpointed(fingerprints(docs, shingle, seed))
    firsts = checkpointed(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(links(firsts.select("fp"), radius))
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Written before the join, so that a component of many fingerprints can be split there.
    leasts = checkpointed(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = rooted.select("fp", "root").join(leasts, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def op7_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
