"""Cost-balanced packing of token sequences.

Every document becomes ids plus an end id. Runs of ``seq_len`` ids fill a
sequence by themselves; what remains of each document is packed, shard by
shard, in descending length: each piece goes to the sequence of lowest estimated
cost (linear in its tokens plus quadratic in each piece's own length, as
attention inside a document is) among all that have room for it. Only a piece for
which no sequence has room is cut. A shard has as many sequences of ``seq_len`` as
its tokens fill, and shorter ones at powers of two for the rest, which need no
padding; so each sequence of a shard is filled to its end.

No shuffle: a task packs the rows it reads, holding one shard of ids at most.

Defined cases: a null text is empty (only the end id); a text of any length is
cut into as many pieces as needed; repeated rows are packed once for each row; a
null doc_id stays null; an empty table gives an empty result; other columns are
ignored. Ties in length keep arrival order, ties in cost the lower sequence.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import byte_bpe, default_tokenizer, table

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def capacities(total: int, seq_len: int) -> list[int]:
    """Full sequences for ``total`` ids, and powers of two for what is left."""
    rest = total % seq_len
    return [seq_len] * (total // seq_len) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def balance(lengths: list[int], seq_len: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int, int]]]:
    """For each item its parts as (start, length, sequence, offset).

    ``lengths`` are 1 to ``seq_len``; sequences are numbered from 0, their sizes
    those of ``capacities``. Their number is bounded by the shard's size, so the
    cheapest with room is looked for among all of them at once.
    """
    room = np.array(capacities(sum(lengths), seq_len), dtype=np.int64)
    size = room.copy()
    cost = np.zeros(len(room))
    placed: list[list[tuple[int, int, int, int]]] = [[] for _ in lengths]
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[item]
        while left:
            open_to = room >= left
            if not open_to.any():  # cut: as much as the lowest-cost sequence can take
                open_to = room > 0
            s = int(np.where(open_to, cost, np.inf).argmin())
            take = min(left, int(room[s]))
            placed[item].append((start, take, s, int(size[s] - room[s])))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start, left = start + take, left - take
    return placed


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    seq_len: int = 1024,
    end_id: int = 0,
    shard_tokens: int = 2_000_000,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their places in sequences; see the module's text."""

    def task(batches):
        bpe = byte_bpe(tokenizer)
        base = TaskContext.get().partitionId() << 32
        state = {"next": 0}
        rows: list[tuple] = []
        shard: list[tuple] = []
        held = 0

        def flush():
            for (doc, at, ids, total), parts in zip(shard, balance([len(x[2]) for x in shard], seq_len, linear, quadratic), strict=True):
                for start, length, seq, offset in parts:
                    rows.append((doc, at + start, length, zlib.crc32(ids[start : start + length].tobytes()), total, base + state["next"] + seq, offset))
            state["next"] += len(capacities(sum(len(x[2]) for x in shard), seq_len))
            shard.clear()

        def out():
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))
            rows.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(bpe.encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                whole = len(ids) - len(ids) % seq_len
                for at in range(0, whole, seq_len):
                    rows.append((doc, at, seq_len, zlib.crc32(ids[at : at + seq_len].tobytes()), len(ids), base + state["next"], 0))
                    state["next"] += 1
                if whole < len(ids):
                    shard.append((doc, whole, ids[whole:].copy(), len(ids)))
                    held += len(ids) - whole
                if held >= shard_tokens:
                    flush()
                    held = 0
            yield out()
        flush()
        yield out()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(task, SCHEMA)


def op3_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
