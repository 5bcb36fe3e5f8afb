"""Ranked lexical search: an inverted index in shards, searched with variable-block-max WAND.

The index: documents are dealt into shards of bounded size as they are read. A shard
holds, for each term, its documents in order with the term's impact there (what the term
adds to a score but for its weight). Each such list is cut into blocks, and a block knows
its largest impact. The cuts are chosen by dynamic programming so that the bound error, the
sum over all postings of their block's largest impact less their own, plus ``penalty`` for
each block, is the least of all cuts into blocks of at most ``longest`` postings.

The search: every shard is searched for every item. An item's k-th best score so far is
its threshold. Weighted largest impacts of whole lists say whether a shard can reach it;
where blocks of the item's lists overlap, their sum bounds each range of documents. Only
ranges that reach the threshold are scored, the most promising first, and the threshold
rises as they are. It starts with what a few shards, searched before, have shown. Nothing
that could reach the threshold is skipped, so the result is exact; the best of all tasks
are ranked once more for each item.

Items go in blocks of ``items_per_block``, which bounds what is sent to tasks. If the
items have at most ``most_terms`` terms, only these are indexed; otherwise all are.

Defined cases: a null or empty text has no terms and is never found; texts of any length
are indexed whole; rows that share a doc_id are documents each; a null doc_id comes last
among equal scores; items that share an item_id, or have none, have a ranking each; items
without a term, or whose terms no document has, have no rows; documents whose score is 0
aren't ranked; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, table

#: Bytes of terms stay, A to Z lower-cased; all others are blanks.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
RAW = "shard long, term string, n long, total long, a binary, b binary, c binary"
BLOCKED = "shard long, term string, a binary, b binary, ends binary, tops binary"
FOUND = "item int, doc_id long, score long"
HELD_POSTINGS = 4_000_000


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score for each unit of its weight."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def block_ends(lists: list[np.ndarray], penalty: float, longest: int, most_cells: int = 1_000_000) -> list[np.ndarray]:
    """For each list of impacts where its blocks end: the cuts of least bound error plus ``penalty`` a block.

    ``best[j]`` is the least cost of the first j postings; the last block of the first j has
    1 to ``longest`` of them. Lists of like length are worked on together.
    """
    order = sorted(range(len(lists)), key=lambda i: -len(lists[i]))
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(lists)
    sizes = np.arange(1, longest + 1, dtype=np.float64)
    at = 0
    while at < len(order) and len(lists[order[at]]):
        n = len(lists[order[at]])
        group = [i for i in order[at : at + max(1, most_cells // n)] if len(lists[i])]
        at += len(group)
        length = np.array([len(lists[i]) for i in group])
        cells = np.zeros((len(group), n))
        for row, i in enumerate(group):
            cells[row, : len(lists[i])] = lists[i]
        best = np.full((len(group), longest + n), np.inf)
        best[:, longest - 1] = 0
        last = np.zeros((len(group), n), dtype=np.int32)
        top = np.zeros((len(group), longest))
        for j in range(n):
            live = int(np.searchsorted(-length, -j, side="left"))
            x = cells[:live, j]
            top[:live, 1:] = np.maximum(top[:live, :-1], x[:, None])
            top[:live, 0] = x
            cost = top[:live] * sizes
            cost += best[:live, j : j + longest][:, ::-1]
            pick = cost.argmin(1)
            last[:live, j] = pick + 1
            best[:live, longest + j] = cost[np.arange(live), pick] + penalty
        for row, i in enumerate(group):
            ends, j = [], len(lists[i])
            while j:
                ends.append(j)
                j -= int(last[row, j - 1])
            out[i] = np.array(ends[::-1], dtype=np.uint32)
    return out


@dataclass(frozen=True)
class Index:
    """``postings``: rows of BLOCKED, a shard's next to one another, its documents' ids (term null) first; ``counts``: ``term`` and ``df``."""

    postings: DataFrame
    counts: DataFrame
    n_docs: int
    n_terms: int


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    arrow = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, arrow[k]) for c, k in zip(zip(*rows, strict=True) if rows else [()] * len(names), kinds, strict=True)], names=list(names))


def index(docs: DataFrame, terms: set[bytes] | None = None, shard_docs: int = 8192, penalty: float = 2_000_000, longest: int = 64) -> Index:
    """The index of ``docs`` (doc_id, text), of ``terms`` only if they are given."""

    def read(batches):
        shard = TaskContext.get().partitionId() << 32
        names: dict[bytes, int] = {}
        ids, lengths, at, which, times = [], [], [], [], []

        def flush():
            out = [(shard, None, sum(n > 0 for n in lengths), sum(lengths), np.array([i or 0 for i in ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes(), np.array([i is None for i in ids], "u1").tobytes())]
            t, d, f = np.array(which, np.int64), np.array(at, "<u4"), np.array(times, "<u4")
            by = np.argsort(t, kind="stable")
            t, d, f = t[by], d[by], f[by]
            cuts = np.searchsorted(t, np.arange(len(names) + 1))
            out += [(shard, name.decode(), int(hi - lo), 0, d[lo:hi].tobytes(), f[lo:hi].tobytes(), None) for name, lo, hi in zip(names, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            names.clear()
            for held in (ids, lengths, at, which, times):
                held.clear()
            for lo in range(0, len(out), 4096):
                yield _rows(out[lo : lo + 4096], RAW)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found = Counter(words if terms is None else filter(terms.__contains__, words))
                at.extend([len(ids)] * len(found))
                which.extend([names.setdefault(t, len(names)) for t in found])
                times.extend(found.values())
                ids.append(doc)
                lengths.append(len(words))
                if len(ids) >= shard_docs or len(at) >= HELD_POSTINGS:
                    yield from flush()
                    shard += 1
        if ids:
            yield from flush()

    raw = checkpointed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(read, RAW))
    whole = raw.where("term IS NULL").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    n_docs, n_terms = whole["n"] or 0, whole["total"] or 0

    def block(batches):
        state: dict = {"shard": None}
        held: list[tuple] = []

        def flush():
            lists = [impacts(np.frombuffer(tf, "<u4").astype(np.int64), state["m"][np.frombuffer(d, "<u4")]) for _, d, tf in held]
            rows = []
            for (term, d, _), x, ends in zip(held, lists, block_ends(lists, penalty, longest), strict=True):
                tops = np.maximum.reduceat(x, np.r_[0, ends[:-1]].astype(np.int64))
                rows.append((state["shard"], term, d, x.astype("<u4").tobytes(), ends.astype("<u4").tobytes(), tops.astype("<u4").tobytes()))
            held.clear()
            for lo in range(0, len(rows), 4096):
                yield _rows(rows[lo : lo + 4096], BLOCKED)

        for batch in batches:
            for row in batch.to_pylist():
                if row["term"] is None:
                    yield from flush()
                    # Python's integers, as the product can be beyond 64 bits.
                    lengths = np.frombuffer(row["b"], "<i8")
                    distinct, where = np.unique(lengths, return_inverse=True)
                    m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in distinct], np.int64)
                    state.update(shard=row["shard"], m=m[where])
                    yield _rows([(row["shard"], None, row["a"], row["c"], None, None)], BLOCKED)
                else:
                    held.append((row["term"], row["a"], row["b"]))
        yield from flush()

    counts = checkpointed(raw.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("df")))
    return Index(checkpointed(raw.mapInArrow(block, BLOCKED)), counts, n_docs, n_terms)


class Shard:
    """The lists of one shard, as arrays."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray):
        self.ids, self.nulls, self.lists = ids, nulls, {}

    def add(self, term: str, docs: bytes, values: bytes, ends: bytes, tops: bytes) -> None:
        d, e = np.frombuffer(docs, "<u4").astype(np.int64), np.frombuffer(ends, "<u4").astype(np.int64)
        t = np.frombuffer(tops, "<u4").astype(np.int64)
        after = d[e - 1] + 1  # the document after each block's last
        # Where the bound of the list changes, and by how much: its blocks share the documents out without gaps.
        self.lists[term] = d, np.frombuffer(values, "<u4").astype(np.int64), np.r_[0, after], np.diff(np.r_[0, t, 0]), int(t.max())

    def search(self, terms: list[tuple[str, int]], k: int, floor: int, best: tuple[np.ndarray, np.ndarray, np.ndarray], batch: int = 256) -> tuple[tuple, int, int]:
        """``best`` (scores, nulls, ids) with this shard's, and how many documents were scored of how many."""
        lists = [(w, *self.lists[t]) for t, w in terms if t in self.lists]
        threshold = lambda: max(floor, int(best[0][k - 1]) if len(best[0]) == k else 1)
        if not lists or sum(w * top for w, *_, top in lists) < threshold():
            return best, 0, len(self.ids)
        places = np.concatenate([p for _, _, _, p, _, _ in lists])
        by = np.argsort(places, kind="stable")
        bound = np.cumsum(np.concatenate([w * change for w, _, _, _, change, _ in lists])[by])
        places = places[by]
        new = np.flatnonzero(np.r_[places[1:] != places[:-1], True])
        starts, stops, bound = places[new], np.r_[places[new[1:]], len(self.ids)], bound[new]
        ranges = np.flatnonzero((bound >= threshold()) & (stops > starts))
        ranges = ranges[np.argsort(-bound[ranges], kind="stable")]
        scored = 0
        while len(ranges):
            held = np.cumsum((stops - starts)[ranges])
            cut = int(np.searchsorted(held, batch)) + 1
            some, ranges = np.sort(ranges[:cut]), ranges[cut:]
            scored += int(held[min(cut, len(held)) - 1])
            score = np.zeros(len(self.ids), np.int64)
            for w, docs, values, *_ in lists:
                lo, hi = np.searchsorted(docs, starts[some]), np.searchsorted(docs, stops[some])
                n = hi - lo
                if total := int(n.sum()):
                    at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(total)
                    score[docs[at]] += w * values[at]  # a document stands once in a list
            hit = np.flatnonzero(score >= threshold())
            if len(hit):
                every = [np.r_[a, b] for a, b in zip(best, (score[hit], self.nulls[hit], self.ids[hit]), strict=True)]
                first = np.lexsort((every[2], every[1], -every[0]))[:k]
                best = tuple(x[first] for x in every)
            ranges = ranges[bound[ranges] >= threshold()]
            batch *= 4
        return best, scored, len(self.ids)


NONE = (np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.int64))


def _searched(postings: DataFrame, items: list[list[tuple[str, int]]], k: int, floors: list[int]) -> DataFrame:
    """The ``k`` best of each task, of those that reach an item's floor."""
    wanted = {t for terms in items for t, _ in terms}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = [NONE] * len(items)
        shard: Shard | None = None

        def run():
            for i, terms in enumerate(items):
                if shard is not None and terms:
                    best[i], _, _ = shard.search(terms, k, floors[i], best[i])

        for batch in batches:
            for row in batch.to_pylist():
                if row["term"] is None:
                    run()
                    shard = Shard(np.frombuffer(row["a"], "<i8"), np.frombuffer(row["b"], "u1"))
                elif row["term"] in wanted:
                    shard.add(row["term"], row["a"], row["b"], row["ends"], row["tops"])
        run()
        rows = [(i, None if null else doc, score) for i, each in enumerate(best) for score, null, doc in zip(*(c.tolist() for c in each), strict=True)]
        yield _rows(rows, FOUND)

    return postings.mapInArrow(task, FOUND)


def search(of: Index, items: list[tuple], k: int = 20, first_shards: int = 8) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` for a bounded list of (item_id, text)."""
    spark = of.postings.sparkSession
    counted = [Counter(t.decode() for t in terms_of(text)) for _, text in items]
    terms = spark.createDataFrame([(t,) for t in sorted({t for c in counted for t in c})], "term string")
    df = {r["term"]: r["df"] for r in of.counts.join(F.broadcast(terms), "term").collect()}  # the items' own terms
    weights = {t: weight(of.n_docs, n) for t, n in df.items()}
    asked = [[(t, weights[t] * c) for t, c in each.items() if weights.get(t, 0) > 0] for each in counted]
    some = [r["shard"] for r in of.postings.where("term IS NULL").select("shard").orderBy(F.xxhash64("shard"), "shard").limit(first_shards).collect()]
    floors = [1] * len(items)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    for r in ranked(_searched(of.postings.where(F.col("shard").isin(some)), asked, k, floors)).where(F.col("rank") == k).collect():
        floors[r["item"]] = r["score"]
    ids = F.broadcast(spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long"))
    return ranked(_searched(of.postings, asked, k, floors)).join(ids, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, items_per_block: int = 1024, most_terms: int = 500_000, **settings) -> DataFrame:
    """The ``k`` best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    read = checkpointed(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")))
    wanted: set[bytes] | None = set()
    for r in read.select("text").toLocalIterator():
        wanted.update(terms_of(r["text"]))
        if len(wanted) > most_terms:
            wanted = None
            break
    of = index(docs, wanted, **settings)
    block: list[tuple] = []
    found: list[DataFrame] = []
    for r in read.toLocalIterator():
        block.append((r["item_id"], r["text"]))
        if len(block) == items_per_block:
            found.append(checkpointed(search(of, block, k)))
            block = []
    if block or not found:
        found.append(search(of, block, k))
    return functools.reduce(DataFrame.unionByName, found)


def op11_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
