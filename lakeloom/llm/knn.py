"""Exact top-k by inner product as a Voronoi kNN join.

With M the largest norm, a data vector x becomes (x, sqrt(M^2 - |x|^2)) and a
query q becomes (q, 0). Their squared distance is |q|^2 + M^2 - 2 <q, x>, so for
one query the nearest are those of the highest inner product. Pivots (a bounded
sample of the data) cut the space into cells; data and queries belong to the cell
of their nearest pivot, and data are also told apart by rings of distance from
it. A summary of each cell and ring (count, least and greatest distance) and of
each query group (count, radius) bounds how far the k-th neighbour of any query
of the group can be, and how near the data of a ring can come. A ring goes only
to the groups that it can serve, and each group is solved exactly on what it got.

The summaries have at most ``pivots`` x ``rings`` rows. Query groups are split to
at most ``group_limit`` queries; data for a group are spread over slices that
grow with the number of shuffle partitions, so no task holds all of either. Within a
slice each query passes over blocks that can't reach its own k-th best score so far. Each
slice's k best are ranked once more for each query. Where the data have no
clusters the bounds exclude little and the join is the whole query set against
all rows, in blocks.

Defined cases: vectors that are null or hold null or non-finite components take
no part, nor do rows without a vec_id; rows that share a vec_id are told apart by a
number of their own: each is a candidate of the others, and each that is a query has
a ranking of its own; shorter vectors count as padded by zeros; scores beyond a
long stop at its ends; a table without queries or candidates gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import checkpointed, shuffle_partitions, table

BLOCK = "cell int, sub int, slice int, query int, rows binary, ids binary, width int, wide int, body binary, home int, least double, most double"
SLACK = 1e-6


def quantised(vectors: DataFrame, scale: float) -> DataFrame:
    """``row`` (a number of its own), ``vec_id``, ``v`` (doubles of floor(scale * x), as bytes), ``n`` and ``sq`` for vectors that take part."""

    def task(batches):
        for batch in batches:
            lists = batch.column(1)
            ids, out = [], []
            for doc, x in zip(batch.column(0).to_pylist(), lists, strict=True):
                if doc is None or not x.is_valid:
                    continue
                values = x.values.cast(pa.float64())
                if values.null_count:
                    continue
                q = np.floor(values.to_numpy(zero_copy_only=False) * scale) + 0.0
                if np.isfinite(q).all():
                    ids.append(doc)
                    out.append(q)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([q.astype("<f8").tobytes() for q in out], pa.binary()), pa.array([len(q) for q in out], pa.int32()), pa.array([float(q @ q) for q in out], pa.float64())],
                names=["vec_id", "v", "n", "sq"],
            )

    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return read.mapInArrow(task, "vec_id long, v binary, n int, sq double").withColumn("row", F.monotonically_increasing_id())


def matrix(bodies: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(bodies), dims))
    for i, body in enumerate(bodies):
        out[i, : len(body) // 8] = np.frombuffer(body, dtype="<f8")
    return out


def packed(x: np.ndarray) -> tuple[int, bytes]:
    """The narrowest exact form: 16-bit integers or doubles."""
    wide = int(len(x) and np.abs(x).max() >= 32768)
    return wide, x.astype("<f8" if wide else "<i2").tobytes()


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond a double's integers in Python's, cut to a long."""
    most = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if most < 2**53:
        return q @ x.T
    to_int = np.vectorize(int, otypes=[object])
    exact = to_int(q).dot(to_int(x).T)
    return np.vectorize(lambda s: max(-(2**63), min(2**63 - 1, s)), otypes=[object])(exact)


def _distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T + (lift[:, None] - pivot_lift[None]) ** 2
    return np.sqrt(np.maximum(square, 0))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of one query: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:k] if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)


def solved(queries: tuple[np.ndarray, np.ndarray], blocks: list[tuple], centre: np.ndarray, centre_lift: np.ndarray, most: float, k: int) -> tuple[list[list], int]:
    """For each query (numbers, vectors) scores and ids among which its ``k`` best of all ``blocks`` are, and how many pairs were scored.

    A block is (cell, least and greatest distance from the cell's pivot, function giving numbers,
    ids and vectors). By the triangle inequality it can't come nearer to a query than their
    distances from the pivot differ, so its scores there are bounded; a query passes over a
    block whose bound is below its k-th best score so far. Near blocks come first.
    """
    q_rows, q = queries
    found: list[list] = [[] for _ in q_rows]
    best_so_far = np.full((len(q_rows), k), -np.inf)
    square = (q * q).sum(1)
    away = _distances(q, np.zeros(len(q)), centre, centre_lift)
    bounds = []
    for cell, least, greatest, _ in blocks:
        nearest = np.maximum(0.0, np.maximum(away[:, cell] - greatest, least - away[:, cell]))
        bounds.append((square + most - nearest * nearest) / 2 + SLACK * (square + most + 1))
    scored = 0
    for at in sorted(range(len(blocks)), key=lambda i: -float(bounds[i].max(initial=0))):
        live_all = np.flatnonzero(bounds[at] >= best_so_far.min(1))
        if not len(live_all):
            continue
        own, ids, x = blocks[at][3]()
        for lo in range(0, len(live_all), 1024):  # bounded blocks of scores
            live = live_all[lo : lo + 1024]
            scores = products(q[live], x)
            scored += scores.size
            eligible = q_rows[live, None] != own[None]
            if scores.dtype != object:
                there = np.where(eligible, scores, -np.inf)
                if len(ids) > k:
                    there = np.partition(there, len(ids) - k, axis=1)[:, len(ids) - k :]
                both = np.concatenate([best_so_far[live], there], axis=1)
                best_so_far[live] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
            hit_q, hit_x = np.nonzero(eligible & (scores >= best_so_far[live].min(1)[:, None]))
            for i, cut in zip(*_runs(hit_q), strict=True):
                found[live[i]].append((scores[i, hit_x[cut]], ids[hit_x[cut]]))
    return found, scored


def top_k(vectors: DataFrame, k: int = 20, query_modulus: int = 20, scale: float = 64.0, pivots: int = 16, rings: int = 8, group_limit: int = 8192) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows whose id ``query_modulus`` divides, against all other rows."""
    result = "query_id long, rank int, vec_id long, score long"
    table_ = checkpointed(quantised(vectors, scale))  # written once, so that a row keeps its number
    shape = table_.agg(F.max("n").alias("n"), F.max("sq").alias("sq")).first()
    if shape["n"] is None:
        return vectors.sparkSession.createDataFrame([], result)
    dims, most = max(1, shape["n"]), shape["sq"]
    sample = table_.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(pivots).collect()
    centre = matrix([bytes(r["v"]) for r in sample], dims)
    lifted = lambda sq: np.sqrt(np.maximum(most - sq, 0))
    centre_lift = lifted((centre * centre).sum(1))
    width = max(2 * np.sqrt(most), 1e-9) / rings
    parts = shuffle_partitions(vectors)
    slices = max(2, -(-2 * parts // pivots))

    def placed(batch):
        """Of a batch: row numbers, ids, matrix, cell and distance as data; for queries, as queries."""
        ids, rows = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "row"))
        x = matrix(batch.column("v").to_pylist(), dims)
        as_data = _distances(x, lifted((x * x).sum(1)), centre, centre_lift)
        as_query = _distances(x, np.zeros(len(x)), centre, centre_lift)
        cell, q_cell = as_data.argmin(1), as_query.argmin(1)
        at = np.arange(len(ids))
        return rows, ids, x, cell, as_data[at, cell], ids % query_modulus == 0, q_cell, as_query[at, q_cell]

    def summarise(batches):
        for batch in batches:
            if batch.num_rows:
                _, _, _, cell, d, is_query, q_cell, q_d = placed(batch)
                ring = np.minimum(d // width, rings - 1).astype(np.int32)
                rows = [(0, int(c), int(r), len(s := d[(cell == c) & (ring == r)]), float(s.min()), float(s.max())) for c, r in sorted(set(zip(cell.tolist(), ring.tolist(), strict=True)))]
                rows += [(1, int(c), 0, len(s := q_d[is_query & (q_cell == c)]), float(s.min()), float(s.max())) for c in sorted(set(q_cell[is_query].tolist()))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["query", "cell", "ring", "n", "least", "most"])

    counted = table_.select("row", "vec_id", "v").mapInArrow(summarise, "query long, cell long, ring long, n long, least double, most double")
    summary = counted.groupBy("query", "cell", "ring").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect()
    data = sorted((r["cell"], r["ring"], r["n"], r["least"], r["most"]) for r in summary if not r["query"])
    groups = {r["cell"]: (r["n"], r["most"]) for r in summary if r["query"]}
    between = _distances(centre, centre_lift, centre, centre_lift)
    serves: dict[tuple[int, int], list[int]] = {(c, r): [] for c, r, *_ in data}
    for g, (_, radius) in groups.items():
        reach, had = np.inf, 0
        for far, n in sorted((radius + between[g, c] + hi, n) for c, r, n, lo, hi in data):
            had += n
            if had >= k + 1:  # one of them may be the query itself
                reach = far
                break
        for c, r, _, lo, hi in data:
            nearest = max(0.0, between[g, c] - radius - hi, lo - between[g, c] - radius)
            if nearest <= reach * (1 + SLACK) + SLACK:
                serves[c, r].append(g)
    subs = {g: -(-n // group_limit) for g, (n, _) in groups.items()}

    def deal(batches):
        turn = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, ids, x, cell, d, is_query, q_cell, _ = placed(batch)
            ring = np.minimum(d // width, rings - 1).astype(np.int64)
            rows = []
            for g in groups:
                units = np.zeros((len(centre), rings), dtype=bool)
                for (c, r), targets in serves.items():
                    units[c, r] = g in targets
                some = units[cell, ring]
                # A block has rows of one cell, of like distance from its pivot.
                chosen = np.flatnonzero(some)
                chosen = chosen[np.lexsort((d[chosen], cell[chosen]))]
                edges = np.searchsorted(cell[chosen], np.arange(len(centre) + 1))
                for pick in (chosen[at : min(at + 2048, hi)] for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) for at in range(lo, hi, 2048)):
                    wide, body = packed(x[pick])
                    place = (int(cell[pick[0]]), float(d[pick[0]]), float(d[pick[-1]]))
                    rows += [(g, sub, turn % slices, 0, numbers[pick].astype("<i8").tobytes(), ids[pick].astype("<i8").tobytes(), dims, wide, body, *place) for sub in range(subs[g])]
                    turn += 1
                for sub in range(subs[g]):
                    pick = np.flatnonzero(is_query & (q_cell == g) & (numbers % subs[g] == sub))
                    if len(pick):
                        wide, body = packed(x[pick])
                        rows += [(g, sub, s, 1, numbers[pick].astype("<i8").tobytes(), ids[pick].astype("<i8").tobytes(), dims, wide, body, -1, 0.0, 0.0) for s in range(slices)]
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.float64(), pa.float64()), strict=True)], names=[f.split()[0] for f in BLOCK.split(", ")])

    def solve(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]

        def block(row):
            return np.frombuffer(row["rows"], dtype="<i8"), np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["body"], dtype="<f8" if row["wide"] else "<i2").reshape(-1, row["width"]).astype(np.float64)

        queries = [block(r) for r in rows if r["query"]]
        if not queries:
            return
        q_rows, q_ids, q = (np.concatenate([b[i] for b in queries]) for i in range(3))
        blocks = [(r["home"], r["least"], r["most"], functools.partial(block, r)) for r in rows if not r["query"]]
        found, _ = solved((q_rows, q), blocks, centre, centre_lift, most, k)
        out = []
        for number, qid, each in zip(q_rows.tolist(), q_ids.tolist(), found, strict=True):
            if each:
                scores, ids = np.concatenate([e[0] for e in each]), np.concatenate([e[1] for e in each])
                pick = best(scores, ids, k)
                out += [(number, qid, int(i), int(s)) for i, s in zip(ids[pick].tolist(), scores[pick].tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "query_id", "vec_id", "score"])

    partial = table_.select("row", "vec_id", "v").mapInArrow(deal, BLOCK).groupBy("cell", "sub", "slice").applyInArrow(solve, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")


def _runs(sorted_ids: np.ndarray) -> tuple[list[int], list[slice]]:
    """Values of a sorted array and the slices where each stands."""
    if not len(sorted_ids):
        return [], []
    cuts = np.flatnonzero(np.diff(sorted_ids)) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(sorted_ids)]
    return sorted_ids[starts].tolist(), [slice(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def op4_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
