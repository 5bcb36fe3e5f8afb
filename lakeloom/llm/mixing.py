"""Mixing overlapping sources to target weights as a minimum-cost flow.

A document may belong to several sources. Documents are aggregated by their
membership pattern: a pattern can give its words once at no cost, and each further
time at a cost that rises by one, so that no word is repeated while another that
would serve is unused. Each source wants its quota of words. The cheapest flow from
patterns to sources says how many words of each pattern go into the mix; what is
solved on the driver are the patterns and sources, which ``most_patterns`` bounds.

What a pattern gives is then turned into documents. Its whole copies take every
document; of the rest, documents go in by the order of a seeded hash until the next one
would not fit. That place is found by histograms of the hash, refined bin by bin (each a
combined sum over a narrow table), so nothing is sorted as a whole. Of the bounded
number of documents around it, those that still fit are taken in the same order.

Sources are in code-point order, null last; weights repeat over them. Targets share
``share`` times all words by weight; one that exceeds ``most_copies`` times the words of
its source stops there, and the excess is shared anew among the others.

Defined cases: a null text has no words; a document without words takes none; a null
source is a source of its own; repeated rows, with or without an id, are documents each
(equal rows are told apart by a number of their own, and which of them goes in makes no
difference to the result); a source without words has the target 0; texts of any length
are counted whole; an empty table gives an empty result; other columns pass through,
but the five that are added replace those of their names.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: Bits of one refinement, of the content's hash, of the row number's hash.
BITS, CONTENT_BITS, ROW_BITS = 12, 60, 48


def targets(sizes: dict, weights: tuple[float, ...], share: float, most_copies: int) -> dict:
    """Words that each source is to give, by its size; keys in code-point order, None last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_to, out = share * sum(sizes.values()), list(order), {}
    while open_to:
        per = left / sum(weight[s] for s in open_to)
        full = [s for s in open_to if weight[s] * per > most_copies * sizes[s]]
        if not full:
            return out | {s: weight[s] * per for s in open_to}
        for s in full:
            out[s] = float(most_copies * sizes[s])
        left -= sum(out[s] for s in full)
        open_to = [s for s in open_to if s not in out]
    return out


def cheapest_flow(sizes: dict[tuple, int], quotas: dict, most_copies: int) -> dict[tuple, dict]:
    """Words of each pattern that go to each of its sources, at the least cost of repeats.

    All cost lies on the arcs into the patterns, so the cheapest flow is found copy by
    copy: with the first copies open as much as can be is pushed along augmenting paths,
    then with the second ones, and so on.
    """
    flow: dict[tuple, dict] = {p: {} for p in sizes}
    want = dict(quotas)
    holders: dict = {s: [] for s in quotas}
    for p in sizes:
        for s in dict.fromkeys(p):
            holders[s].append(p)
    free = dict.fromkeys(sizes, 0)
    for _ in range(most_copies):
        for p in sizes:
            free[p] += sizes[p]
        while True:
            came: dict = {}
            queue = deque()
            for p in sizes:
                if free[p] > 0:
                    came[0, p] = None
                    queue.append((0, p))
            end = None
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == 0:
                    for s in dict.fromkeys(x):
                        if (1, s) not in came:
                            came[1, s] = (0, x)
                            if want[s] > 0:
                                end = (1, s)
                                break
                            queue.append((1, s))
                else:  # what a pattern gives to this source can go to another of its sources
                    for p in holders[x]:
                        if (0, p) not in came and flow[p].get(x, 0) > 0:
                            came[0, p] = (1, x)
                            queue.append((0, p))
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()  # pattern, source, pattern, …, source
            amount = min(free[path[0][1]], want[end[1]], *(flow[path[i + 1][1]][path[i][1]] for i in range(1, len(path) - 1, 2)))
            for i in range(0, len(path), 2):
                p, s = path[i][1], path[i + 1][1]
                flow[p][s] = flow[p].get(s, 0) + amount
                if i:
                    flow[p][path[i - 1][1]] -= amount
            free[path[0][1]] -= amount
            want[end[1]] -= amount
    return flow


def _bits(level: int) -> Column:
    """Twelve bits of a row's place in the seeded order: first the content's hash, then the row number's."""
    split = CONTENT_BITS // BITS
    source, at, width = ("_content", level, CONTENT_BITS) if level < split else ("_own", level - split, ROW_BITS)
    return F.shiftright(F.col(source), width - BITS * (at + 1)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a row for each pattern, to be broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def _boundaries(narrow: DataFrame, rest: dict[int, int], near: int) -> tuple[dict[int, list], dict[int, int]]:
    """For each pattern number with a ``rest``: the bins (level by level) in which it runs out, and what of it is left there.

    A boundary is a list of (level's bin); its last entry is a pair of bins: all rows from
    the first to the second, at most ``near`` unless one bin of the finest level has more.
    """
    spark = narrow.sparkSession
    levels = (CONTENT_BITS + ROW_BITS) // BITS
    open_to: dict[int, list] = {p: [] for p, r in rest.items() if r > 0}
    left, out = {p: rest[p] for p in open_to}, {}
    for level in range(levels):
        if not open_to:
            break
        inside = _small(spark, [(p, path) for p, path in open_to.items()], "_pattern int, _path array<int>")
        here = narrow.join(inside, "_pattern")
        for k in range(level):
            here = here.where(_bits(k) == F.col("_path")[k])
        counted = here.groupBy("_pattern", _bits(level).alias("bin")).agg(F.sum("_size").alias("size"), F.count("*").alias("n"))
        bins: dict[int, list] = {p: [] for p in open_to}
        for r in counted.toLocalIterator():  # at most 2^BITS rows for each pattern
            bins[r["_pattern"]].append((r["bin"], r["size"], r["n"]))
        for p, each in bins.items():
            each.sort()
            for at, (b, size, n) in enumerate(each):
                if size > left[p] or at == len(each) - 1:
                    break
                left[p] -= size
            last, held = at, n
            while last + 1 < len(each) and held + each[last + 1][2] <= near:
                last += 1
                held += each[last][2]
            if held <= near or level == levels - 1:
                out[p] = [*open_to[p], (b, each[last][0])]
            else:
                open_to[p].append(b)
        open_to = {p: path for p, path in open_to.items() if p not in out}
    return out, left


def mix(docs: DataFrame, sources: Column, size: Column, order: list[Column], weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most_copies: int = 2, seed: int = 7, near: int = 4096, most_patterns: int = 100_000) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (both of the first of its sources), ``copies`` and ``taken``.

    ``sources`` is an array of a document's sources, ``size`` its words, ``order`` what the
    seeded order hashes. ``docs`` is written once to the checkpoint folder: leave texts out
    of it that the result doesn't need.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    pattern = F.array_sort(F.array_distinct(sources), lambda a, b: F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), 1).when(b.isNull(), -1).when(a < b, -1).when(a > b, 1).otherwise(0))
    content = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *order), 64 - CONTENT_BITS)
    own = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), 64 - ROW_BITS)
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    rows = checkpointed(docs.select(*kept, pattern.alias("_sources"), F.coalesce(size.cast("long"), F.lit(0)).alias("_size"), content.alias("_content")).withColumn("_own", own))
    patterns = rows.groupBy("_sources").agg(F.sum("_size").alias("size")).limit(most_patterns + 1).collect()
    if len(patterns) > most_patterns:
        raise ValueError(f"more than {most_patterns} patterns of sources")
    sizes = {tuple(r["_sources"]): int(r["size"]) for r in patterns}
    per_source: dict = {}
    for p, n in sizes.items():
        for s in p:
            per_source[s] = per_source.get(s, 0) + n
    wanted = targets(per_source, weights, share, most_copies)
    flow = cheapest_flow(sizes, {s: round(t) for s, t in wanted.items()}, most_copies)
    number = {p: i for i, p in enumerate(sorted(sizes, key=repr))}
    given = {p: sum(flow[p].values()) for p in sizes}
    whole = {p: given[p] // sizes[p] if sizes[p] else 0 for p in sizes}
    rest = {number[p]: given[p] - whole[p] * sizes[p] for p in sizes}
    table_of = [(list(p), number[p], whole[p], per_source[p[0]] if p else 0, float(wanted[p[0]]) if p else 0.0) for p in sizes]
    kind = dict(rows.dtypes)["_sources"]
    plan = _small(spark, table_of, f"_sources {kind}, _pattern int, _whole long, source_size long, target double")
    # Null elements are equal here, as in grouping.
    placed = rows.join(plan, "_sources")
    narrow = placed.select("_pattern", "_size", "_content", "_own")
    ends, left = _boundaries(narrow, rest, near)
    edges = _small(spark, [(p, path[:-1], *path[-1], left[p]) for p, path in ends.items()], "_pattern int, _path array<int>, _from int, _to int, _left long")
    marked = placed.join(edges, "_pattern", "left")
    before, inside = F.lit(False), F.col("_from").isNotNull()
    for level in range(max((len(path) for path in ends.values()), default=0)):
        depth = F.size("_path")
        here = _bits(level)
        step = F.when(depth > level, F.col("_path")[level]).otherwise(F.col("_from"))
        upper = F.when(depth > level, F.col("_path")[level]).otherwise(F.col("_to"))
        active = inside & (depth >= level)
        before = before | F.coalesce(active & (here < step), F.lit(False))
        inside = F.when(depth >= level, inside & (here >= step) & (here <= upper)).otherwise(inside)
    marked = marked.withColumns({"_before": before, "_near": F.coalesce(inside, F.lit(False))})

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        """Of the rows around a boundary: those that fit into what is left, by the seeded order."""
        frame = frame.sort_values(["_content", "_own"])
        room, picked = int(frame["_left"].iloc[0]), []
        for words, own_ in zip(frame["_size"].tolist(), frame["_own"].tolist(), strict=True):
            if 0 < words <= room:
                room -= words
                picked.append(own_)
        made = frame[frame["_own"].isin(picked)]
        return made[["_pattern", "_content", "_own"]]

    # At most ``near`` rows of each pattern (rows of one 108-bit hash aside).
    picked = marked.where("_near").select("_pattern", "_size", "_content", "_own", "_left").groupBy("_pattern").applyInPandas(walk, "_pattern int, _content long, _own long")
    chosen = picked.withColumn("_picked", F.lit(True))
    made = marked.join(F.broadcast(chosen) if len(ends) * near <= 1_000_000 else chosen, ["_pattern", "_content", "_own"], "left")
    copies = F.col("_whole") + F.when(F.col("_before") | F.coalesce(F.col("_near") & F.col("_picked"), F.lit(False)), 1).otherwise(0)
    out = made.withColumn("copies", F.when(F.col("_size") > 0, copies).otherwise(0).cast("long"))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), F.col("_size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("_size")).alias("taken"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id``, ``source`` of ``docs`` with what ``mix`` adds; each document's only source is ``source``."""
    read = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("words"))
    return mix(read, F.array("source"), F.col("words"), [F.col("doc_id"), F.col("words")], **settings).drop("words")


def op13_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
