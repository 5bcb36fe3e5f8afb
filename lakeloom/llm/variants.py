"""Spelling variants: words at distance one, by a self-join of the vocabulary's trie.

A word's near words differ by exactly one inserted, deleted or replaced code point.
The vocabulary is a trie that is cut into parts by prefixes: a prefix that more than
``part_words`` words share is passed on to its children, so every part is bounded and
an unevenly used prefix is split deeper. Two near words leave each other at one node of
the trie, the last that both go through:

- Below a cut, both are in one part. There the trie is walked down from its root, and
  each node carries the set of nodes at a distance of at most one from it (its active
  nodes); a child's set follows from its parent's. A part's trie is its sorted words: a
  node is a range of them with a depth, so long words take no more room than their text.
- Above a cut, a node passes on to the parts below it only that its next code point was
  replaced, left out or put in; what follows must be equal. That is an equality join on
  the node and the rest of the word, whose groups hold a word for each letter at most.

A word's form is its near word of most occurrences, if those are ``ratio`` times its own;
forms are followed by doubling, and there are at most as many steps as occurrences can
grow by that ratio.

Defined cases: a null text has no runs; a null doc_id counts as empty text in what is
hashed; rows that share an id are documents each; texts and runs of any length are
taken whole; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words that a task holds before it hands on their counts, and their code points.
HELD_WORDS, HELD_CHARS = 200_000, 16_000_000
#: Prefixes that are broadcast at most.
SENT_PREFIXES = 200_000


def vocabulary(docs: DataFrame, least_length: int = 7, least_n: int = 2, delete_one_in: int = 31) -> DataFrame:
    """``word`` and ``n``: runs of letters, some of which lose a code point by their document's hash."""

    def task(batches):
        counts: Counter = Counter()
        chars = 0

        def out():
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return made

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # Lower-casing bytes touches A to Z only.
                runs = Counter(RUN.findall((text.as_py() or "").encode().lower().decode()))
                head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in runs.items():
                    if len(run) < least_length:
                        continue
                    h = zlib.crc32(run.encode(), head)
                    if h % delete_one_in == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_length:
                            continue
                    chars += 0 if run in counts else len(run)
                    counts[run] += n
                if len(counts) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield out()
                    chars = 0
        yield out()

    read = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = read.mapInArrow(task, "word string, n long")
    return every.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _children(words: list[str], lo: int, hi: int, depth: int) -> dict[str, tuple[int, int]]:
    """By letter, the children of a node (words ``lo`` to ``hi``, which agree in ``depth`` code points); a word that ends there is none."""
    out = {}
    at = lo + (len(words[lo]) == depth)
    while at < hi:
        letter = words[at][depth]
        end = bisect_left(words, words[at][:depth] + chr(ord(letter) + 1), at, hi) if letter < "\U0010ffff" else hi
        out[letter] = (at, end)
        at = end
    return out


def near_pairs(words: list[str], depth: int) -> Iterator[tuple[int, int]]:
    """Places (i, j) of all near words among sorted distinct ``words`` that agree in their first ``depth`` code points, both ways round."""
    known: dict[tuple[int, int], dict] = {}

    def children(lo: int, hi: int, d: int) -> dict[str, tuple[int, int]]:
        if hi - lo == 1:
            return {words[lo][d]: (lo, hi)} if len(words[lo]) > d else {}
        if (lo, d) not in known:
            known[lo, d] = _children(words, lo, hi, d)
        return known[lo, d]

    # A node, and its active nodes at distance one; it is itself the only one at distance none.
    stack: list[tuple[int, int, int, set]] = []
    if words:
        stack.append((0, len(words), depth, {(a, b, depth + 1) for a, b in children(0, len(words), depth).values()}))
    while stack:
        lo, hi, d, active = stack.pop()
        if hi - lo == 1:  # one word is left: what follows in an active node must be what follows here
            found = set()
            for a, b, e in active:
                wanted = words[a][:e] + words[lo][d:]
                at = bisect_left(words, wanted, a, b)
                if at < b and words[at] == wanted and at != lo:
                    found.add(at)
            yield from ((lo, j) for j in found)
            continue
        if len(words[lo]) == d:
            yield from ((lo, a) for a, _, e in active if len(words[a]) == e)
        siblings = children(lo, hi, d)
        replaced = {(a, b, d + 1) for a, b in siblings.values()}
        for letter, (a, b) in siblings.items():
            reached = replaced | {(lo, hi, d)}  # another letter, or this one is too many
            reached.discard((a, b, d + 1))
            reached.update((p, q, d + 2) for p, q in children(a, b, d + 1).values())  # one comes before the next
            for x, y, e in active:
                if (further := children(x, y, e).get(letter)) is not None:
                    reached.add((*further, e + 1))
            stack.append((a, b, d + 1, reached))


def _cut(words: DataFrame, part_words: int) -> DataFrame:
    """``words`` with ``depth``: the length of the prefix of the part that a word is in (its own length, if it ends above)."""
    done, open_to, depth = [], words, 0
    while True:
        prefix = F.substring("word", 1, depth)
        longer = F.length("word") > depth
        heavy = checkpointed(open_to.where(longer).groupBy(prefix.alias("_prefix")).count().where(F.col("count") > part_words).select("_prefix"))
        n = heavy.count()
        if not n:
            return functools.reduce(DataFrame.unionByName, [*done, open_to.withColumn("depth", F.lit(depth))])
        # Many words have one prefix, so they stay where they are while the heavy prefixes are few enough to send.
        flagged = checkpointed(open_to.join(F.broadcast(heavy) if n <= SENT_PREFIXES else heavy, longer & (prefix == F.col("_prefix")), "left"))
        done.append(flagged.where("_prefix IS NULL").select(*words.columns, F.lit(depth).alias("depth")))
        open_to, depth = flagged.where("_prefix IS NOT NULL").select(*words.columns), depth + 1


def near_words(words: DataFrame, part_words: int = 4000) -> DataFrame:
    """``word``, ``other`` and ``other_n`` of all near words of a table of distinct ``word`` and ``n``, both ways round."""
    placed = checkpointed(_cut(words, part_words))

    def solve(table_: pa.Table) -> pa.Table:
        depth = table_.column("depth")[0].as_py()
        rows = sorted(zip(table_.column("word").to_pylist(), table_.column("n").to_pylist(), strict=True))
        names = [w for w, _ in rows]
        found = list(near_pairs(names, depth))
        return pa.table({"word": pa.array([names[i] for i, _ in found], pa.string()), "other": pa.array([names[j] for _, j in found], pa.string()), "other_n": pa.array([rows[j][1] for _, j in found], pa.int64())})

    pair = "word string, other string, other_n long"
    inside = placed.withColumn("part", F.substring(F.col("word"), F.lit(1), F.col("depth"))).groupBy("depth", "part").applyInArrow(solve, pair)
    # Words that leave each other at a node above the cuts: without the letter there (a word that ends there has none), or as they are.
    part = lambda a, b: F.substring(F.col("word"), a, b)
    at = F.col("at")
    above = placed.select("word", "n", "depth", F.explode(F.sequence(F.lit(0), F.least("depth", F.length("word")))).alias("at")).where((at < F.col("depth")) | (at == F.length("word")))
    without = F.when(at < F.length("word"), F.struct(part(at + 2, F.length("word")).alias("rest"), part(at + 1, F.lit(1)).alias("letter")))
    as_it_is = F.struct(part(at + 1, F.length("word")).alias("rest"), F.lit("").alias("letter"))
    rows = above.select("word", "n", part(F.lit(1), at).alias("node"), F.explode(F.array(without, as_it_is)).alias("x")).where("x IS NOT NULL").select("node", "x.rest", "x.letter", "word", "n")
    other = rows.select("node", "rest", F.col("letter").alias("other_letter"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # One of two letters may be missing; it then counts at the first place where the words differ, not at a later one.
    leaves = (F.col("letter") != F.col("other_letter")) & (F.substring("rest", 1, 1) != F.concat("letter", "other_letter"))
    over = rows.join(other, ["node", "rest"]).where(leaves)
    return inside.unionByName(over.select("word", "other", "other_n"))


def variants(docs: DataFrame, ratio: int = 10, part_words: int = 4000, **settings) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of the vocabulary of ``docs``."""
    if ratio < 2:
        raise ValueError("forms must have more occurrences than their words")
    words = checkpointed(vocabulary(docs, **settings))
    best = near_words(words, part_words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("form"))).alias("best"))
    joined = words.join(best, "word", "left")
    enough = -F.col("best.n") >= ratio * F.col("n")
    made = checkpointed(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.n")).alias("form_n")))
    links = checkpointed(made.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(onward, "root", "left_semi").isEmpty():
            break
        links = checkpointed(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return made.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
