"""Substring deduplication by hashing lines and the clauses inside them.

A text is cut into lines, and lines into clauses after sentence ends and commas;
either kind of unit covers the text without gaps. A unit's digest is that of its
lower-cased form with blanks collapsed. Over all documents the occurrence of least
(doc_id, text's digest, number among equal rows, position) of each digest is the kept
one; every other is a repeat.

A repeated line is removed, however short. Clauses serve passages that were set into
the middle of a line, whose line is new as a whole: in the lines that stay, a run of
neighbouring repeated clauses is removed if one of them has ``unit_words`` words or the
run has ``run_words``; two or three words that agree by chance stay. Where a unit lay
in the original is kept as spans of code points.

Digests are two independent 64-bit hashes. The least occurrence is a grouped minimum,
combined before the shuffle; repeats are found by a join on the digest, in which the few
digests that can be hot are salted; the positions of a document's own repeats, each once,
are all that is ever gathered, and text moves once, by doc_id.

Defined cases: a null text is empty and stays null; a text without line feeds is one
line, one without any mark one clause; texts of any length are cut whole; blanks are
those of ``BLANKS``, no others; a line without a word is never removed; a null doc_id
ranks before all others; rows that share a doc_id, or have none, rank by the first 60
bits of their text's MD5, and of rows equal in both one is the first and the others
repeat it as a whole; other columns pass through, but
``removed_spans`` and ``n_units`` (the number of clauses) are replaced; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Collection

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import checkpointed, table

LINE = r"[^\n]*\n+|[^\n]+"
CLAUSE = r"[^.,!?\n]*(?:[.,!?]+\n*|\n+)|[^.,!?\n]+"
#: Kinds of units in the order of their numbers.
KINDS = (LINE, CLAUSE)
BLANKS = r"[ \t\r\n]+"
WORDS = re.compile(r"[^ \t\r\n]+")
HOT_SHARE, SALTS = 1000, 64


def _keyed(docs: DataFrame, rank: str = "_rank", row: str = "_row") -> DataFrame:
    """``docs`` with what orders rows: the rank and a digest of the text."""
    digest = F.substring(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")), 1, 15)
    return docs.withColumns({rank: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), row: F.conv(digest, 16, 10).cast("long")})


def _first_of_twins(docs: DataFrame, rank: str, row: str, twin: str) -> DataFrame:
    """``docs`` with ``twin``: whether an equal row (same rank and digest) comes before.

    Only rows that have an equal one are moved. Those of a group are dealt over SALTS
    windows, and the first of each window are compared once more, so that no task
    holds a large group.
    """
    groups = checkpointed(docs.groupBy(rank, row).agg(F.count("*").alias("_n")).where("_n > 1").select(rank, row))
    if groups.isEmpty():
        return docs.withColumn(twin, F.lit(False))
    alone = docs.join(groups, [rank, row], "left_anti").withColumn(twin, F.lit(False))
    salt, first, place = (twin + c for c in ("salt", "first", "place"))
    equal = docs.join(groups, [rank, row], "left_semi").withColumn(salt, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)))
    by = lambda *last: Window.partitionBy(rank, row, *last).orderBy(salt)
    marked = equal.withColumn(first, F.row_number().over(by(salt)) == 1)
    leaders = F.when(F.col(first), F.lit(-1)).otherwise(F.col(salt))
    placed = marked.withColumn(place, F.row_number().over(by(leaders)))
    return alone.unionByName(placed.withColumn(twin, ~(F.col(first) & (F.col(place) == 1))).drop(salt, first, place))


def repeats(docs: DataFrame) -> DataFrame:
    """``_rank``, ``_row`` and sorted ``_repeats``: of units that stand earlier elsewhere, twice their position plus the kind's number."""
    read = _keyed(docs.select("doc_id", "text")).select("_rank", "_row", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    of = lambda kind: F.regexp_extract_all("text", F.lit(KINDS[kind]), F.lit(0))
    # The lines are counted below the generator: what stands beside it is worked out for each unit.
    placed = read.withColumn("lines", F.size(of(0))).select("_rank", "_row", "lines", F.posexplode(F.concat(of(0), of(1))).alias("pos", "unit"))
    cut = placed.select("_rank", "_row", F.when(F.col("pos") < F.col("lines"), F.col("pos") * 2).otherwise((F.col("pos") - F.col("lines")) * 2 + 1).alias("_at"), "unit")
    normal = F.lower(F.trim(F.regexp_replace("unit", BLANKS, " ")))
    kind = F.col("_at") % 2
    # A hash of several columns is seeded by those before: with the constants first, the two are hashes of the text by different seeds.
    units = cut.select("_rank", "_row", "_at", kind.alias("kind"), normal.alias("normal")).select("_rank", "_row", "_at", F.xxhash64("kind", "normal").alias("h1"), F.xxhash64(F.lit("second"), "kind", "normal").alias("h2"))
    firsts = checkpointed(units.groupBy("h1", "h2").agg(F.min(F.struct("_rank", "_row", "_at")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    # A digest with more than 1/HOT_SHARE of all repeated units is hot: there are at most HOT_SHARE
    # of them, so their broadcast is bounded. Their rows are dealt over SALTS tasks each.
    total = firsts.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE > F.lit(total)
    hot = firsts.where(is_hot).select("h1", "h2", F.lit(True).alias("hot"))
    salted = units.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("_rank", "_row", "_at"), F.lit(SALTS))).otherwise(0).cast("int")).drop("hot")
    dealt = firsts.select("h1", "h2", "first", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    again = salted.join(dealt, ["h1", "h2", "salt"]).where(F.struct("_rank", "_row", "_at") > F.col("first"))
    return again.groupBy("_rank", "_row").agg(F.array_sort(F.collect_set("_at")).alias("_repeats"))


def removed_spans(text: str, again: Collection[int], unit_words: int, run_words: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Removed and kept spans (start, length) of one text, and how many clauses it has. A range says that all its units are repeats."""
    if not again:
        return [], [(0, len(text))], sum(1 for _ in re.finditer(CLAUSE, text))
    lines, clauses = (again, again) if isinstance(again, range) else ({code // 2 for code in again if code % 2 == kind} for kind in (0, 1))
    line_gone = [i in lines and WORDS.search(m.group()) is not None for i, m in enumerate(re.finditer(LINE, text))]
    spans = [m.span() for m in re.finditer(CLAUSE, text)]
    gone, repeated, line = [], [], 0
    for i, (_, end) in enumerate(spans):
        gone.append(line_gone[line])
        repeated.append(i in clauses and not line_gone[line])
        line += text[end - 1] == "\n"
    at = 0
    while at < len(spans):
        end = at + 1
        if repeated[at]:
            while end < len(spans) and repeated[end]:
                end += 1
            words = [len(WORDS.findall(text[slice(*spans[i])])) for i in range(at, end)]
            if max(words) >= unit_words or sum(words) >= run_words:
                gone[at:end] = [True] * (end - at)
        at = end
    parts: tuple[list, list] = ([], [])
    at = 0
    while at < len(spans):
        end = at + 1
        while end < len(spans) and gone[end] == gone[at]:
            end += 1
        parts[not gone[at]].append((spans[at][0], spans[end - 1][1] - spans[at][0]))
        at = end
    return *parts, len(spans)


def dedup_units(docs: DataFrame, unit_words: int = 12, run_words: int = 20) -> DataFrame:
    """``docs`` with repeats taken out of ``text``, with ``removed_spans`` (array of start, length in the original) and ``n_units``."""
    docs = docs.drop("removed_spans", "n_units")
    mark = "_"
    while any(c.startswith(mark) for c in docs.columns):  # names that no column has
        mark += "_"
    rank, row, again_at, twin = (mark + c for c in ("rank", "row", "repeats", "twin"))
    found = repeats(docs).toDF(rank, row, again_at)
    joined = _first_of_twins(_keyed(docs, rank, row), rank, row, twin).join(found, [rank, row], "left").drop(rank, row)
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))
    schema = T.StructType([*(T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in docs.schema), T.StructField("removed_spans", span), T.StructField("n_units", T.LongType())])
    names = docs.columns
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def task(batches):
        for batch in batches:
            texts, out, counts = [], [], []
            for text, again, whole in zip(batch.column("text").to_pylist(), batch.column(again_at).to_pylist(), batch.column(twin).to_pylist(), strict=True):
                again = range(len(text or "")) if whole else again or []  # a twin's units all stand in the first of its rows
                gone, kept, n = removed_spans(text or "", again, unit_words, run_words)
                texts.append(text if not gone else "".join(text[a : a + k] for a, k in kept))
                out.append([{"start": a, "length": k} for a, k in gone])
                counts.append(n)
            columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, spans_type), pa.array(counts, pa.int64())], names=[*names, "removed_spans", "n_units"])

    return joined.withColumn("text", F.col("text").cast("string")).mapInArrow(task, schema)


def op10_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = dedup_units(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n_units",
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.expr("aggregate(removed_spans, 0L, (a, s) -> a + s.length)").alias("n_removed_chars"),
        F.expr("array_join(transform(removed_spans, s -> concat(s.start, '+', s.length)), ' ')").alias("removed_spans"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
