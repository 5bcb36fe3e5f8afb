"""What a published table says of itself: sizes, previews, calendars, Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import tags

PREVIEW = 50


def sizes(tables: dict[str, DataFrame], **labels: str) -> DataFrame:
    """Rows and the public size label of each table; ``labels`` as ``text.size_bucket`` has them."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.withColumn("size_bucket", text.size_bucket(F.col("n"), **labels))


def preview(df: DataFrame, key: str, rows: int = PREVIEW) -> DataFrame:
    """The newest ``rows`` rows."""
    return df.orderBy(F.col(key).desc_nulls_last()).limit(rows)


def markdown_table(df: DataFrame, rows: int = PREVIEW) -> str:
    """A Markdown table of at most ``rows`` rows, in the order given."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    lines += [f"| {' | '.join(map(cell, row))} |" for row in df.limit(rows).collect()]
    return "\n".join(lines)


def tag_lines(counts: DataFrame, kind: str) -> DataFrame:
    """``kind``, ``line``, ``markdown``: for each type a heading and a table of its top tags, for reports of any number of types."""
    top = tags.top_n_per_type(counts, kind).select(kind, (F.col("rank") + 2).cast("int").alias("line"), F.concat(F.lit("| "), F.regexp_replace("tag", r"\|", r"\\|"), F.lit(" | "), "n", F.lit(" |")).alias("markdown"))
    heads = F.array(F.concat(F.lit("### "), F.col(kind)), F.lit("| tag | n |"), F.lit("|---|---|"))
    return counts.select(kind).distinct().select(kind, F.posexplode(heads).alias("line", "markdown")).unionByName(top)


def markdown_report(title: str, posts: DataFrame, key: str, counts: DataFrame, kind: str) -> str:
    """A report: the size of the table, its newest rows and the top tags of each type."""
    size = sizes({title: posts}).first()
    top = tags.top_n_per_type(counts, kind).orderBy(kind, "rank")
    types = [r[kind] for r in counts.select(kind).distinct().orderBy(kind).limit(100).collect()]
    parts = [f"# {title}", f"{size['n']} rows ({size['size_bucket']})", "## Newest", markdown_table(preview(posts, key)), "## Tags"]
    for t in types:
        parts += [f"### {t}", markdown_table(top.where(F.col(kind).eqNullSafe(F.lit(t))).select("tag", "n"))]
    return "\n\n".join(parts) + "\n"
