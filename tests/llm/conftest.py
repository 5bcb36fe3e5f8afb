import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, dealt over a few partitions."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    long_text = " ".join(f"word{i % 701} and more, of it." for i in range(8000))
    same = "One passage that stands here twice, word for word, and is long enough to count as a repeat of the other one. End"
    return [(1, None), (2, ""), (3, "   "), (4, same), (5, same), (5, same), (6, "é ü 漢字 \U0001f600 <|endoftext|> x"), (7, long_text), (8, "a"), (None, same), (None, None)]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = ("fp", "score", "bucket", "home", "removed_spans", "quality_score", "toxic_score", "_rank", "rank", "component_id", "n_units", "positive", "unit", "x")
    return lambda df: df.withColumns({n: F.lit("clash") for n in names})
