"""Every query of the catalogue that has SQL gives DuckDB's rows; the others run."""

import math

import duckdb
import pytest

import __spark_entry__
from lakeloom.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name not in ORACLE_SQL:
        assert rows
        return
    made = duck.execute(ORACLE_SQL[name])
    names, kinds = [d[0] for d in made.description], {d[0]: str(d[1]) for d in made.description}
    assert columns == sorted(names)
    assert {c: KINDS[dict(df.dtypes)[c]] for c in columns} == kinds
    assert rows == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in made.fetchall())


def test_entry_runs(spark):
    assert {r.action for r in __spark_entry__.entry(spark).collect()} <= {"new", "updated", "unchanged", "no_gain"}


def test_every_sql_has_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
