"""Every rule's matches pass the prefilter, and equal the SQL's."""

import random
import re
from re import _constants, _parser

import duckdb
from pyspark.sql import functions as F

from lakeloom.llm import licenses, oracles


def sample(tree, rng):
    """A text that the parsed pattern matches; optional parts come and go."""
    out = ""
    for op, arg in tree:
        if op is _constants.LITERAL:
            out += chr(arg)
        elif op is _constants.NOT_LITERAL:
            out += "x"
        elif op is _constants.IN:
            kind, value = rng.choice(arg)
            out += chr(value[0] if kind is _constants.RANGE else value)
        elif op is _constants.MAX_REPEAT:
            low, high, inner = arg
            out += "".join(sample(inner, rng) for _ in range(rng.randint(low, min(high, low + 1))))
        elif op is _constants.SUBPATTERN:
            out += sample(arg[-1], rng)
        elif op is _constants.BRANCH:
            out += sample(rng.choice(arg[1]), rng)
        else:
            raise ValueError(op)
    return out


def test_matches_of_every_rule_pass_the_prefilter(docs_of):
    rng = random.Random(2)
    texts = {}
    for label, pattern, *_ in licenses.rules():
        tree = _parser.parse(pattern)
        for _ in range(12):
            text = sample(tree, rng)
            assert re.fullmatch(pattern, text)
            texts[text] = label
    rows = list(enumerate(texts))
    found = licenses.scan_licenses(docs_of([(i, t.upper() if i % 2 else t) for i, t in rows])).selectExpr("doc_id", "size(hits) AS n").collect()
    assert [rows[r.doc_id][1] for r in found if r.n == 0] == []


def test_rows_without_another_anchor_equal_sql(docs_of, spark, tmp_path):
    texts = ["Apache 2.0", "mpl 2.0", "EPL 1.0, boost 1.0", "PHP 3.0", "Elastic 2.0 engine", "GNU General Public version 3", "The software is provided as is.", "python 3", "q public 1.0", "nothing here 2.0"]
    path = str(tmp_path / "documents.parquet")
    docs_of(list(enumerate(texts))).write.parquet(path)
    df = licenses.op6_license_rules(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    made = con.execute(oracles.license_sql())
    names = [d[0] for d in made.description]
    expected = sorted(tuple(r[names.index(c)] for c in df.columns) for r in made.fetchall())
    assert sorted(tuple(r) for r in df.collect()) == expected
    labels = {r.doc_id: r.labels for r in df.collect()}
    assert labels[0] == "apache-2.0" and labels[6] == "no-warranty" and labels[9] == ""


def equal_to_sql(spark, docs_of, rows, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs_of(rows).write.parquet(path)
    df = licenses.op6_license_rules(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    made = con.execute(oracles.license_sql())
    names = [d[0] for d in made.description]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted((tuple(r[names.index(c)] for c in df.columns) for r in made.fetchall()), key=repr)
    return {r.doc_id: r.labels for r in df.collect()}


def test_matches_of_every_rule_equal_sql_also_where_they_touch(docs_of, spark, tmp_path):
    rng = random.Random(3)
    found = [sample(_parser.parse(pattern), rng) for _, pattern, *_ in licenses.rules()]
    rows = list(enumerate(found)) + [(1000 + k, " ".join(rng.choice(found) for _ in range(12))) for k in range(40)]
    equal_to_sql(spark, docs_of, rows, tmp_path)


def test_versions_behind_a_v_and_odd_rows_equal_sql(docs_of, odd_rows, spark, tmp_path):
    rows = [(2000, "GNU General Public v3"), (2001, "gpl v 2"), (2002, "GPLv3"), (2003, "mpl v1.1 and EPL-2.0"), (2004, "The Software shall be used for Good, not Evil."), *odd_rows]
    labels = equal_to_sql(spark, docs_of, rows, tmp_path)
    assert (labels[2000], labels[2003], labels[2004]) == ("gpl-3", "epl-2.0,mpl-1.1", "json")


def test_a_long_text_of_nothing_but_detections(docs_of):
    """In proportion to the text: the pairwise comparison took minutes for a tenth of it."""
    r = licenses.scan_licenses(docs_of([(1, "cc by " * 300_000)])).selectExpr("base[0].n AS n", "base[0].last AS last", "size(hits) AS hits").first()
    assert tuple(r) == (300_000, 599_998, 300_000)


def test_empty_table_and_clashing_names(docs_of, clashing):
    assert licenses.scan_licenses(docs_of([])).count() == 0
    got = licenses.scan_licenses(clashing(docs_of([(1, "cc by"), (None, None)])).withColumns({n: F.lit("clash") for n in ("words", "low", "hits", "base", "reach", "most")})).collect()
    assert sorted((r.doc_id or 0, r.n_words, len(r.hits)) for r in got) == [(0, 0, 0), (1, 2, 1)]


def test_gates_follow_from_the_rules():
    assert licenses.fixed_words("(?:a b )?version [23] of lice ?nsed (?:x|y (?:z)?)") == ["version", "of", "lice", "nsed"]
    assert licenses.fixed_words("a|b c") == []
