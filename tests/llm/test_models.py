"""Classifiers on held-out rows, and what they do with odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def auc(pos, neg):
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize(("query", "label", "modulus", "out", "least"), [(quality.op1_additive_quality, "quality", 4, 2, 0.9), (toxicity.op5_nnpu_toxicity, "toxic", 5, 0, 0.75)])
def test_held_out_ranking(spark, query, label, modulus, out, least):
    made = query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % modulus == out and 0 <= r.score <= 1 for r in made)
    assert auc([r.score for r in made if r[label] == 1], [r.score for r in made if r[label] == 0]) >= least


def test_all_rows_are_scored_once(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for query in (quality.op1_additive_quality, toxicity.op5_nnpu_toxicity):
        assert query(spark, sf_dir).count() == n


def test_odd_rows_and_clashing_names(docs_of, odd_rows, clashing, spark):
    docs = clashing(docs_of(odd_rows))
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (5, 0, 0), (7, 0, None), (None, 1, 1), (8, None, 1)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    for module, name in ((quality, "quality_score"), (toxicity, "toxic_score")):
        scored = module.score(docs, module.train(docs, labels))
        rows = scored.collect()
        assert len(rows) == len(odd_rows) and all(0 <= r[name] <= 1 for r in rows)
        assert scored.columns.count(name) == 1 and "fp" in scored.columns
        assert module.score(docs_of([]), module.train(docs_of([]), labels)).count() == 0
        none = module.score(docs, module.train(docs, labels.limit(0))).collect()
        assert len({r[name] for r in none}) == 1


def test_labels_of_held_out_rows_change_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.id_bucket(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = quality.train(docs, labels), quality.train(docs, flipped)
    assert one.intercept == other.intercept and all((a == b).all() for a, b in zip(one.tables, other.tables, strict=True))


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y, pairs=1)
    assert model.pairs == [(0, 1)]
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9


def test_nnpu_risk_separates_from_positives_and_unlabelled():
    rng = np.random.default_rng(4)
    toxic = lambda: {int(i) for i in rng.integers(0, 5, 2)} | {int(i) for i in rng.integers(10, 40, 4)}
    clean = lambda: {int(i) for i in rng.integers(10, 40, 6)}
    positive, unlabelled = [toxic() for _ in range(200)], [toxic() if rng.random() < 0.1 else clean() for _ in range(1500)]
    w = toxicity.fit_nnpu(positive, unlabelled, 40, 0.1)
    logit = lambda f: sum(w[i] for i in f) + w[-1]
    assert np.mean([logit(toxic()) > 0 for _ in range(300)]) > 0.8
    assert np.mean([logit(clean()) < 0 for _ in range(300)]) > 0.95
