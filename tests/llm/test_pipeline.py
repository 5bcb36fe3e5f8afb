"""The pipeline's stages against plain versions of what each must keep."""

import bisect
import math
import re
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeloom.llm import quality, toxicity
from lakeloom.llm.common import default_tokenizer

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_duplicates import plain_units  # noqa: E402
from test_jaccard import plain_kept  # noqa: E402
from test_tokens import check_pieces  # noqa: E402


def plain_quality(model, text):
    """An additive score from the lookup tables, one entry at a time."""
    x = quality.text_features(text or "")
    bins = [bisect.bisect_right(e.tolist(), v) for e, v in zip(model.edges, x, strict=True)]
    coarse = [b * model.coarse // max(len(e) + 1, model.coarse) for b, e in zip(bins, model.edges, strict=True)]
    z = model.intercept + sum(t[b] for t, b in zip(model.tables, bins, strict=True))
    z += sum(t[coarse[i]][coarse[j]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
    return 1 / (1 + math.exp(-z))


def plain_toxicity(model, text):
    """Weights of the distinct features that the text has, added up."""
    words, weights = model
    weight = dict(zip(words, weights[:-1], strict=True))
    features = {f for w in re.findall(r"\w+", (text or "").lower()) for f in [f"={w}", *(f"{n}{w[:n]}" for n in (4, 5, 6) if len(w) >= n)]}
    return 1 / (1 + math.exp(-(weights[-1] + sum(weight.get(f, 0.0) for f in features))))


def test_each_stage_does_its_own_job(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    steps = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        steps.append((docs, spark.read.parquet(str(tmp_path / str(k)))))
        docs = steps[-1][1]
    for before, after in steps[:-1]:
        assert after.columns == before.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = steps[0]
    model = quality.train(before, labels)
    assert ids(after) == sorted(r.doc_id for r in before.collect() if plain_quality(model, r.text) >= quality.THRESHOLD)
    before, after = steps[1]
    model = toxicity.train(before, labels)
    assert ids(after) == sorted(r.doc_id for r in before.collect() if plain_toxicity(model, r.text) < toxicity.THRESHOLD)
    before, after = steps[2]
    assert ids(after) == plain_kept([(r.doc_id, r.text) for r in before.collect()])
    before, after = steps[3]
    expected = {i: t for i, t, _ in plain_units([(r.doc_id, r.text) for r in before.collect()])}
    assert {r.doc_id: r.text for r in after.collect()} == expected
    before, after = steps[4]
    check_pieces([(r.doc_id, r.text) for r in before.collect()], after.collect(), Tokenizer.from_file(default_tokenizer()))


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_queries_score_as_the_tables_say(spark, sf_dir, name):
    module, plain, query = {"quality": (quality, plain_quality, quality.op1_additive_quality), "toxicity": (toxicity, plain_toxicity, toxicity.op5_nnpu_toxicity)}[name]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = module.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = query(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.score == pytest.approx(plain(model, texts[r.doc_id]), abs=1e-9)
        assert r.predicted == int(r.score >= module.THRESHOLD)


def test_odd_documents_go_through_all_stages(spark, docs_of, odd_rows, sf_dir):
    docs = docs_of(odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        assert name == "packing" or made.columns == docs.columns
        if name != "packing" and not made.isEmpty():  # a stage may reject all of these few rows; the next gets them nevertheless
            docs = made
    assert made.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs_of([]), sf_dir).count() == 0


def test_the_risk_falls_along_the_fits_own_gradient():
    """One step of the fit against differences of the risk, above and below the point where it would turn negative."""
    rng = np.random.default_rng(3)
    positive = [sorted({int(i) for i in rng.integers(0, 6, 3)}) for _ in range(40)]
    unlabelled = [sorted({int(i) for i in rng.integers(3, 12, 3)}) for _ in range(60)]
    soft = lambda z: np.logaddexp(0, z)
    for prior in (0.1, 0.6):
        start = np.zeros(13)
        start[-1] = np.log(prior / (1 - prior))

        def parts(w, prior=prior):
            zp, zu = (np.array([sum(w[i] for i in r) + w[-1] for r in rows]) for rows in (positive, unlabelled))
            return prior * soft(-zp).mean(), soft(zu).mean() - prior * soft(zp).mean()

        one, other = parts(start)
        followed = (lambda w: sum(parts(w))) if other >= 0 else (lambda w: -parts(w)[1])  # noqa: B023
        step = toxicity.fit_nnpu(positive, unlabelled, 12, prior, rounds=1, rate=0.1, decay=0.0) - start
        for k in range(13):
            up, down = start.copy(), start.copy()
            up[k] += 1e-5
            down[k] -= 1e-5
            slope = (followed(up) - followed(down)) / 2e-5
            assert step[k] == pytest.approx(-0.1 * np.sign(slope), abs=1e-4) if abs(slope) > 1e-4 else abs(step[k]) <= 0.1001
