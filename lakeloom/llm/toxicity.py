"""Non-negative positive-unlabelled learning of toxic text.

Two bounded samples are drawn from the training rows: confirmed toxic documents
(P) and documents whose label is not looked at (U), each text once. A document is the
set of its words and of their first four, five and six letters. Features that ``least``
documents of P have, and that are ``surprise`` deviations more frequent there than
in U, become the vocabulary, however many there are, and a linear classifier is fit in
numpy on the risk

    prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)])

with the logistic loss l. Where the second part falls below zero its gradient is
followed upwards, as the non-negative estimator asks. The prior is the share of
toxic rows among all labelled training rows. Several classifiers, each on its own
draw of U, are averaged.

Bounds: ``positives`` and ``unlabelled`` rows for the fit, whatever the table's
size; all else covers all data, and scoring reads every whole text in one narrow pass.

Defined cases: texts of any length are read whole; a null text is empty; a text without
known features, the empty one included, gets the intercept's score; rows with a null
label are not labelled; repeated rows are scored once for each row; rows without a doc_id
aren't drawn (no label names them), are scored like any other and held out as the empty
id is; without toxic training rows every score is the prior
(0 if nothing is labelled). Only doc_id and text of documents and doc_id and
toxic of labels are read, whatever other columns there are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, id_bucket, table

WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings, each marked by its length."""
    return [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]


class FeatureIndex:
    """Distinct vocabulary features of a text, by number."""

    def __init__(self, vocabulary: list[str]):
        self.ids = {f: i for i, f in enumerate(vocabulary)}
        self.of_word: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> set[int]:
        found: set[int] = set()
        if len(self.of_word) > 500_000:  # bounds the memory of a long task
            self.of_word.clear()
        for word in set(WORD.findall(text.lower())):
            hit = self.of_word.get(word)
            if hit is None:
                hit = self.of_word[word] = tuple(self.ids[f] for f in word_features(word) if f in self.ids)
            if hit:
                found.update(hit)
        return found


def fit_nnpu(positive: list, unlabelled: list, size: int, prior: float, rounds: int = 400, rate: float = 0.1, decay: float = 1e-5, seed: int = 0) -> np.ndarray:
    """Weights with the intercept last, by full-batch Adam on the non-negative risk."""

    def flat(rows):
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        return np.repeat(np.arange(len(rows)), lengths), np.fromiter((i for r in rows for i in sorted(r)), dtype=np.int64, count=int(lengths.sum())), len(rows)

    p, u = flat(positive), flat(unlabelled)
    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    logit_of = lambda x: np.bincount(x[0], w[x[1]], minlength=x[2]) + w[-1]

    def spread(x, each):
        return np.append(np.bincount(x[1], each[x[0]], minlength=size), each.sum())

    for step in range(1, rounds + 1):
        zp, zu = logit_of(p), logit_of(u)
        p_as_pos = spread(p, (sigmoid(zp) - 1) / p[2])
        p_as_neg = spread(p, sigmoid(zp) / p[2])
        u_as_neg = spread(u, sigmoid(zu) / u[2])
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope = prior * p_as_pos + u_as_neg - prior * p_as_neg if negative >= 0 else prior * p_as_neg - u_as_neg
        slope[:-1] += decay * w[:-1]
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame, positives: int = 4000, unlabelled: int = 16000, members: int = 3, least: int = 4, surprise: float = 4.5) -> tuple[list[str], np.ndarray]:
    """Vocabulary and weights (intercept last) from the training rows of ``docs`` and ``labels``."""
    known = labels.where(F.col("toxic").isNotNull()).select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"] or 0.0
    prior = min(max(share, 1e-4), 0.9)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def draw(ids: DataFrame, seed: int, most: int, positive: int) -> DataFrame:
        """``most`` distinct ids at most, and of the rows that have them as many again at most, by their text's digest."""
        chosen = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(most)
        # The size of these broadcasts is a parameter.
        digests = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("digest")).dropDuplicates(["digest"])
        return digests.orderBy(F.xxhash64("doc_id", "digest", F.lit(seed)), "doc_id", "digest").limit(most).withColumn("positive", F.lit(positive))

    chosen_p = draw(known.where("toxic = 1").select("doc_id"), 7, positives, 1)
    chosen_u = draw(docs.select("doc_id").where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT), 11, unlabelled, 0)
    wanted = F.broadcast(chosen_p.unionByName(chosen_u))
    # Written once: what follows reads it several times.
    drawn = checkpointed(texts.withColumn("digest", F.xxhash64("text")).join(wanted, ["doc_id", "digest"]).dropDuplicates(["positive", "text"]).select("doc_id", "positive", "text"))

    def spell(batches):
        for batch in batches:
            kinds, texts = batch.column("positive").to_pylist(), batch.column("text").to_pylist()
            sets = [sorted({f for word in set(WORD.findall(t.lower())) for f in word_features(word)}) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(sets, pa.list_(pa.string()))], names=["positive", "features"])

    spelled = drawn.mapInArrow(spell, "positive int, features array<string>")
    counts = spelled.select("positive", F.explode("features").alias("f")).groupBy("f").agg(F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u"))
    totals = drawn.agg(F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u")).first()
    n_p, n_u = totals["p"] or 0, totals["u"] or 0
    if not n_p or not n_u:
        return [], np.array([np.log(prior / (1 - prior)) if share else -20.0])
    due = (F.col("u") + 0.5) * F.lit(n_p / n_u)  # what P would have of it, were P like U
    picked = counts.where((F.col("p") >= least) & ((F.col("p") - due) / F.sqrt(due + 1) >= surprise)).select("f")
    words = sorted(r["f"] for r in picked.collect())  # features of the bounded sample only

    def number(batches):
        index = FeatureIndex(words)
        for batch in batches:
            sets = [sorted(index(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("positive"), pa.array(sets, pa.list_(pa.int32()))], names=["doc_id", "positive", "ids"])

    rows = drawn.mapInArrow(number, "doc_id long, positive int, ids array<int>").collect()  # bounded likewise
    rows.sort(key=lambda r: (r["positive"], r["doc_id"] is not None, r["doc_id"] or 0, r["ids"]))
    pos, unl = [r["ids"] for r in rows if r["positive"]], [r["ids"] for r in rows if not r["positive"]]
    rng = np.random.default_rng(3)
    fits = [fit_nnpu(pos, [unl[i] for i in rng.choice(len(unl), max(1, len(unl) * 3 // 4), replace=False)], len(words), prior) for _ in range(members)]
    return words, np.mean(fits, axis=0)


def score(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """``docs`` with ``toxic_score``, 0 to 1, in one pass without a shuffle; a column of that name is replaced."""
    words, weights = model

    def rate(batches):
        index = FeatureIndex(words)
        for batch in batches:
            found = [sorted(index(t or "")) for t in batch.column(batch.num_columns - 1).to_pylist()]
            logits = np.array([weights[f].sum() for f in found]) + weights[-1]
            scores = pa.array(1 / (1 + np.exp(-np.clip(logits, -50, 50))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*batch.schema.names[:-1], "toxic_score"])

    docs = docs.drop("toxic_score")
    schema = T.StructType([*docs.schema.fields, T.StructField("toxic_score", T.DoubleType())])
    return docs.select("*", F.col("text").cast("string").alias("_scored_text")).mapInArrow(rate, schema)


def op5_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    held_out = id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
