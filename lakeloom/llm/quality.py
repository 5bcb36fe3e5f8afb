"""Text quality by a generalised additive model with pairwise interactions.

Each text becomes about twenty numbers (shares of character classes, word and
line statistics). Every number is cut into quantile bins, and gradient boosting
goes round the features in turn: each step fits one tree of at most three leaves
on one feature's bins and adds it to that feature's lookup table. Then the pairs
of features that a coarse grid of residuals calls most useful get tables of two
dimensions, boosted in the same cyclic way. A score is the logistic function of
an intercept plus one table entry for each feature and pair, added up for a whole
batch at once.

The fit uses at most ``fit_rows`` labelled training rows (drawn by a hash of
doc_id); scoring reads every whole text in one narrow pass.

Defined cases: texts of any length are read whole; a null text is empty; an empty text has zero for each number and
is scored like any other; rows with a null label are not labelled; repeated rows
are scored once for each row; a null doc_id is held out or not as the empty id
is; without labelled training rows every score is 0.5. Only doc_id and text of
documents and doc_id and quality of labels are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_bucket, table

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "log_words", "lower", "upper", "upper_of_letters", "digit", "space", "newline", "beyond_ascii",
    "stops", "exclaims", "symbols", "bars", "brackets", "other_marks", "distinct_words", "repeats_in_a_row", "word_length",
    "words_of_a_line", "distinct_lines", "words_of_a_stop", "word_end_marks", "longest_word", "commonest_byte",
)


def _members(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), dtype=np.uint8)


LOWER, UPPER, DIGIT = np.arange(97, 123), np.arange(65, 91), np.arange(48, 58)
STOPS, SYMBOLS, BRACKETS, OTHERS = _members(".,;:"), _members("#$%&*@^~"), _members("()[]{}<>"), _members("\"'-+/=?\\_`")


def text_features(text: str) -> tuple[float, ...]:
    """The numbers of ``FEATURES`` for one whole text."""
    if not text:
        return (0.0,) * len(FEATURES)
    data = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n = len(data)
    words, lines = text.split(), text.split("\n")
    k = max(1, len(words))
    distinct = set(words)
    lower, upper = count[LOWER].sum(), count[UPPER].sum()
    stops = count[STOPS].sum()
    return (
        np.log1p(n), np.log1p(len(words)), lower / n, upper / n, upper / max(1, lower + upper), count[DIGIT].sum() / n, count[32] / n, count[10] / n, count[128:].sum() / n,
        stops / n, count[33] / k, count[SYMBOLS].sum() / k, count[124] / k, count[BRACKETS].sum() / k, count[OTHERS].sum() / k, len(distinct) / k, sum(map(eq, words, words[1:])) / k, (n - count[32]) / k,
        np.log1p(k / len(lines)), len(set(lines)) / len(lines), np.log1p(k / (1 + stops)), (count[33] + count[SYMBOLS].sum() + count[124]) / k, np.log1p(max(map(len, distinct), default=0)), count.max() / n,
    )


@dataclass
class AdditiveModel:
    """Bin edges, one lookup table for each feature and for each chosen pair."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    coarse: int = 8

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def coarse_bins(self, bins: np.ndarray) -> np.ndarray:
        sizes = np.array([len(e) + 1 for e in self.edges])
        return bins * self.coarse // np.maximum(sizes, self.coarse)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for the rows of ``x``: additions of bins only."""
        if not self.edges:
            return np.full(len(x), 0.5)
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        c = self.coarse_bins(b)
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[c[:, i], c[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float, ridge: float) -> np.ndarray:
    """Leaf values over ordered bins with gradient sums ``g`` and curvature sums ``h``: the best cuts, greedily."""
    parts = [(0, len(g))]
    worth = lambda a, b: a * a / (b + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for at, (lo, hi) in enumerate(parts):
            left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
            gain = worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h) - worth(all_g, all_h)
            gain[(left_h < least) | (all_h - left_h < least)] = -1
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), at, lo + 1 + int(gain.argmax()))
        if best[1] is None:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def grid_tree(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> np.ndarray:
    """A tree of at most four leaves on a grid: the cut of the rows, and one of the columns on each side, that together gain most."""
    worth = lambda a, b: a * a / (b + ridge)
    above_g, above_h = np.cumsum(g, 0)[:-1], np.cumsum(h, 0)[:-1]

    def columns_cut(cg: np.ndarray, ch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row cut, the worth of one side and where its columns are cut (0: nowhere)."""
        cg, ch = np.cumsum(cg, 1), np.cumsum(ch, 1)
        left_g, left_h, all_g, all_h = cg[:, :-1], ch[:, :-1], cg[:, -1:], ch[:, -1:]
        cut = worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h)
        cut[(left_h < least) | (all_h - left_h < least)] = -np.inf
        value, whole = cut.max(1), worth(all_g, all_h)[:, 0]
        whole[all_h[:, 0] < least] = -np.inf
        return np.maximum(value, whole), np.where(value > whole, cut.argmax(1) + 1, 0)

    (top, top_cut), (bottom, bottom_cut) = columns_cut(above_g, above_h), columns_cut(g.sum(0) - above_g, h.sum(0) - above_h)
    out = np.full(g.shape, -g.sum() / (h.sum() + ridge))
    row = int((top + bottom).argmax())
    if np.isfinite(top[row] + bottom[row]):
        for rows, col in ((slice(0, row + 1), int(top_cut[row])), (slice(row + 1, None), int(bottom_cut[row]))):
            for cols in (slice(0, col), slice(col, None)):
                out[rows, cols] = -g[rows, cols].sum() / (h[rows, cols].sum() + ridge)
    return out


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, pairs: int = 6, rate: float = 0.1, most_bins: int = 64, least: float = 2.0, ridge: float = 1.0) -> AdditiveModel:
    """Cyclic boosting of main effects, then of the ``pairs`` best interactions."""
    if not len(y):
        return AdditiveModel()
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = AdditiveModel(intercept=float(np.log(share / (1 - share))))
    grid = np.linspace(0, 1, most_bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, j], grid)) for j in range(x.shape[1])]
    b = model.bins(x)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = rate * shallow_tree(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)), 3, least, ridge)
            t += step
            z += step[b[:, j]]
    c, k = model.coarse_bins(b), model.coarse
    cells = lambda i, j, w: np.bincount(c[:, i] * k + c[:, j], w, k * k).reshape(k, k)
    g, h = slopes()
    gains = {}
    for i in range(x.shape[1]):
        for j in range(i):
            gg, hh = cells(j, i, g), cells(j, i, h)
            gains[j, i] = -(gg * grid_tree(gg, hh, least, ridge)).sum()
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:pairs]
    model.pair_tables = [np.zeros((k, k)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = rate * grid_tree(cells(i, j, g), cells(i, j, h), least, ridge)
            t += step
            z += step[c[:, i], c[:, j]]
    return model


def _texts(column: pa.Array) -> np.ndarray:
    made = [text_features(t or "") for t in column.to_pylist()]
    return np.array(made, dtype=np.float64).reshape(len(made), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 20000) -> AdditiveModel:
    """The model fit on at most ``fit_rows`` labelled training rows."""
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.where(id_bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
    drawn = known.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", "quality").limit(fit_rows)

    def read(batches):
        for batch in batches:
            x = _texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("quality"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    # fit_rows ids at most, so the size of this broadcast is a parameter; an id may have any number of rows, so they are bounded again.
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id").mapInArrow(read, "doc_id long, quality int, x array<double>")
    rows = found.orderBy(F.xxhash64("doc_id", "quality", "x"), "doc_id", "quality", "x").limit(fit_rows).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["x"]))
    return fit_additive(np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES)), np.array([float(r["quality"] == 1) for r in rows]))


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """``docs`` with ``quality_score``, 0 to 1, without a shuffle; a column of that name is replaced."""

    def rate(batches):
        for batch in batches:
            made = pa.array(model.score(_texts(batch.column(batch.num_columns - 1))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*batch.schema.names[:-1], "quality_score"])

    docs = docs.drop("quality_score")
    schema = T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())])
    return docs.select("*", F.col("text").cast("string").alias("_scored_text")).mapInArrow(rate, schema)


def op1_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (id_bucket(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
