"""Counts, rates and scores over tables and event logs.

Ordered folds (a score that moves with each outcome, a rate that adapts) are sums
of maps ``s -> max(f, a * s + b)``; such maps compose, so each slice of a long
history is folded by itself and only one row for each slice is folded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def type_histogram(files: DataFrame, kind: Column) -> DataFrame:
    return files.groupBy(kind.alias("type")).agg(F.count("*").alias("n"))


def distinct_and_rows(df: DataFrame, key: str) -> DataFrame:
    """Exact distinct keys against rows."""
    return df.agg(F.count_distinct(key).alias("n_distinct"), F.count("*").alias("n_rows"))


def total_bytes(df: DataFrame, size: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(F.coalesce(F.col(size), F.lit(0))), F.lit(0)).cast("long").alias("bytes"), F.count("*").alias("files"))


def id_span(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.min(key).alias("min_id"), F.max(key).alias("max_id"))


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """The distinct ids as a table in ascending order, for state files of any size."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)


def outcome_stats(outcomes: DataFrame, volume: str, kind: str, kinds: tuple[str, ...], failures: tuple[str, ...], abort_at: float = 0.3) -> DataFrame:
    """Outcomes of each kind in a volume, the share of failures and whether it calls for an abort."""
    counts = [F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in kinds]
    share = F.count_if(F.col(kind).isin(*failures)) / F.count("*")
    return outcomes.groupBy(volume).agg(*counts, F.round(share, 9).alias("failure_share"), (share >= abort_at).alias("abort"))


def rate_per_week(df: DataFrame, at: str) -> DataFrame:
    """Items for each seven days of the span between the first and the last; null without a span."""
    span = (F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))) / F.lit(1e6)
    return df.agg(F.count("*").alias("n"), span.alias("span_s")).select("n", F.round(F.when(F.col("span_s") > 0, F.col("n") / F.col("span_s") * 604800), 6).alias("per_week"))


def density(df: DataFrame, key: str, width: int = 10000) -> DataFrame:
    """How many of each window of ``width`` ids there are."""
    window = F.floor(F.col(key) / width).cast("long")
    return df.where(F.col(key).isNotNull()).groupBy(window.alias("window")).agg(F.count_distinct(key).alias("n")).withColumn("fill", F.round(F.col("n") / F.lit(width), 9))


def success_score(events: DataFrame, key: str, seq: str, ok: Column, alpha: float, start: float = 1.0, floor: float = 0.35, slice_width: int = 100_000) -> DataFrame:
    """Each key's score after all its outcomes in the order of the integer ``seq``.

    A success moves the score by alpha towards 1, a failure towards 0, never below
    ``floor``. A history is cut into slices of ``slice_width`` sequence numbers,
    which bounds what is gathered for one key at a time.
    """
    step = F.struct(F.col(seq).alias("seq"), F.coalesce(ok, F.lit(False)).alias("ok"))
    sliced = events.select(key, F.floor(F.col(seq) / slice_width).alias("slice"), step.alias("step")).groupBy(key, "slice").agg(F.array_sort(F.collect_list("step")).alias("steps"))
    keep = F.lit(1.0 - alpha)
    one = lambda m, b: F.struct((m["a"] * keep).alias("a"), (m["b"] * keep + b).alias("b"), F.greatest(F.lit(floor), m["f"] * keep + b).alias("f"))
    start_map = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"), F.lit(floor).alias("f"))
    maps = sliced.select(key, "slice", F.reduce("steps", start_map, lambda m, s: one(m, F.when(s["ok"], F.lit(alpha)).otherwise(F.lit(0.0)))).alias("m"))
    whole = maps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("slice", "m"))).alias("maps"))
    score = F.reduce("maps", F.lit(start), lambda s, x: F.greatest(x["m"]["f"], x["m"]["a"] * s + x["m"]["b"]))
    return whole.select(key, F.round(score, 9).alias("score"))


def adapted_rate(events: DataFrame, key: str, seq: str, ok: str, start: float = 4.0, step: float = 0.5, every: int = 25, cut: float = 0.7, least: float = 0.5, most: float = 64.0, cooldown: float = 2.0, at: str = "at") -> DataFrame:
    """Each key's request rate after its outcomes: additive increase, multiplicative decrease.

    Rises by ``step`` after ``every`` successes in a row of counting; a refusal
    multiplies it by ``cut`` unless one did within ``cooldown`` seconds, and starts
    the count anew. The state of a key is three numbers; its rows are sorted by Spark
    and streamed, never held whole.
    """

    rows = events.select(key, seq, F.coalesce(F.col(ok), F.lit(False)).alias(ok), F.col(at).cast("double").alias(at))
    kind = dict(events.dtypes)[key]
    ordered = rows.repartition(key).sortWithinPartitions(key, seq)

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, None
        for frame in frames:
            for name, part in frame.groupby(key, sort=False):
                if now is None or name != now:
                    if held is not None:
                        yield pd.DataFrame({key: [now], "rate": [round(held[0], 9)]})
                    now, held = name, [start, 0, float("-inf")]
                for good, when in zip(part[ok].tolist(), part[at].tolist(), strict=True):
                    if good:
                        held[1] += 1
                        if held[1] >= every:
                            held[0], held[1] = min(most, held[0] + step), 0
                    elif when - held[2] >= cooldown:
                        held[0], held[1], held[2] = max(least, held[0] * cut), 0, when
        if held is not None:
            yield pd.DataFrame({key: [now], "rate": [round(held[0], 9)]})

    return ordered.mapInPandas(stream, f"{key} {kind}, rate double")


def empty_streaks(pages: DataFrame, page: str, new_items: str, most_new: int = 0) -> DataFrame:
    """``pages`` with ``streak``: how many pages up to this one in a row had at most ``most_new`` new items."""
    from .ordered import streaks

    return streaks(pages, [page], F.col(new_items) <= most_new)
