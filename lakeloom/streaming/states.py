"""Streams that remember: failures that come back, and walks that end themselves.

Both keep a few numbers for each key in Spark's state store, with timers in event time,
so they go on after a restart from where they were.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LETTER = "what string, attempts int, at long"


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose state store has timers; the settings of ``spark`` stay as they are."""
    made = spark.newSession()
    made.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    made.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    made.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return made


class DeadLetters(StatefulProcessor):
    """A key's failures: how many in a row, since when, and whether it is time for the next attempt.

    A timer is set for the retry after each failure, the wait doubling with each; one that
    has failed for ``expire_ms`` is given up. A success forgets all.
    """

    def __init__(self, key: str, wait_ms: int, expire_ms: int):
        self.key, self.wait_ms, self.expire_ms = key, wait_ms, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.failed = handle.getValueState("failed", "attempts int, first long")

    def _row(self, key: tuple, what: str, attempts: int, at: int) -> pd.DataFrame:
        return pd.DataFrame({self.key: [key[0]], "what": [what], "attempts": [attempts], "at": [at]})

    def _forget(self) -> None:
        self.failed.clear()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # The state is asked for once and told once: each call goes to Spark and back.
        attempts, first = before = self.failed.get() or (0, None)
        out, due = [], None
        for at, ok in sorted(pair for r in rows for pair in zip(r["at"].tolist(), r["ok"].tolist(), strict=True)):
            if not ok:
                first = first if attempts else at
                due = min(at + self.wait_ms * 2**attempts, first + self.expire_ms)
                attempts += 1
                out.append(("failed", attempts, at))
            elif attempts:
                out.append(("recovered", attempts, at))
                attempts, first = 0, None
        if not out:
            return
        if before[0]:
            self._forget()
        if attempts:
            self.failed.update((attempts, first))
            self.handle.registerTimer(due)
        yield pd.DataFrame({self.key: [key[0]] * len(out), "what": [w for w, _, _ in out], "attempts": [n for _, n, _ in out], "at": [a for _, _, a in out]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.failed.get()
        if not held:
            return
        attempts, first = held
        at = expiredTimerInfo.getExpiryTimeInMs()
        if at >= first + self.expire_ms:
            self._forget()
            yield self._row(key, "given up", attempts, at)
        else:
            self.handle.registerTimer(first + self.expire_ms)
            yield self._row(key, "retry", attempts, at)

    def close(self) -> None:
        pass


def dead_letters(outcomes: DataFrame, key: str, ok: str, at: str, wait: float, expire: float, late: str = "1 hour") -> DataFrame:
    """What becomes of each key as ``outcomes`` (a stream of a ``stateful_session``) arrive: failed, retry, recovered, given up, with its ``attempts``.

    ``wait`` and ``expire`` are seconds. Retries are due as event time passes. Rows without
    a key, a time or an outcome take no part.
    """
    kind = dict(outcomes.dtypes)[key]
    known = outcomes.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(ok).isNotNull())
    timed = known.select(key, F.col(ok).alias("ok"), F.col(at).cast("timestamp").alias("_time"), F.unix_millis(F.col(at).cast("timestamp")).alias("at")).withWatermark("_time", late)
    return timed.groupBy(key).transformWithStateInPandas(DeadLetters(key, int(wait * 1000), int(expire * 1000)), f"{key} {kind}, {LETTER}", "append", "eventTime")


def still_failed(letters: DataFrame, key: str) -> DataFrame:
    """Of the rows of ``dead_letters``: the keys that wait for another attempt, with their ``attempts``, and when they are due if the time has come."""
    order = F.struct("at", F.when(F.col("what") == "retry", 1).otherwise(0))
    last = letters.groupBy(key).agg(F.max_by(F.struct("what", "attempts", "at"), order).alias("x"))
    return last.where(F.col("x.what").isin("failed", "retry")).select(key, "x.attempts", F.when(F.col("x.what") == "retry", F.col("x.at")).alias("due"))


class StopRule(StatefulProcessor):
    """Pages of a walk until ``streak`` of them in a row had at most ``most_new`` new items; later ones are passed over."""

    def __init__(self, key: str, page: str, new_items: str, streak: int, most_new: int):
        self.key, self.page, self.new_items, self.streak, self.most_new = key, page, new_items, streak, most_new

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.walk = handle.getValueState("walk", "streak int, stopped boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        streak, stopped = self.walk.get() if self.walk.exists() else (0, False)
        out = []
        for page, new in pd.concat(list(rows)).sort_values(self.page)[[self.page, self.new_items]].itertuples(index=False):
            if stopped:
                break
            streak = streak + 1 if new <= self.most_new else 0
            stopped = streak >= self.streak
            out.append((key[0], page, streak, stopped))
        self.walk.update((streak, stopped))
        yield pd.DataFrame(out, columns=[self.key, self.page, "streak", "stop"])

    def close(self) -> None:
        pass


def walk_until_empty(pages: DataFrame, key: str, page: str, new_items: str, place: str, streak: int = 10, most_new: int = 0) -> bool:
    """Writes the pages of each walk up to its last to ``place``/out and ends; whether a walk came to its end.

    ``pages`` is a stream of a ``stateful_session``, later pages in later batches. It ends
    by itself when a walk has stopped, or when no more pages are there; another call goes
    on with the streaks as they were. A batch that runs again replaces itself.
    """
    ended = threading.Event()
    kinds = dict(pages.dtypes)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/out/batch={number}")
        if not batch.sparkSession.read.schema("stop boolean").parquet(f"{place}/out/batch={number}").where("stop").isEmpty():
            ended.set()

    marked = pages.select(key, page, new_items).groupBy(key).transformWithStateInPandas(StopRule(key, page, new_items, streak, most_new), f"{key} {kinds[key]}, {page} {kinds[page]}, streak int, stop boolean", "append", "none")
    query = marked.writeStream.option("checkpointLocation", f"{place}/state").foreachBatch(keep).trigger(availableNow=True).start()
    while not ended.is_set() and not query.awaitTermination(0.2):
        pass
    if ended.is_set():
        query.stop()
    return ended.is_set()
