"""Stateful streams: retries and their end, walks that stop and go on after restarts."""

import random
from datetime import datetime, timedelta

import pytest

from lakeloom.streaming import states

DAY = 86_400


def test_letters_are_retried_and_given_up(spark, tmp_path):
    session = states.stateful_session(spark)
    assert session.conf.get("spark.sql.streaming.stateStore.providerClass") != spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    schema = "id long, ok boolean, at timestamp"

    def run(*rows):
        session.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = session.readStream.schema(schema).parquet(str(tmp_path / "in"))
        states.dead_letters(stream, "id", "ok", "at", wait=DAY, expire=10 * DAY).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        made = spark.read.schema(f"id long, {states.LETTER}").parquet(str(tmp_path / "out"))
        return made, {r.id: (r.attempts, r.due) for r in states.still_failed(made, "id").collect()}

    millis = lambda n: int((datetime(2024, 1, 1) + timedelta(days=n) - datetime(1970, 1, 1)).total_seconds() * 1000)
    _, left = run((1, False, day(0)), (2, False, day(0)), (3, True, day(0)), (4, False, day(0)), (4, True, day(0.5)), (None, False, day(0)), (5, None, day(0)))
    assert left == {1: (1, None), 2: (1, None)}
    _, left = run((9, True, day(2)))
    assert left == {1: (1, millis(1)), 2: (1, millis(1))}
    _, left = run((1, True, day(2.1)), (2, False, day(2.1)))
    assert left == {2: (2, None)}
    made, left = run((9, True, day(30)))
    assert left == {2: (2, millis(4.1))} or left == {}
    made, left = run((9, True, day(40)))
    assert left == {}
    assert {(r.id, r.what) for r in made.collect()} == {(1, "failed"), (1, "retry"), (1, "recovered"), (2, "failed"), (2, "retry"), (2, "given up"), (4, "failed"), (4, "recovered")}


@pytest.mark.parametrize("seed", range(3))
def test_a_walk_ends_in_the_middle_of_its_data(spark, tmp_path, seed):
    """However the pages are parted into runs, a streak goes on over a restart, and the walk ends where it must."""
    rng = random.Random(seed)
    new = [rng.choice([0, 0, 1, 2, 5]) for _ in range(60)]
    run, stop = 0, None
    for page, n in enumerate(new):
        run = run + 1 if n <= 1 else 0
        if run == 4:
            stop = page
            break
    session, at = states.stateful_session(spark), 0
    while at < len(new):
        size = rng.randint(1, 15)
        session.createDataFrame([("w", p, new[p]) for p in range(at, min(at + size, len(new)))], "walk string, page long, n int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        at += size
        ended = states.walk_until_empty(session.readStream.schema("walk string, page long, n int").parquet(str(tmp_path / "in")), "walk", "page", "n", str(tmp_path), 4, 1)
        assert ended == (stop is not None and at > stop)
        if ended:
            break
    made = sorted((r.page, r.stop) for r in spark.read.schema("page long, stop boolean").parquet(str(tmp_path / "out")).collect())
    assert made == [(p, p == stop) for p in range(len(new) if stop is None else stop + 1)]


class Calls:
    """A state and its timers that count how often they are asked."""

    def __init__(self, held=None):
        self.held, self.timers, self.n = held, [], 0

    def __getattr__(self, name):
        def call(*given):
            self.n += 1
            if name == "get":
                return self.held
            if name == "exists":
                return self.held is not None
            if name in ("update", "clear"):
                self.held = given[0] if given else None
            if name == "registerTimer":
                self.timers.append(given[0])
            if name == "deleteTimer":
                self.timers.remove(given[0])
            return list(self.timers)

        return call


def test_a_key_asks_its_state_once():
    import pandas as pd

    def run(held, *rows):
        p = states.DeadLetters("id", 10, 1000)
        p.handle = p.failed = state = Calls(held)
        made = [tuple(r) for frame in p.handleInputRows((1,), iter([pd.DataFrame(rows, columns=["ok", "at"])]), None) for r in frame.itertuples(index=False)]
        return made, state.held, state.timers, state.n

    assert run(None, (True, 5)) == ([], None, [], 1)
    assert run(None, (False, 5)) == ([(1, "failed", 1, 5)], (1, 5), [15], 3)
    made, held, timers, _ = run((2, 1), (False, 9), (True, 7), (False, 8))
    assert made == [(1, "recovered", 2, 7), (1, "failed", 1, 8), (1, "failed", 2, 9)] and held == (2, 8) and timers == [29]
