"""Per-driver state: the previous fixes, alarms, rides and the running score.

The processors only remember and pair; motion, marks and scores are column
expressions applied to what they emit, the same as in batch. Rows of a key
arrive in any order inside a micro-batch and are put in time order first; a row
that is not later than the last one seen is late and is dropped.

State goes by event-time timers. An alarm's window is dropped as soon as the
watermark has passed it, which changes no result. Fixes and rides are dropped
after ``idle`` seconds without a fix, if that is given: a driver who comes back
later starts as a new one. Each key has one timer; where its state has lived on
in the meantime, the timer is set anew.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# the processors travel with the query, so workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

FIX = "longtime bigint, speed double, orientation double, llon double, llat double, ehstatus string"
FIX_NAMES = ("longtime", "speed", "orientation", "llon", "llat", "ehstatus")


def _row_type(schema: str) -> Row:
    return Row(*[part.split()[0] for part in schema.split(", ")])


class Expiring(StatefulProcessor):
    """Drops the state of a key once the watermark has reached ``until`` of it (None: never)."""

    def until(self, state: Any) -> int | None:
        raise NotImplementedError

    def watch(self, handle: StatefulProcessorHandle, kept: Any) -> None:
        self._handle, self._kept = handle, kept

    def keep(self, state: tuple, new: bool) -> None:
        self._kept.update(state)
        end = self.until(state)
        if new and end is not None:
            self._handle.registerTimer(end * 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self._kept.exists():
            end = self.until(tuple(self._kept.get()))
            if end * 1000 <= timerValues.getCurrentWatermarkInMs():
                self._kept.clear()
            else:
                self._handle.registerTimer(end * 1000)
        return iter(())


class PreviousFixes(Expiring):
    """Emits every fix with the two before it and its number (0 for none)."""

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def until(self, state: Any) -> int | None:
        return None if self.idle is None else state[1] + self.idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        columns = ", ".join(f"{c}_{k} {t}" for k in (1, 2) for c, t in
                            (part.split() for part in FIX.split(", ")))
        self._seen = handle.getValueState("seen", f"n bigint, {columns}")
        self.watch(handle, self._seen)
        self._out = _row_type(PREVIOUS_SCHEMA)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        state = self._seen.get() if self._seen.exists() else None
        width = len(FIX_NAMES)
        nothing = (None,) * width
        n = state[0] if state is not None else 0
        one, two = (tuple(state[1:1 + width]), tuple(state[1 + width:])) if n else (nothing, nothing)
        for row in sorted(rows, key=lambda x: (x["longtime"], x["event_id"])):
            if n and row["longtime"] <= one[0]:
                continue
            n += 1
            yield self._out(key[0], row["ts"], row["event_id"], row["dbuscard"], *[row[c] for c in FIX_NAMES],
                            n, *one, *two)
            one, two = tuple(row[c] for c in FIX_NAMES), one
        if n:
            self.keep((n, *one, *two), state is None)

    def close(self) -> None:
        pass


PREVIOUS_SCHEMA = (f"jsy string, ts timestamp, event_id bigint, dbuscard string, {FIX}, rank bigint, "
                   + ", ".join(f"p{k}_{part}" for k in (1, 2) for part in FIX.split(", ")))


class Alarms(Expiring):
    """Fires once per window, at the ``fire_at``-th mark; see ``EpisodeRule``."""

    def __init__(self, window: int, fire_at: int, slide: bool):
        self.window, self.fire_at, self.slide = window, fire_at, slide

    def until(self, state: Any) -> int | None:
        _, last, ends, _ = state
        return max(last + 1, ends)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getValueState("open", "opened bigint, last bigint, ends bigint, seen int")
        self.watch(handle, self._open)
        self._out = _row_type(ALARM_SCHEMA)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = tuple(self._open.get()) if self._open.exists() else None
        new = now is None
        for row in sorted(rows, key=lambda x: x["longtime"]):
            t = row["longtime"]
            if now is not None and t <= now[1]:
                continue
            if now is not None and t < now[2]:
                opened, _, ends, seen = now
                seen += 1
                if seen == self.fire_at:
                    yield self._out(key[0], key[1], row["ts"], row["dbuscard"], t, opened, ends)
                if self.slide and seen <= self.fire_at:
                    ends = t + self.window
                now = (opened, t, ends, min(seen, self.fire_at))
            else:
                start = t if self.slide else row["pretime"]
                now = (row["pretime"], t, start + self.window, 1)
        if now is not None:
            self.keep(now, new)

    def close(self) -> None:
        pass


ALARM_SCHEMA = "jsy string, rapid_mark int, ts timestamp, dbuscard string, fired_at bigint, opened bigint, ends bigint"


class Rides(Expiring):
    """Ends a trip at a status change and emits its begin, end and counts.

    ``ends`` are the changes that end a trip (all if None), ``over_codes`` the
    four over-speed codes counted.
    """

    def __init__(self, ends: tuple[tuple[str, str], ...] | None, over_codes: tuple[str, ...], idle: int | None = None):
        self.ends, self.over_codes, self.idle = ends, over_codes, idle

    def until(self, state: Any) -> int | None:
        return None if self.idle is None else state[2] + self.idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._ride = handle.getValueState(
            "ride", "status string, begin bigint, last bigint, o0 bigint, o1 bigint, o2 bigint, o3 bigint, "
                    "m1 bigint, m2 bigint, m3 bigint")
        self.watch(handle, self._ride)
        self._out = _row_type(RIDE_SCHEMA)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        status, begin, last, counts = None, None, None, [0] * 7
        known = self._ride.exists()
        if known:
            status, begin, last, *counts = self._ride.get()
        for row in sorted(rows, key=lambda x: (x["longtime"], x["event_id"])):
            t = row["longtime"]
            if last is not None and t <= last:
                continue
            if row["over_code"] in self.over_codes:
                counts[self.over_codes.index(row["over_code"])] += 1
            if row["mark"]:
                counts[3 + row["mark"]] += 1
            if status is None:
                status, begin = row["ehstatus"], t
            elif row["ehstatus"] != status:
                if self.ends is None or (status, row["ehstatus"]) in self.ends:
                    yield self._out(key[0], row["ts"], begin, t, *counts)
                    counts = [0] * 7
                status, begin = row["ehstatus"], t
            last = t
        if last is not None:
            self.keep((status, begin, last, *counts), not known)

    def close(self) -> None:
        pass


RIDE_SCHEMA = ("jsy string, ts timestamp, begin_time bigint, end_time bigint, over0 bigint, over1 bigint, "
               "over2 bigint, over3 bigint, accelerations bigint, brakings bigint, turns bigint")


def to_cents(score: float) -> float:
    """Two decimals, half up, by the rule of ``trips.running_score``."""
    return float(Decimal(repr(score + 1e-9)).quantize(Decimal("0.01"), ROUND_HALF_UP))


class RunningScore(StatefulProcessor):
    """Keeps the running score of a driver, rounded to cents after each trip."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._score = handle.getValueState("score", "running double")
        self._out = _row_type(SCORE_SCHEMA)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        running = self._score.get()[0] if self._score.exists() else None
        for row in sorted(rows, key=lambda x: x["end_time"]):
            mean = ((row["score"] if running is None else running) + row["score"]) / 2
            running = to_cents(mean)
            yield self._out(*[row[c] for c in SCORE_NAMES], running)
        if running is not None:
            self._score.update((running,))

    def close(self) -> None:
        pass


SCORE_NAMES = ("jsy", "ts", "begin_time", "end_time", "over0", "over1", "over2", "over3",
               "accelerations", "brakings", "turns", "score", "minutes")
SCORE_SCHEMA = RIDE_SCHEMA + ", score double, minutes double, running double"


def _run(df: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName="ts")


def previous_fixes(fixes: DataFrame, idle: int | None = None) -> DataFrame:
    """Stream of fixes with ``p1`` and ``p2``, the two fixes before. Needs a
    watermark on ``ts``. A driver without a fix for ``idle`` seconds is forgotten."""
    flat = _run(fixes.select("jsy", "ts", "event_id", "dbuscard", *FIX_NAMES), ["jsy"], PreviousFixes(idle), PREVIOUS_SCHEMA)
    present = {1: F.col("rank") >= 2, 2: F.col("rank") >= 3}
    return flat.select(
        "jsy", "ts", "event_id", "dbuscard", *FIX_NAMES, "rank",
        *[F.when(present[k], F.struct(*[F.col(f"p{k}_{c}").alias(c) for c in FIX_NAMES])).alias(f"p{k}")
          for k in (1, 2)])


def alarms(marks: DataFrame, window: int = 180, fire_at: int = 2, slide: bool = False) -> DataFrame:
    """Alarms of a stream of marked pairs (``jsy, rapid_mark, ts, dbuscard, longtime, pretime``), with the
    vehicle of the mark that fired."""
    rows = marks.select("jsy", F.col("rapid_mark").cast("int").alias("rapid_mark"), "ts", "dbuscard", "longtime", "pretime")
    return _run(rows, ["jsy", "rapid_mark"], Alarms(window, fire_at, slide), ALARM_SCHEMA)


def rides(steps: DataFrame, ends=None, over_codes: tuple[str, ...] = ("0", "2", "3", "4"),
          idle: int | None = None) -> DataFrame:
    """Trips of a stream of steps (``jsy, ts, event_id, longtime, ehstatus, mark, over_code``). The open ride
    of a driver without a fix for ``idle`` seconds is dropped."""
    rows = steps.select("jsy", "ts", "event_id", "longtime", "ehstatus",
                        F.col("mark").cast("int").alias("mark"), "over_code")
    return _run(rows, ["jsy"], Rides(ends, over_codes, idle), RIDE_SCHEMA).withColumn(
        "seconds", F.col("end_time") - F.col("begin_time"))


def running_scores(scored: DataFrame) -> DataFrame:
    return _run(scored.select(*SCORE_NAMES), ["jsy"], RunningScore(), SCORE_SCHEMA)
