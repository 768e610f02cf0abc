"""Streaming jobs: marks, alarms, trips and scores from a telemetry stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import motion
from ..operators import marks, thresholds, trips
from ..operators.pairs import add_motion
from ..operators.presets import PRESETS, Preset
from .state import alarms, previous_fixes, rides, running_scores


def with_event_time(fixes: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Add ``ts`` and the watermark the stateful operators need."""
    return fixes.withColumn("ts", F.timestamp_seconds("longtime")).withWatermark("ts", delay)


def end_mark(fixes: DataFrame, last: int, beyond: int) -> DataFrame:
    """One fix of no driver, ``beyond`` seconds after the ``last`` one of a finite run, in the columns of ``fixes``.

    Sent after the run it moves the watermark past all windows that are still
    open: ``beyond`` must exceed a window and the watermark's delay. It stands
    still and has no fix before it, so that it counts in no window itself.
    """
    given = {"jsy": F.lit(""), "longtime": F.lit(last + beyond), "speed": F.lit(0.0)}
    return fixes.sparkSession.range(1).select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fixes.schema])


def step_marks(fixes: DataFrame, idle: int | None = None) -> DataFrame:
    """Simple-rule marks of a stream; the streaming form of ``trips.step_marks``."""
    rows = previous_fixes(fixes, idle)
    return trips.mark_steps(rows)


def pair_stream(fixes: DataFrame, min_rank: int = 3, idle: int | None = None) -> DataFrame:
    """Pairs of a stream, in the columns of ``pairs.pair_fixes``. A pair needs
    ``min_rank - 1`` earlier fixes: two for the detectors, one (2) for statistics."""
    return pair_rows(previous_fixes(fixes, idle), min_rank)


def pair_rows(rows: DataFrame, min_rank: int = 3) -> DataFrame:
    """Pairs of fixes that carry ``rank`` and the fixes before as ``p1``, ``p2``."""
    return rows.where(F.col("rank") >= min_rank).select(
        "jsy", "ts", "event_id", "dbuscard", F.col("p1.llon").alias("prelon"), F.col("p1.llat").alias("prelat"),
        F.col("p1.longtime").alias("pretime"), F.col("p1.speed").alias("v0_kmh"), F.col("speed").alias("v1_kmh"),
        F.col("p2.speed").alias("pp_kmh"), motion.metres_per_second(F.col("p1.speed")).alias("prespeed"),
        F.col("p1.orientation").alias("preorien"), "llon", "llat", "longtime",
        motion.metres_per_second(F.col("speed")).alias("lspeed"), "orientation",
        (F.col("longtime") - F.col("p1.longtime")).alias("time_interval"))


def plausible(pairs: DataFrame, speed: float | None, lo: int = 5, hi: int = 60) -> DataFrame:
    kept = pairs.where(F.col("time_interval").between(lo, hi))
    return kept if speed is None else kept.where(F.col("v1_kmh") < speed)


def fixed_marks(fixes: DataFrame, preset: Preset = PRESETS["bus_detail_stream"],
                speed: float | None = 80.0) -> DataFrame:
    """Marks of a preset with fixed limits."""
    m = add_motion(plausible(pair_stream(fixes), speed, preset.least_gap), limits=preset.limits, limits_read=preset.limits_read)
    return marks.with_marks(m, marks.band_mark(marks.batch_limits(preset), preset.straight, preset.turn_first))


def simple_marks(fixes: DataFrame) -> DataFrame:
    """Simple-rule marks from a driver's second fix on, whatever the step before."""
    return marks.with_marks(add_motion(pair_stream(fixes, min_rank=2)), marks.simple_mark())


def fixed_alarms(fixes: DataFrame, preset: Preset = PRESETS["bus_event_stream"], speed: float | None = None,
                 **rule) -> DataFrame:
    """Alarms of a preset with fixed limits."""
    return alarms(fixed_marks(fixes, preset, speed), **rule)


def trip_stream(fixes: DataFrame, over: Column, ends=None,
                over_codes: tuple[str, ...] = trips.TAXI_OVER_CODES, idle: int | None = None) -> DataFrame:
    """Finished trips of a stream."""
    return rides(step_marks(fixes, idle).withColumn("over_code", over), ends, over_codes, idle)


def score_stream(fixes: DataFrame, over: Column, variant: str = "taxi", ends=None,
                 over_codes: tuple[str, ...] = trips.TAXI_OVER_CODES, idle: int | None = None) -> DataFrame:
    """Scored trips of a stream with the driver's running score, which is kept for good."""
    return running_scores(trips.score_trips(trip_stream(fixes, over, ends, over_codes, idle), variant))


def rendezvous(over_done: DataFrame, marks_done: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Join the two status streams on (driver, begin, end), once per trip.

    Both need ``ts``; repeats inside ``delay`` are dropped on either side.
    """
    key = ["jsy", "begin_time", "end_time"]
    left = over_done.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)
    right = (marks_done.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)
             .withColumnRenamed("ts", "ts_marks"))
    near = (F.col("ts_marks").between(F.col("ts") - F.expr(f"INTERVAL {delay}"),
                                      F.col("ts") + F.expr(f"INTERVAL {delay}")))
    joined = left.alias("o").join(right.alias("m"), (
        (F.col("o.jsy") == F.col("m.jsy")) & (F.col("o.begin_time") == F.col("m.begin_time"))
        & (F.col("o.end_time") == F.col("m.end_time")) & near))
    extra = [F.col(f"m.{c}") for c in right.columns if c not in (*key, "ts_marks")]
    return joined.select("o.*", *extra)


def lookup_counts(statuses: DataFrame, counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Put stored trip counts next to a status stream; absent ones are 0."""
    key = ["jsy", "begin_time", "end_time"]
    return statuses.join(counts.select(*key, *names), key, "left").fillna(0, list(names))


# --- statistics that feed the detector --------------------------------------

def window_statistics(fixes: DataFrame, length: str = "120 minutes", slide: str = "30 minutes",
                      speed: float = 120.0, mode: str = "full") -> DataFrame:
    """Statistics per sliding event-time window, emitted once a window closes.

    A pair counts in the windows that hold both of its fixes.
    """
    pairs = thresholds.add_published_motion(
        pair_stream(fixes.where(F.col("speed") <= speed), min_rank=2))
    windowed = (pairs.withColumn("window", F.window("ts", length, slide))
                .where(F.col("pretime") >= F.unix_seconds(F.col("window.start"))))
    return thresholds.published_stats(windowed, by=["window"], mode=mode)


def use_state_store(spark: SparkSession) -> None:
    """The stateful operators need the RocksDB provider."""
    from .state import STATE_PROVIDER
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
