"""Whole jobs: a stream, what is kept between its batches, and tables written once per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators import marks, trips
from ..operators.pairs import add_motion
from ..operators.presets import PRESETS, Preset
from ..sources import jdbc
from ..sources.detail import detail_cells
from ..sources.folders import read_folders, replace_folders, span, staged
from . import detectors

#: Seconds of trip ends in one folder of the stored counts.
COUNTS_FOLDER = 3600
OVER = ("over0", "over1", "over2", "over3")
MARKS = ("accelerations", "brakings", "turns")


def start(df: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    return (df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch to its own folder; a batch that is run again replaces its rows."""
    def write(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={epoch}")
    return write


# --- trips scored when both of their messages have come -----------------------

def _counts_schema(names: tuple[str, ...]) -> str:
    return ", ".join(["jsy string, begin_time bigint, end_time bigint", *[f"{n} bigint" for n in names], "hour bigint, epoch bigint"])


def store_counts(trip_counts: DataFrame, path: str, names: tuple[str, ...], epoch: int) -> None:
    """Add counts of finished trips to a table; trips without any have no row."""
    some = F.greatest(*names) > 0
    rows = trip_counts.where(some).select(
        "jsy", "begin_time", "end_time", *[F.col(n).cast("bigint").alias(n) for n in names],
        F.expr(f"end_time div {COUNTS_FOLDER}").alias("hour"), F.lit(epoch).cast("bigint").alias("epoch"))
    replace_folders(rows, path, ["hour", "epoch"])


def score_met(counts: str, write: Callable[[DataFrame, int], None], stage: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over trips whose messages have met: looks up their counts and scores them.

    The counts are read anew for every batch, and of them the folders in which
    the batch's trips end.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        rows = staged(batch.withColumn("hour", F.expr(f"end_time div {COUNTS_FOLDER}")), stage, epoch)
        hours = span(rows, "hour")
        if hours is None:
            return
        found = rows.drop("hour")
        for kind, names in (("over", OVER), ("marks", MARKS)):
            stored = read_folders(batch.sparkSession, f"{counts}/{kind}", "hour", range(hours[0], hours[1] + 1), _counts_schema(names))
            found = detectors.lookup_counts(found, stored, names)
        write(trips.score_trips(found.withColumn("seconds", F.col("end_time") - F.col("begin_time"))), epoch)
    return run


def rendezvous_scores(over_done: DataFrame, marks_done: DataFrame, counts: str, out: str, checkpoint: str,
                      delay: str = "1 hour", **trigger) -> StreamingQuery:
    """Scores a trip once both of its status messages are there, in whatever order, repeated or late by up to ``delay``.

    The streams hold jsy, begin_time, end_time and ts; what waits for its other
    message is dropped when ``delay`` has passed. Rows of ``out`` are the trip
    with its counts, score and minutes.
    """
    met = detectors.rendezvous(over_done, marks_done, delay).select("jsy", "ts", "begin_time", "end_time")
    return start(met, score_met(counts, table_sink(out), f"{checkpoint}-met"), f"{checkpoint}/met", **trigger)


# --- detectors with fixed limits that write what they find ---------------------

def fixed_detail(fixes: DataFrame, out: str, checkpoint: str, preset: Preset = PRESETS["bus_detail_stream"],
                 speed: float | None = 80.0, **trigger) -> StreamingQuery:
    """Marks of a preset: a row of cells per mark in ``out``/cells, and alarm rows in ``out``/alarms."""
    found = detectors.fixed_marks(fixes, preset, speed)
    cells, alarms = table_sink(f"{out}/cells"), table_sink(f"{out}/alarms")

    def run(batch: DataFrame, epoch: int) -> None:
        rows = staged(batch, f"{checkpoint}-marked", epoch)
        cells(detail_cells(rows), epoch)
        alarms(jdbc.alarm_rows(rows.withColumn("tips", alarm_tips(preset))), epoch)
    return start(found, run, f"{checkpoint}/detail", **trigger)


def alarm_tips(preset: Preset):
    return text.alarm_text(F.col("rapid_mark"), F.col("a_speed"), F.lit(preset.accel), F.lit(preset.brake),
                           *[F.col(c) for c in ("up_min", "up_max", "dn_min", "dn_max", "actual_dist")])


def event_alarms(fixes: DataFrame, out: str, checkpoint: str, preset: Preset = PRESETS["bus_event_stream"],
                 speed: float | None = None, **trigger) -> StreamingQuery:
    """Alarm rows of a preset's marks in ``out``, one for the second mark of a kind within the window."""
    fired = detectors.fixed_alarms(fixes, preset, speed)
    sink = table_sink(out)
    return start(fired, lambda batch, epoch: sink(jdbc.event_rows(batch), epoch), f"{checkpoint}/events", **trigger)
