"""Pairs, trips and running scores of a stream whose job writes batch by batch anyway.

Inside a micro-batch the fixes before each fix are found like those of a table
(``pairs.neighbours``), and so are the trips that end (``trips.number_trips``)
and a driver's scores (``trips.running_score``); only the last two fixes, the
sums of the open trip and the running score of each driver are carried over to
the next batch, as tables of their own. A repeated batch reads what the batch
before it left and writes its own folder again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import trips
from ..operators.pairs import neighbours
from ..sources.folders import staged
from .detectors import pair_rows
from .state import FIX_NAMES

COLUMNS = ("jsy", "ts", "event_id", "dbuscard", *FIX_NAMES)


def previous_fixes(batch: DataFrame, path: str, epoch: int) -> DataFrame:
    """Rows of ``state.previous_fixes`` for one micro-batch, in the row blocks of the batch. A fix that is not later than the driver's last one is late."""
    spark = batch.sparkSession
    rows = trips.first_per_second(batch.select(*COLUMNS), ["jsy"], ["event_id"]).withColumn("ahead", F.lit(0).cast("bigint"))
    rows = rows.select(*COLUMNS, "ahead", F.lit(True).alias("fresh"))
    if epoch > 0:
        kept = spark.read.schema(rows.schema).parquet(f"{path}/last/batch={epoch - 1}")
        known = kept.groupBy("jsy").agg(F.max("longtime").alias("_last"), F.max("ahead").alias("_ahead"))
        later = rows.join(known, "jsy", "left").where("_last IS NULL OR longtime > _last")
        rows = later.withColumn("ahead", F.coalesce("_ahead", "ahead")).select(*rows.columns).unionByName(kept)
    rows = staged(rows, f"{path}/fixes", epoch)
    near = neighbours(rows, ["jsy"], list(FIX_NAMES), back=2, ahead=2)
    # of fixes that are gone only the number goes on: ``ahead`` counts those before the two that are kept
    found = staged(near.select(*COLUMNS, "ahead", "fresh", "block", (F.col("rank") + F.col("ahead")).alias("rank"), "p1", "p2",
                               F.col("n2").isNull().alias("carry")), f"{path}/near", epoch)
    last = found.where("carry").withColumn("gone", F.col("rank") - 1)
    first = last.groupBy("jsy").agg(F.min("gone").alias("_gone"))
    (last.join(first, "jsy").withColumns({"ahead": F.col("_gone"), "fresh": F.lit(False)})
     .select(*COLUMNS, "ahead", "fresh").write.mode("overwrite").parquet(f"{path}/last/batch={epoch}"))
    return found.where("fresh").select(*COLUMNS, "block", "rank", "p1", "p2")


def with_pairs(path: str, run: Callable[[DataFrame, int], None], min_rank: int = 3) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over fixes that hands the pairs of ``detectors.pair_stream`` to ``run``."""
    def paired(batch: DataFrame, epoch: int) -> None:
        run(pair_rows(previous_fixes(batch, path, epoch), min_rank), epoch)
    return paired


def finished_trips(steps: DataFrame, path: str, epoch: int, ends: Sequence[tuple[str, str]] | None = None,
                   over: Column | None = None, over_codes: Sequence[str] = trips.TAXI_OVER_CODES) -> DataFrame:
    """Trips of ``trips.split_trips`` that end in this micro-batch of marked steps."""
    parts = trips.trip_parts(trips.number_trips(steps, ["jsy"], ends, over), ["jsy"], over_codes)
    if epoch > 0:
        # the trip that was open goes on as the batch's first
        kept = steps.sparkSession.read.schema(parts.schema).parquet(f"{path}/open/batch={epoch - 1}")
        parts = trips.join_parts(parts.unionByName(kept))
    found = staged(parts, f"{path}/trips", epoch)
    (found.where("_done = 0").withColumn("trip_no", F.lit(0).cast("bigint"))
     .write.mode("overwrite").parquet(f"{path}/open/batch={epoch}"))
    return trips.finished_trips(found).drop("trip_no")


def with_scores(path: str, write: Callable[[DataFrame, int], None], over: Column, variant: str = "taxi",
                ends: Sequence[tuple[str, str]] | None = None,
                over_codes: Sequence[str] = trips.TAXI_OVER_CODES) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over fixes that hands the rows of ``detectors.score_stream`` to ``write``."""
    def run(batch: DataFrame, epoch: int) -> None:
        steps = trips.mark_steps(previous_fixes(batch, path, epoch))
        ended = finished_trips(steps, path, epoch, ends, over, over_codes)
        write(running_scores(trips.score_trips(ended, variant), path, epoch), epoch)
    return run


def running_scores(scored: DataFrame, path: str, epoch: int) -> DataFrame:
    """Rows of ``state.running_scores`` for one micro-batch of scored trips. The score of a driver is kept for good."""
    spark = scored.sparkSession
    kept = None if epoch == 0 else spark.read.schema("jsy string, running double").parquet(f"{path}/running/batch={epoch - 1}")
    found = staged(trips.running_score(staged(scored, f"{path}/scored", epoch), start=kept), f"{path}/found", epoch)
    last = found.groupBy("jsy").agg(F.max_by("running", "end_time").alias("running"))
    if kept is not None:
        last = last.unionByName(kept.join(last, "jsy", "left_anti"))
    last.write.mode("overwrite").parquet(f"{path}/running/batch={epoch}")
    return found


def with_running(path: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over scored trips that hands them to ``write`` with the driver's running score."""
    def run(batch: DataFrame, epoch: int) -> None:
        write(running_scores(batch, path, epoch), epoch)
    return run
