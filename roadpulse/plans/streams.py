"""Streaming jobs over the ``events`` table, read as a stream and run to its end.

A user's events are hours apart; ten minutes of the table count as one second.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import trips
from ..session import checkpoint_dir, materialise
from ..sources import records
from ..streaming import carried, detectors, jobs, summaries
from ..streaming.state import SCORE_NAMES, alarms as stream_alarms_of
from .fixture import table
from .inputs import over_code

#: Input of a micro-batch.
BATCH_BYTES = 1 << 30

FIXES = [
    "cast(user_id AS string) AS jsy", "event_id", "'B' || cast(user_id % 40 AS string) AS dbuscard",
    "unix_timestamp(ts) div 600 AS longtime", "least(round(value, 1), cast(130 AS double)) AS speed",
    "cast((event_id * 37) % 360 AS double) AS orientation",
    "cast(1194000 + event_id % 1000 AS double) / 10000 AS llon",
    "cast(322000 + event_id % 700 AS double) / 10000 AS llat",
    "cast(event_id % 4 AS string) AS ehstatus",
]


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # a pattern, since only then may the table be one file as well as a folder of files
    raw = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(f"{sf_dir}/events.parque[t]")
    return raw.selectExpr(*FIXES)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detectors.with_event_time(raw_stream(spark, sf_dir))


def run_to_end(df: DataFrame, name: str) -> DataFrame:
    """Process everything there is, write it as a table and read it back."""
    return run_again(df, folder(df.sparkSession, name))


def run_again(df: DataFrame, base: str) -> DataFrame:
    """As ``run_to_end``, going on from what earlier runs in the same folder left."""
    with few_partitions(df.sparkSession):
        query = (df.writeStream.format("parquet").option("path", f"{base}/rows")
                 .option("checkpointLocation", f"{base}/state").outputMode("append")
                 .trigger(availableNow=True).start())
    finish(query)
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/rows")


@contextmanager
def few_partitions(spark: SparkSession):
    """No more state partitions than cores: each costs a store and a Python worker per stateful step."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", min(int(partitions), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/roadpulse/{name}-{uuid.uuid4().hex}"


def finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    detectors.use_state_store(spark)
    found = detectors.step_marks(event_stream(spark, sf_dir)).where("raw_mark IS NOT NULL")
    return run_to_end(found.select("jsy", "event_id", "longtime", "raw_mark", "mark"), "steps")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = folder(spark, "scores")
    run = carried.with_scores(f"{base}/carried", jobs.table_sink(f"{base}/rows"), over_code(trips.TAXI_OVER_CODES))
    finish(jobs.start(event_stream(spark, sf_dir), run, f"{base}/state", availableNow=True))
    return spark.read.parquet(f"{base}/rows").select(
        "jsy", "begin_time", "end_time", "over0", "over1", "over2", "over3", "accelerations", "brakings",
        "turns", F.round("score", 2).alias("score"), "running")


def alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    detectors.use_state_store(spark)
    marked = detectors.step_marks(event_stream(spark, sf_dir)).where("raw_mark <> 0").select(
        "jsy", F.col("raw_mark").alias("rapid_mark"), "ts", "dbuscard", "longtime", F.col("p1.longtime").alias("pretime"))
    return run_to_end(stream_alarms_of(marked).drop("ts", "dbuscard"), "alarms")


def simple_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    detectors.use_state_store(spark)
    found = detectors.simple_marks(event_stream(spark, sf_dir))
    return run_to_end(found.select("jsy", "event_id", "longtime", "time_interval", "rapid_mark"), "simple")


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments per window of 20 minutes every 5; an end mark after the run closes the last windows."""
    detectors.use_state_store(spark)
    base = folder(spark, "windows")
    fixes = raw_stream(spark, sf_dir)
    last = table(spark, sf_dir, "events").selectExpr(*FIXES).agg(F.max("longtime")).first()[0]
    mark = detectors.end_mark(fixes, last or 0, 3600)
    mark.limit(0).write.parquet(f"{base}/ends")
    ends = spark.readStream.schema(fixes.schema).parquet(f"{base}/ends")
    stats = detectors.window_statistics(detectors.with_event_time(fixes.unionByName(ends)), "20 minutes", "5 minutes", mode="moments")
    out = stats.withColumn("window_start", F.unix_seconds(F.col("window.start"))).drop("window")
    run_again(out, base)
    mark.write.mode("append").parquet(f"{base}/ends")
    return run_again(out, base)


#: Windows of 20 minutes every 5, as in ``windows``.
LEARNING = summaries.Windows(seconds=300, slides=4)


def learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged pairs and their limits, which a second job learns from the same stream and publishes window by window."""
    base = folder(spark, "learned")
    learn = carried.with_pairs(f"{base}/plausible", summaries.publish(base, LEARNING), min_rank=2)
    finish(jobs.start(event_stream(spark, sf_dir).where("speed <= 120"), learn, f"{base}/learn", availableNow=True))
    judge = summaries.detect(base, jobs.table_sink(f"{base}/marks"), LEARNING, keep_zero=True)
    finish(jobs.start(event_stream(spark, sf_dir), carried.with_pairs(f"{base}/judged", judge), f"{base}/detect", availableNow=True))
    return spark.read.parquet(f"{base}/marks").drop("batch")


def fixed_detail(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(alarm rows, cells) of the detail detector."""
    detectors.use_state_store(spark)
    base = folder(spark, "detail")
    with few_partitions(spark):
        finish(jobs.fixed_detail(event_stream(spark, sf_dir), base, f"{base}/state", availableNow=True))
    return tuple(spark.read.parquet(f"{base}/{part}").drop("batch") for part in ("alarms", "cells"))


def event_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    detectors.use_state_store(spark)
    base = folder(spark, "event-alarms")
    with few_partitions(spark):
        finish(jobs.event_alarms(event_stream(spark, sf_dir), f"{base}/rows", f"{base}/state", availableNow=True))
    return spark.read.parquet(f"{base}/rows").drop("batch")


#: Parts of the trips' time, and the parts by which a message may come late.
PARTS, LATEST = 3, 2
#: How long a message may wait; half a second keeps it off whole seconds.
MEETING = "899500 milliseconds"


def rendezvous_scores(found: DataFrame) -> DataFrame:
    """Trips scored by the rendezvous of their two messages, with the driver's running score.

    The messages go out part by part: over-speed ones with the trip's part and
    every seventh again with the next, mark ones up to two parts late. The job
    is stopped and started again between the parts.
    """
    spark = found.sparkSession
    detectors.use_state_store(spark)
    base = folder(spark, "rendezvous")
    late = F.when(F.col("begin_time") % 11 == 0, 2).when(F.col("begin_time") % 5 == 0, 1).otherwise(0)
    rows = found.withColumn("seconds", F.col("end_time") - F.col("begin_time"))
    rows = materialise(rows, "trips")
    low, high = rows.agg(F.min("end_time"), F.max("end_time")).first()
    if low is None:
        return spark.createDataFrame([], ", ".join(["jsy string, begin_time bigint, end_time bigint", *[f"{n} bigint" for n in (*jobs.OVER, *jobs.MARKS)],
                                                    "minutes double, score double, running double"]))
    rows = rows.withColumn("part", F.expr(f"(end_time - {low}) * {PARTS} div {high - low + 1}")).withColumn("late", late)

    def messages(kind: str) -> DataFrame:
        raw = spark.readStream.schema("value string").parquet(f"{base}/{kind}")
        return records.parse_status(raw).drop("tag").withColumn("ts", F.timestamp_seconds("end_time"))

    with few_partitions(spark):
        for part in range(PARTS + LATEST):
            again = (F.col("part") == part - 1) & (F.col("begin_time") % 7 == 0)
            records.status_message(rows.where((F.col("part") == part) | again)).write.mode("append").parquet(f"{base}/over")
            records.status_message(rows.where(F.col("part") + F.col("late") == part)).write.mode("append").parquet(f"{base}/marks")
            for kind, names in (("over", jobs.OVER), ("marks", jobs.MARKS)):
                jobs.store_counts(rows.where(F.col("part") == part), f"{base}/counts/{kind}", names, part)
            finish(jobs.rendezvous_scores(messages("over"), messages("marks"), f"{base}/counts", f"{base}/scored", f"{base}/state",
                                          MEETING, availableNow=True))
    scored = spark.read.parquet(f"{base}/scored")
    stream = spark.readStream.schema(scored.schema).parquet(f"{base}/scored").select(*SCORE_NAMES)
    run = carried.with_running(f"{base}/carried", jobs.table_sink(f"{base}/rows"))
    finish(jobs.start(stream, run, f"{base}/running", availableNow=True))
    return spark.read.parquet(f"{base}/rows").drop("batch")
