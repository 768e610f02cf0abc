"""Relational side tables.

Connections are options of Spark's own JDBC source; credentials come from the
caller. The driver jar of the database has to be on the class path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from ..functions import text


def reader(spark: SparkSession, options: Mapping[str, str], table: str | None = None,
           predicate: str | None = None, split: tuple[str, int, int, int] | None = None) -> DataFrameReader:
    """A configured JDBC reader.

    ``predicate`` is evaluated by the database. ``split`` is (column, lowest,
    highest, partitions): large tables are read by that many tasks.
    """
    source = spark.read.format("jdbc").options(**options)
    if table is not None:
        source = source.option("dbtable", table if predicate is None
                               else f"(SELECT * FROM {table} WHERE {predicate}) picked")
    if split is not None:
        column, low, high, parts = split
        source = (source.option("partitionColumn", column).option("lowerBound", low)
                  .option("upperBound", high).option("numPartitions", parts))
    return source


def read(spark: SparkSession, options: Mapping[str, str], table: str, predicate: str | None = None,
         split: tuple[str, int, int, int] | None = None) -> DataFrame:
    return reader(spark, options, table, predicate, split).load()


def write(df: DataFrame, options: Mapping[str, str], table: str, replace: bool = False,
          batch: int = 10_000) -> None:
    """Append to a table, or replace its rows while keeping its definition."""
    writer = df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch)
    if replace:
        writer = writer.option("truncate", True)
    writer.mode("overwrite" if replace else "append").save()


def alarm_rows(marks: DataFrame, tips: str | None = "tips") -> DataFrame:
    """Rows of the alarm table for marked pairs; pairs without a text raise none.

    Each row has its own ``uid``; it is derived from the mark, so that a task
    run twice writes the same row.
    """
    rows = marks if tips is None else marks.where(F.col(tips).isNotNull())
    start, end = F.col("pretime"), F.col("longtime")
    return rows.select(
        "dbuscard", F.col("jsy").alias("dguid"), text.time_text(start).alias("starttime"),
        text.time_text(end).alias("endtime"), (end - start).alias("contime"),
        text.sink_mark(F.col("rapid_mark"), turn_code=5).cast("string").alias("alarmtype"),
        F.date_format(F.current_timestamp(), text.TIME_FORMAT).alias("updatetime"),
        F.lit(0).alias("alarmlevel"),
        F.sha2(F.concat_ws("_", "jsy", start.cast("string"), end.cast("string"), F.col("rapid_mark").cast("string")),
               256).alias("uid"),
        (F.col(tips) if tips else F.lit(None).cast("string")).alias("tips"),
        text.position(F.col("prelon"), F.col("prelat")).alias("startpos"),
        text.position(F.col("llon"), F.col("llat")).alias("endpos"))


def event_rows(alarms: DataFrame, window: int = 180) -> DataFrame:
    """Rows of the alarm table for fired alarms (``jsy, dbuscard, rapid_mark, opened, ends``)."""
    return alarms.select(
        "dbuscard", F.col("jsy").alias("dguid"), text.time_text(F.col("opened")).alias("starttime"),
        text.time_text(F.col("ends")).alias("endtime"), F.lit(window).alias("contime"),
        F.col("rapid_mark").cast("string").alias("alarmtype"),
        F.date_format(F.current_timestamp(), text.TIME_FORMAT).alias("updatetime"),
        F.lit(0).alias("alarmlevel"), F.lit(0).alias("deal"),
        F.sha2(F.concat_ws("_", "jsy", F.col("opened").cast("string"), F.col("rapid_mark").cast("string")), 256)
        .alias("uid"), F.lit(0).alias("speed"), F.lit(0).alias("wspeed"))
