"""Accidents by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: stands in for an unknown driver.
NO_DRIVER = "000000"
BIN_WIDTH, TOP = 10, 100


def driver_number(raw: Column) -> Column:
    """Job number without leading zeros, text that is no number as it is; unknown drivers become 0."""
    known = F.coalesce(raw.cast("string"), F.lit(NO_DRIVER))
    return F.coalesce(known.try_cast("bigint").cast("string"), known)


def scores_with_accidents(scores: DataFrame, accidents: DataFrame) -> DataFrame:
    """Each accident with its driver's score. Scores are unique per driver."""
    keyed = accidents.withColumn("jsy", driver_number(F.col("driver"))).drop("driver")
    return scores.join(keyed, "jsy")


def _edges(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(0, TOP, BIN_WIDTH).withColumnRenamed("id", "low")


def histogram(df: DataFrame, score: str, name: str, weight: Column | None = None) -> DataFrame:
    """Rows (or their summed ``weight``) per score bin ``[low, low + 10)``; empty
    bins are kept, a score of exactly 100 or outside 0-100 falls in none."""
    counted = (df.where((F.col(score) >= 0) & (F.col(score) < TOP))
               .groupBy((F.floor(F.col(score) / BIN_WIDTH) * BIN_WIDTH).alias("low"))
               .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias(name)))
    return (_edges(df).join(counted, "low", "left")
            .select(F.concat_ws("-", F.col("low").cast("string"),
                                (F.col("low") + BIN_WIDTH).cast("string")).alias("bins"),
                    F.coalesce(name, F.lit(0)).alias(name)))


def accident_rate(scores: DataFrame, accidents: DataFrame, score: str) -> DataFrame:
    """Accidents per scored driver in each score bin, 0 where there is neither.

    Accidents are counted per driver before the join, so a driver with very
    many of them is one row there.
    """
    drivers = histogram(scores, score, "score_count")
    per_driver = (accidents.groupBy(driver_number(F.col("driver")).alias("jsy"))
                  .agg(F.count(F.lit(1)).alias("_n")))
    hits = histogram(scores.join(per_driver, "jsy"), score, "accident_count", F.col("_n"))
    return drivers.join(hits, "bins").withColumn(
        "accident_rate", F.coalesce(F.try_divide(F.col("accident_count"), F.col("score_count")), F.lit(0.0)))
