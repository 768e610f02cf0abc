"""Vehicle telemetry derived from the ``events`` table.

The gaps between a user's events are hours, so the 5-60 s rules would keep
nothing. The rows are re-timed: about 10 s apart, with a break every 20 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.slices import with_rank

TELEMETRY_SELECT = [
    "event_id",
    "cast(user_id AS string) AS jsy",
    "'B' || cast(user_id % 40 AS string) AS dbuscard",
    "1546300800 + 10*rn + event_id % 7 + 400*(rn div 20) AS longtime",
    "least(round(value, 1), cast(130 AS double)) AS speed",
    "cast((event_id * 37) % 360 AS double) AS orientation",
    "cast(event_id % 8 AS double) AS carheadangle",
    "cast(1194000 + rn*5 + (event_id % 11)*2 AS double) / 10000 AS llon",
    "cast(322000 + rn*3 + (event_id % 13) AS double) / 10000 AS llat",
    "cast((rn div 12) % 4 AS string) AS ehstatus",
    "event_type AS wayname",
    "cast(event_id % 3 AS string) AS waytype",
    "CASE WHEN event_id % 5 = 0 THEN 'X' || cast(event_id % 9 AS string) END AS roadcross",
    "cast(event_id % 4 = 0 AS int) AS isturn",
    "CASE WHEN event_id % 6 <> 0 THEN 'S' || cast(event_id % 17 AS string) END AS roadsection",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    ranked = with_rank(events, ["user_id"], ["ts", "event_id"],
                       F.date_trunc("hour", "ts"), name="rn").withColumn("rn", F.col("rn") - 1)
    return ranked.selectExpr(*TELEMETRY_SELECT)
