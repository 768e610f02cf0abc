"""Published statistics: one JSON object, replaced as a whole.

Each publication is a new folder ``v=<version>`` holding one small file. A
reader takes the highest version that is complete, so it never sees half of a
snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import text
from ..operators.slices import attach_row


def stamp(stats: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """Put the publishing time, and the count of fixes behind it, in front."""
    out = stats
    if fixes is not None:
        out = attach_row(out, fixes.agg(F.count(F.lit(1)).alias("cnt")), "_n").withColumn("cnt", F.col("_n.cnt")).drop("_n")
    return out.select(F.date_format(F.current_timestamp(), text.TIME_FORMAT).alias("time"),
                      *[c for c in ("cnt",) if fixes is not None], *stats.columns)


def pack(stats: DataFrame) -> DataFrame:
    """The statistics as JSON, or no row where any of them is missing."""
    complete = stats.columns
    condition = F.lit(True)
    for c in complete:
        condition &= F.col(c).isNotNull()
    return stats.where(condition).select(F.to_json(F.struct("*")).alias("stat"))


def pack_named(stats: DataFrame, required: Sequence[str]) -> DataFrame:
    """As ``pack``, but only the ``required`` statistics must be there."""
    condition = F.lit(True)
    for c in required:
        condition &= F.col(c).isNotNull()
    return stats.where(condition).select(F.to_json(F.struct("*")).alias("stat"))


def unpack(packed: DataFrame, names: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType() if n == "time" else T.DoubleType()) for n in names])
    return packed.select(F.from_json("stat", schema).alias("s")).select("s.*")


def publish(packed: DataFrame, path: str, version: int) -> None:
    """Write one snapshot. The row count is at most one by construction."""
    packed.withColumn("n", F.lit(1)).write.mode("overwrite").json(f"{path}/v={version}")


def read_latest(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The newest published statistics as one row."""
    schema = T.StructType([T.StructField("stat", T.StringType()), T.StructField("v", T.LongType())])
    found = spark.read.schema(schema).json(path)
    newest = found.agg(F.max_by("stat", "v").alias("stat"))
    return unpack(newest, names)
