"""Cells kept as Parquet, partitioned by family.

A filter on the family prunes folders; rows lie in key order, so key ranges
skip row groups. Deletes and compactions write a new generation of the table
next to the old one: readers of the old one are not disturbed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cells import FULL, sorted_layout

CELL_SCHEMA = "rowkey string, qualifier string, version bigint, value string, family string"


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELL_SCHEMA).parquet(path).select(*FULL)


def read_range(spark: SparkSession, path: str, family: str, first: str, before: str) -> DataFrame:
    """Cells of a family with ``first <= rowkey < before``.

    Only that family's folder is listed, and in a loaded generation only the
    row groups whose least and greatest keys reach into the range are read.
    """
    return read_cells(spark, path).where(
        (F.col("family") == family) & (F.col("rowkey") >= first) & (F.col("rowkey") < before))


def append_cells(cells: DataFrame, path: str) -> None:
    """Put: add cells; readers resolve versions."""
    cells.select(*FULL).write.mode("append").partitionBy("family").parquet(path)


def bulk_load(cells: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a whole generation in key order."""
    (sorted_layout(cells.select(*FULL), partitions)
     .write.mode("errorifexists").partitionBy("family").parquet(path))
