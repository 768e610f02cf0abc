"""Tables in partition folders, read folder by folder and written once per batch."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_folders(spark: SparkSession, path: str, column: str, values: Iterable[int], schema: str) -> DataFrame:
    """The rows of the folders ``column=value`` that exist; no other folder is listed. ``schema`` names the column too."""
    wanted = sorted(set(values))
    empty = spark.createDataFrame([], schema)
    if not wanted:
        return empty
    try:
        return (spark.read.schema(schema).option("basePath", path)
                .parquet(f"{path}/{column}={{{','.join(map(str, wanted))}}}"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty


def replace_folders(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Write ``df`` over the folders it has rows for; the others stay, so a repeated batch changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def staged(batch: DataFrame, path: str, epoch: int) -> DataFrame:
    """The rows of a micro-batch, written once, so that later passes do not run the stateful plan again."""
    folder = f"{path}/batch={epoch}"
    batch.write.mode("overwrite").parquet(folder)
    return batch.sparkSession.read.schema(batch.schema).parquet(folder)


def span(df: DataFrame, column: str) -> tuple[int, int] | None:
    """Least and greatest value of a whole-number column, None without rows."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return None if low is None else (low, high)
