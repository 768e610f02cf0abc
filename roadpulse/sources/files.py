"""CSV and text files of fixes, score inputs and results.

Schemas are declared, so nothing is inferred and numbers are cast once at the
edge. Months are a partition column: one job reads all of them, and a filter
on ``month`` prunes folders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text
from .records import parse_raw_text

# Column names of the exports, by name here. Fixed values.
BUS_MATCHED = {"jsy": "DBusCard", "lutc": "LUTC", "longtime": "lutclong", "llon": "llon", "llat": "llat",
               "speed": "lspeed", "orientation": "LDir"}
BUS_CROSSINGS = {"jsy": "jsy", "wayname": "wayname", "waytype": "waytype", "roadcross": "roadcross",
                 "isturn": "isturn", "roadsection": "roadsection", "llon": "llon", "llat": "llat",
                 "lutc": "LUTC", "longtime": "longtime", "speed": "lspeed", "orientation": "orientation"}
BUS_OLD = {**BUS_CROSSINGS, "flag": "flag", "direcflag": "direcflag"}
TAXI_MATCHED = {"jsy": "jsy", "dbuscard": "dbuscard", "wayname": "wayname", "waytype": "waytype",
                "ehstatus": "EHstatus", "llon": "llon", "llat": "llat", "lutc": "lutc",
                "longtime": "longtime", "speed": "speed", "carheadangle": "carHeadAngle"}
TYPES = {"longtime": "bigint", "llon": "double", "llat": "double", "speed": "double",
         "orientation": "double", "carheadangle": "double", "isturn": "int"}


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: Mapping[str, str],
             header: Sequence[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Header CSV files as fixes. ``columns`` maps our names to theirs.

    ``header`` lists all columns of the file in order, when it holds more than
    the mapped ones; a file whose header does not fit is rejected. Months
    found in the path as ``month=`` become a column.
    """
    names = list(header) if header else list(columns.values())
    schema = ", ".join(f"`{n}` string" for n in names)
    paths = [path] if isinstance(path, str) else list(path)
    raw = (spark.read.schema(schema).option("header", True).option("encoding", encoding)
           .option("enforceSchema", False).csv(paths))
    picked = [F.col(theirs).try_cast(TYPES.get(ours, "string")).alias(ours) for ours, theirs in columns.items()]
    return raw.select(*picked, *[c for c in ("month",) if c in raw.columns])


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Header-less text exports."""
    return parse_raw_text(spark.read.text(path))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with a full declared schema, such as score inputs or scores."""
    return spark.read.schema(schema).option("header", True).csv(path)


def by_month(df: DataFrame, time: str = "longtime") -> DataFrame:
    return df.withColumn("month", F.date_format(F.timestamp_seconds(time), "yyyyMM"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
              one_file: bool = False) -> None:
    """Write header CSV. ``one_file`` is for results known to be small, such as
    one row per limit or bin: it funnels everything through one task."""
    out = df.coalesce(1) if one_file else df
    writer = out.write.mode(mode).option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def with_time_text(df: DataFrame) -> DataFrame:
    return df.withColumn("lutc", text.time_text(F.col("longtime")))
