"""The mark-detail row: one wide row of cells per mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..operators import cells

# The columns of a mark's row.
DETAIL_COLUMNS = ("dbuscard", "time", "lut", "lat", "ppspeed", "pspeed", "speed", "actualMileage", "theryAvgMileage",
                  "theroyUpMin", "theroyUpMax", "theroyDnMin", "theroyDnMax", "timeInterval", "angle", "status")


def detail_cells(marked: DataFrame) -> DataFrame:
    """Cells of marked pairs; the key is the driver and the reversed time, the version the time.

    Speeds are those of the fix before the last, the last and this one, in km/h;
    mileages in metres with two decimals; turns have the status 5.
    """
    metres = dict(zip(("actualMileage", "theryAvgMileage", "theroyUpMin", "theroyUpMax", "theroyDnMin", "theroyDnMax"),
                      ("actual_dist", "avg_dist", "up_min", "up_max", "dn_min", "dn_max")))
    plain = {"dbuscard": "dbuscard", "lut": "llon", "lat": "llat", "ppspeed": "pp_kmh", "pspeed": "v0_kmh", "speed": "v1_kmh",
             "timeInterval": "time_interval", "angle": "orient"}
    rows = marked.select(
        text.scatter_key(F.col("jsy"), F.col("longtime")).alias("rowkey"), "longtime",
        text.time_text(F.col("longtime")).alias("time"), text.sink_mark(F.col("rapid_mark"), turn_code=5).cast("string").alias("status"),
        *[F.col(c).cast("string").alias(name) for name, c in plain.items()],
        *[text.fixed(F.col(c), 2).alias(name) for name, c in metres.items()])
    return cells.put_columns(rows, {"cf": list(DETAIL_COLUMNS)}, F.col("longtime"), key="rowkey")
