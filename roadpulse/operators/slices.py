"""Ordered per-driver work without one task per driver.

A window partitioned by driver alone puts a driver's whole history in one task,
and one driver may own a third of the table. Two layouts avoid that. Both keep
the results exact:

* ``time_slices``: a driver's rows are cut by time; the last rows of a slice
  are repeated in the next one as context. Enough whenever the rule looks back
  over a bounded *time* (the 5-60 s pairing rule). One shuffle, no join.
* ``row_blocks``: rows are numbered per driver (``with_rank``) and cut into
  blocks of equal length, with context rows on either side. Enough whenever the
  rule looks back or ahead over a bounded number of *rows*, however far apart.

``before_block`` carries a running total across blocks.

A key may also crowd into one hour. ``crowded`` counts the rows of each (key,
hour), combined map-side; where one holds more than ``CROWD``, rows are cut by
count along the order instead (``cut_by_count``), so that no slice is larger
than the others whatever the hours hold.

Context rows have ``is_home = false``: compute over the window, then keep the
home rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadpulse.session import materialise

HOUR = 3600
DAY = 86400
BLOCK_ROWS = 50_000
#: Rows of one (key, hour) that are still ordered in one group; a choice of plan, not of result.
CROWD = 1_000_000
_crowds: dict[int, bool] = {}


def crowded(df: DataFrame, keys: Sequence[str], slice_by: Column, most: int | None = None) -> bool:
    """Whether a (key, slice) has more than ``most`` rows: one pass over the key and time columns.

    The answer is kept for the same plan; it only decides how rows are dealt out, never which come out.
    """
    most = CROWD if most is None else most
    counts = df.groupBy(*keys, slice_by.alias("_slice")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    plan = counts.semanticHash()
    if plan not in _crowds:
        _crowds[plan] = not counts.isEmpty()
    return _crowds[plan]


def cut_by_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``, a number of slices of about equal counts along (keys, order), heavy hours and all.

    The ranges come from a sample, so the rows are stored with their slices: a
    lost executor must not lead to other cuts. Only rows that agree in all of
    ``keys`` and ``order`` cannot be parted.
    """
    ranges = df.repartitionByRange(*keys, *order)
    return materialise(ranges.withColumn(name, F.spark_partition_id().cast("bigint")), "ranges")


def time_slices(df: DataFrame, time: str, look_back: int, width: int = HOUR) -> DataFrame:
    """Add ``slice`` and ``is_home``; rows of the last ``look_back`` seconds of
    a slice appear in the following slice too. With hours and a minute of
    look-back, one row in sixty is repeated."""
    if look_back >= width:
        raise ValueError("a slice must be longer than the look-back")
    home = F.expr(f"`{time}` div {width}")
    near_end = F.expr(f"`{time}` % {width} >= {width - look_back}")
    return (df
            .withColumn("slice", F.explode(
                F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))))
            .withColumn("is_home", F.col("slice") == F.expr(f"`{time}` div {width}")))


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column,
              name: str = "rank") -> DataFrame:
    """Number the rows of each key 1, 2, ... in ``order``.

    ``slice_by`` must never decrease along ``order``. Rows are numbered inside
    (key, slice) and shifted by the count of the key's earlier slices; those
    counts are combined map-side, so only they meet in one group per key. Keys
    that crowd into a slice are cut by count.
    """
    if crowded(df, keys, slice_by):
        keyed = cut_by_count(df, keys, order, "_slice")
    else:
        keyed = df.withColumn("_slice", slice_by)
    counts = keyed.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy(*keys).orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        *keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (keyed.join(starts, [*keys, "_slice"])
            .withColumn(name, F.row_number().over(inside) + F.col("_start"))
            .drop("_slice", "_start"))


def row_blocks(df: DataFrame, rank: str = "rank", before: int = 0, after: int = 0,
               size: int = BLOCK_ROWS) -> DataFrame:
    """Add ``block`` and ``is_home``; each block also holds the ``before`` rows
    ahead of it and the ``after`` rows behind it."""
    if max(before, after) > size:
        raise ValueError("a block must be longer than its context")
    home = F.expr(f"(`{rank}` - 1) div {size}")
    offset = F.expr(f"(`{rank}` - 1) % {size}")
    places = F.array(home)
    if before:
        places = F.concat(places, F.when(offset >= F.lit(size - before), F.array(home + 1))
                          .otherwise(F.array().cast("array<bigint>")))
    if after:
        places = F.concat(places, F.when((offset < F.lit(after)) & (home > 0), F.array(home - 1))
                          .otherwise(F.array().cast("array<bigint>")))
    return (df.withColumn("block", F.explode(places))
            .withColumn("is_home", F.col("block") == F.expr(f"(`{rank}` - 1) div {size}")))


def before_block(df: DataFrame, keys: Sequence[str], value: Column, name: str,
                 block: str = "block") -> DataFrame:
    """Add the total of ``value`` over all of the key's earlier blocks."""
    totals = df.groupBy(*keys, block).agg(F.sum(value).alias("_total"))
    earlier = (Window.partitionBy(*keys).orderBy(block)
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = totals.select(
        *keys, block, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias(name))
    return df.join(carried, [*keys, block])


def attach_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add the single row of ``one_row`` as a struct column.

    A scalar subquery: it is run once, checked to be a single row, and reaches
    every task as a constant. There is no join and no trip through the driver
    program.
    """
    return df.withColumn(name, one_row.select(F.struct("*").alias(name)).scalar())
