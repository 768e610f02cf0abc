"""Weights from pairwise-judgement matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def matrix_weights(matrices: DataFrame) -> DataFrame:
    """``(matrix_id, i, weight)`` from long matrices ``(matrix_id, i, j, v)``.

    The matrix is first made consistent: entry (i, j) becomes half the mean
    difference of the row sums plus one half; weights follow from its row sums.
    """
    rows = matrices.groupBy("matrix_id", "i").agg(F.sum("v").alias("r"))
    whole = Window.partitionBy("matrix_id")
    n = F.count(F.lit(1)).over(whole).cast("double")
    sized = rows.withColumns({"n": n, "total": F.sum("r").over(whole)})
    one = F.lit(1.0)
    consistent = ((F.col("n") * F.col("r") - F.col("total")) / (F.lit(2.0) * (F.col("n") - one))
                  + F.col("n") / F.lit(2.0))
    return sized.where("n > 1").select(
        "matrix_id", "i",
        (F.lit(2.0) / (F.col("n") * (F.col("n") - one)) * consistent
         + one / F.col("n") - one / (F.col("n") - one)).alias("weight"))


def small_weights(matrix: list[list[float]]) -> list[float]:
    """The same for one configured matrix, as plain numbers."""
    n = len(matrix)
    sums = [sum(row) for row in matrix]
    consistent = [sum((a - b) / (2 * (n - 1)) + 0.5 for b in sums) for a in sums]
    return [2.0 / (n * (n - 1)) * r + 1.0 / n - 1.0 / (n - 1) for r in consistent]


# Judgement matrices.
OVER_VS_MARKS = [[0.5, 0.65], [0.35, 0.5]]
OVER_MARKS_MILEAGE = [[0.5, 0.65, 0.75], [0.35, 0.5, 0.7], [0.25, 0.3, 0.5]]
OVER_KINDS = [[0.5, 0.4, 0.35], [0.6, 0.5, 0.4], [0.65, 0.6, 0.5]]
MARK_KINDS = [[0.5, 0.6, 0.6], [0.4, 0.5, 0.6], [0.4, 0.4, 0.5]]
PLACES = [[0.5, 0.4, 0.3], [0.6, 0.5, 0.35], [0.7, 0.65, 0.5]]
LEVELS_ABC = [[0.5, 0.3, 0.2], [0.7, 0.5, 0.3], [0.8, 0.7, 0.5]]
LEVELS_BC = [[0.5, 0.3], [0.7, 0.5]]
LOADED_EMPTY = [[0.5, 0.3], [0.7, 0.5]]


def _products(top: list[float]) -> list[float]:
    over, marks = small_weights(OVER_KINDS), small_weights(MARK_KINDS)
    return [top[0] * w for w in over] + [top[1] * w for w in marks]


def bus_tree(event: bool = False) -> dict[str, list[float]]:
    """Weights of the bus score. ``total`` is in the order count, level, time,
    up, down, turn (the second judgement is used for the level)."""
    levels = small_weights(LEVELS_BC if event else LEVELS_ABC)
    return {"total": _products(small_weights(OVER_VS_MARKS)), "count": small_weights(PLACES),
            "level": small_weights(PLACES), "section": levels, "station": levels, "cross": levels}


def taxi_tree(event: bool = False) -> dict[str, list[float]]:
    """Weights of the taxi score; ``total`` ends with the mileage weight."""
    if event:
        return {"total": _products(small_weights(OVER_VS_MARKS)), "level": small_weights(LEVELS_BC)}
    top = small_weights(OVER_MARKS_MILEAGE)
    return {"total": [*_products(top), top[2]], "level": small_weights(LEVELS_ABC),
            "mileage": small_weights(LOADED_EMPTY)}
