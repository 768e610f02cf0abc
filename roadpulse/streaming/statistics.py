"""Sliding-window statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.pairs import PairRule, pair_fixes


def window_starts(time: str, length: int, slide: int) -> Column:
    """Starts of all windows that hold the time, aligned to the epoch."""
    last = F.expr(f"`{time}` div {slide} * {slide}")
    return F.sequence(last - F.lit(length - slide), last, F.lit(slide))


def sliding_pairs(fixes: DataFrame, length: int, slide: int, speed: float = 120.0,
                  tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Consecutive plausible fixes of a driver, once per window that holds both.

    Pairs are formed first and copied to their windows afterwards, so the
    copies are aggregated where they arise and are not shuffled. The first fix
    of a window has no pair in it.
    """
    rule = PairRule(min_gap=0, max_gap=length, speed_before=speed, speed_after=None)
    paired = pair_fixes(fixes, rule, tie=tie)
    first = F.expr(f"((longtime - {length}) div {slide} + 1) * {slide}")
    last = F.expr(f"pretime div {slide} * {slide}")
    return paired.withColumn("window_start", F.explode(F.when(first <= last, F.sequence(first, last, F.lit(slide)))))
