"""Score formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Lower and upper score of each quantile interval, best first.
BANDS = ((80, 95), (75, 80), (70, 75), (60, 70), (50, 60), (35, 50))
BANDS_OLD = ((85, 95), (75, 85), (70, 75), (60, 70), (50, 60), (35, 50))

DETAIL_PROBS = (0.0, 0.05, 0.2, 0.45, 0.75, 0.9, 1.0)
BUS_EVENT_PROBS = (0.0, 0.05, 0.3, 0.5, 0.8, 0.95, 1.0)


def rate(count: Column, km: Column) -> Column:
    """Occurrences per kilometre."""
    return F.try_divide(count, km)


def smoothed_rate(count: Column, km: Column) -> Column:
    """Occurrences per kilometre with one added, so that nobody scores zero."""
    return F.try_divide(count + F.lit(1.0), km)


def weighted(values: list[Column], weights: list[Column | float]) -> Column:
    total = None
    for value, weight in zip(values, weights, strict=True):
        w = weight if isinstance(weight, Column) else F.lit(float(weight))
        total = w * value if total is None else total + w * value
    return total


def band_score(x: Column, q: Column, bands: tuple = BANDS, mode: str = "reference") -> Column:
    """Score of ``x`` from seven quantiles ``q`` (an array column, ascending).

    ``reference``: ``base + (hi - x) / (hi - lo * width)``, the published
    operator precedence. ``interpolated``: ``base + (hi - x) / (hi - lo) * width``.
    A zero denominator gives null.
    """
    def inside(i: int) -> Column:
        base, top = bands[i]
        low, high, width = F.get(q, i), F.get(q, i + 1), F.lit(float(top - base))
        if mode == "reference":
            return F.lit(float(base)) + F.try_divide(high - x, high - low * width)
        if mode == "interpolated":
            return F.lit(float(base)) + F.try_divide(high - x, high - low) * width
        raise ValueError(f"unknown scoring mode {mode!r}")

    score = F.when(x == 0, F.lit(100.0))
    for i in range(5):
        score = score.when((x >= F.get(q, i)) & (x <= F.get(q, i + 1)), inside(i))
    return score.otherwise(inside(5))


def blend(detail: Column, event: Column, share: float = 0.7) -> Column:
    return F.lit(share) * detail + F.lit(round(1 - share, 10)) * event


def composite(scores: list[Column], weights: list[Column | float], cap: float | None = 95.0) -> Column:
    """Weighted total; a perfect 100 counts as ``cap`` unless ``cap`` is None."""
    if cap is not None:
        scores = [F.when(s == 100, F.lit(cap)).otherwise(s) for s in scores]
    return weighted(scores, weights)


def trip_score(over: list[Column], accel: Column, brake: Column, turn: Column,
               seconds: Column, variant: str = "taxi") -> Column:
    """Score of one trip from its over-speed counts, marks and duration.

    ``over`` holds the counts of the four over-speed levels, mildest first. The
    taxi formula forgives less the longer the trip; the bus formula scales the
    whole by the duration.
    """
    points = (over[0] + F.lit(1.5) * over[1] + F.lit(2.0) * over[2] + F.lit(2.5) * over[3]).cast("int")
    penalty = (F.least(points, F.lit(50)) + F.least(accel, F.lit(20))
               + F.least(brake, F.lit(20)) + F.least(turn, F.lit(10)))
    ripeness = F.tanh(seconds / F.lit(3600.0))
    if variant == "taxi":
        inner = F.lit(100.0) - penalty * (F.lit(1.0) - ripeness)
    elif variant == "bus":
        inner = (F.lit(100.0) - penalty) * ripeness
    else:
        raise ValueError(f"unknown trip score variant {variant!r}")
    return F.sqrt(inner) * F.lit(10.0)
