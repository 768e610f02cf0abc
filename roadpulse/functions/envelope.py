"""Theoretical mileage limits for an interval with one hard speed change.

For a change from ``v0`` to ``v1`` inside ``seconds`` the vehicle is assumed to
change speed at a fixed hard rate for at least a minimum ramp, and to hold or
drift for the rest. Driving the ramp first or last gives the two limits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .motion import metres_per_second

# Fixed values.
HARD_RATE = 2.78      # m/s^2
MIN_RAMP = 2.0        # s

VARIANTS = ("ramp", "steady", "truncated")


@dataclass(frozen=True)
class MileageLimits:
    """Shortest and longest plausible mileage when speeding up and when braking."""

    up_min: Column
    up_max: Column
    dn_min: Column
    dn_max: Column


def _trapezoid(a: Column, b: Column, seconds: Column) -> Column:
    return (a + b) / F.lit(2.0) * seconds


def _ramp(v0: Column, v1: Column, T: Column) -> MileageLimits:
    floor0, step, ramp = F.lit(0.0), F.lit(HARD_RATE * MIN_RAMP), F.lit(MIN_RAMP)

    def choose(t: Column, long_ramp: Column, short_ramp: Column) -> Column:
        return (F.when(t >= ramp, long_ramp)
                .when((t > floor0) & (t < ramp), short_ramp)
                .otherwise(floor0))

    up, dn = (v1 - v0) / F.lit(HARD_RATE), (v0 - v1) / F.lit(HARD_RATE)
    low_before = F.greatest(v1 - step, floor0)
    low_after = F.greatest(v0 - step, floor0)
    high_after, high_before = v0 + step, v1 + step
    return MileageLimits(
        up_min=choose(up, v0 * (T - up) + _trapezoid(v0, v1, up),
                      _trapezoid(v0, low_before, T - ramp) + _trapezoid(low_before, v1, ramp)),
        up_max=choose(up, _trapezoid(v0, v1, up) + v1 * (T - up),
                      _trapezoid(v0, high_after, ramp) + _trapezoid(high_after, v1, T - ramp)),
        dn_min=choose(dn, _trapezoid(v0, v1, dn) + v1 * (T - dn),
                      _trapezoid(v0, low_after, ramp) + _trapezoid(low_after, v1, T - ramp)),
        dn_max=choose(dn, v0 * (T - dn) + _trapezoid(v0, v1, dn),
                      _trapezoid(v0, high_before, T - ramp) + _trapezoid(high_before, v1, ramp)),
    )


def _steady(v0: Column, v1: Column, T: Column) -> MileageLimits:
    def ramp_time(t: Column) -> Column:
        return (F.when(t >= F.lit(MIN_RAMP), t)
                .when(t > F.lit(0.0), F.lit(MIN_RAMP))
                .otherwise(F.lit(0.0)))

    up = ramp_time((v1 - v0) / F.lit(HARD_RATE))
    dn = ramp_time((v0 - v1) / F.lit(HARD_RATE))
    return MileageLimits(
        up_min=v0 * (T - up) + _trapezoid(v0, v1, up),
        up_max=_trapezoid(v0, v1, up) + v1 * (T - up),
        dn_min=_trapezoid(v0, v1, dn) + v1 * (T - dn),
        dn_max=v0 * (T - dn) + _trapezoid(v0, v1, dn),
    )


def _truncated(v0: Column, v1: Column, T: Column) -> MileageLimits:
    # The quadratic ramp term is absent from this variant's definition.
    step, ramp, rest = F.lit(HARD_RATE * MIN_RAMP), F.lit(MIN_RAMP), T - F.lit(MIN_RAMP)
    low_before = F.greatest(v1 - step, F.lit(0.0))
    low_after = F.greatest(v0 - step, F.lit(0.0))
    high_before = v1 + step
    return MileageLimits(
        up_min=_trapezoid(v0, low_before, rest) + low_before * ramp,
        up_max=v0 * ramp + _trapezoid(v0 + step, v1, rest),
        dn_min=v0 * ramp + _trapezoid(low_after, v1, rest),
        dn_max=_trapezoid(v0, high_before, rest) + high_before * ramp,
    )


def mileage_limits(v0: Column, v1: Column, seconds: Column,
                   variant: str = "ramp", speeds_in: str = "kmh") -> MileageLimits:
    """Plausible mileage limits for one interval.

    ``ramp`` is the current definition, ``steady`` keeps the rest of the
    interval at one speed, ``truncated`` is the oldest. ``speeds_in`` is the
    unit the speeds are *read* in: ``kmh`` divides them by 3.6 first. (The
    offline taxi job reads m/s values as km/h; it passes ``kmh`` here with m/s
    columns, see its preset.)
    """
    if speeds_in == "kmh":
        v0, v1 = metres_per_second(v0), metres_per_second(v1)
    elif speeds_in != "ms":
        raise ValueError(f"unknown speed unit {speeds_in!r}")
    return {"ramp": _ramp, "steady": _steady, "truncated": _truncated}[variant](v0, v1, seconds)
