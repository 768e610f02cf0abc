"""Motion between two consecutive fixes, as plain column expressions.

Everything here stays inside whole-stage code generation. Speeds carry their
unit in the argument name; times are epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
EARTH_RADIUS_KM = 6378.137
KMH_PER_MS = 3.6
FULL_CIRCLE_DEGREES = 360.0
FULL_CIRCLE_SECTORS = 8.0


def metres_per_second(kmh: Column) -> Column:
    return kmh / F.lit(KMH_PER_MS)


def kilometres_per_hour(ms: Column) -> Column:
    return ms * F.lit(KMH_PER_MS)


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column,
               variant: str = "reference") -> Column:
    """Distance in metres between two positions in degrees.

    ``reference`` takes the sine of the squared half angle, which is what the
    published thresholds were learned with. ``haversine`` squares the sine and
    is the true great-circle distance.
    """
    def half_angle(a: Column, b: Column) -> Column:
        return F.abs(a - b) * F.pi() / F.lit(360.0)

    if variant == "reference":
        north = F.sin(F.pow(half_angle(lat1, lat2), F.lit(2.0)))
        east = F.sin(F.pow(half_angle(lon1, lon2), F.lit(2.0)))
    elif variant == "haversine":
        north = F.pow(F.sin(half_angle(lat1, lat2)), F.lit(2.0))
        east = F.pow(F.sin(half_angle(lon1, lon2)), F.lit(2.0))
    else:
        raise ValueError(f"unknown distance variant {variant!r}")
    shrink = F.cos(lat1 * F.pi() / F.lit(180.0)) * F.cos(lat2 * F.pi() / F.lit(180.0))
    return F.lit(2.0) * F.asin(F.sqrt(north + east * shrink)) * F.lit(EARTH_RADIUS_KM) * F.lit(1000.0)


def acceleration(v0_ms: Column, v1_ms: Column, seconds: Column) -> Column:
    return F.try_divide(v1_ms - v0_ms, seconds)


def mean_speed(v0: Column, v1: Column) -> Column:
    return (v0 + v1) / F.lit(2.0)


def heading_change(before: Column, after: Column, full_circle: float = FULL_CIRCLE_DEGREES) -> Column:
    """Smallest turn between two headings, in the unit of ``full_circle``."""
    turn = F.abs(after - before)
    return F.when(turn > F.lit(full_circle / 2), F.lit(full_circle) - turn).otherwise(turn)


def turn_rate(turn: Column, seconds: Column) -> Column:
    return F.try_divide(turn, seconds)


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding of a non-negative value; a tie that binary arithmetic
    left just below the half still rounds up."""
    return F.round(value + F.lit(1e-9), digits)


def mileage_gap(actual_m: Column, expected_m: Column) -> Column:
    return F.abs(actual_m - expected_m)


def driven_speed_kmh(metres: Column, seconds: Column, digits: int | None = 1) -> Column:
    """Speed implied by the distance really covered."""
    speed = F.try_divide(metres, seconds) * F.lit(KMH_PER_MS)
    return speed if digits is None else F.round(speed, digits)


def speed_gap(driven: Column, expected: Column, digits: int | None = 2) -> Column:
    gap = F.abs(driven - expected)
    return gap if digits is None else F.round(gap, digits)


def smoothed_acceleration(v_before: Column, v_now: Column, v_after: Column,
                          t_before: Column, t_now: Column, t_after: Column) -> Column:
    """Mean of the backward, forward and central differences."""
    backward = acceleration(v_before, v_now, t_now - t_before)
    forward = acceleration(v_now, v_after, t_after - t_now)
    central = acceleration(v_before, v_after, t_after - t_before)
    return (backward + forward + central) / F.lit(3.0)
