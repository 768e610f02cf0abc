"""Mark classifiers: 1 hard acceleration, 2 hard braking, 3 hard turn, 0 none.

Each classifier is one CASE expression over the motion columns of a pair.
Learned limits arrive as a struct column (see ``slices.attach_row``), so that
learning and classifying make one Spark plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .presets import SIMPLE_ACCEL, SIMPLE_SPEED, SIMPLE_TURN_RATE, Preset
from .slices import attach_row, time_slices
from .thresholds import global_limits

NONE, ACCELERATE, BRAKE, TURN = 0, 1, 2, 3


@dataclass(frozen=True)
class Limits:
    """Limits of the band rule, as columns."""

    accel: Column
    brake: Column
    up_gap: tuple[Column, Column] | None
    dn_gap: tuple[Column, Column] | None
    turn: Column
    turn_rate: Column
    turn_speed_kmh: Column


def _number(value: float | None, learned: Column | None) -> Column:
    if value is not None:
        return F.lit(float(value))
    if learned is None:
        raise ValueError("this preset needs learned limits")
    return learned


def batch_limits(preset: Preset, learned: str | None = None) -> Limits:
    """Limits of an offline preset; ``learned`` names a struct column holding
    the row of ``thresholds.global_limits``. The learned brake limit is the
    mirrored acceleration limit."""
    def field(name: str) -> Column | None:
        return None if learned is None else F.col(f"{learned}.{name}")

    up = field("threshold_up")
    band = None
    if preset.use_gap:
        band = (_number(preset.gap_lo, field("threshold_gap_min")),
                _number(preset.gap_hi, field("threshold_gap_max")))
    return Limits(
        accel=_number(preset.accel, up),
        brake=_number(preset.brake, None if up is None else -up),
        up_gap=band, dn_gap=band,
        turn=_number(preset.turn, None), turn_rate=_number(preset.turn_rate, None),
        turn_speed_kmh=_number(preset.turn_speed, None))


def published_limits(stats: str, brake_sigma: str = "std_upaspeed") -> Limits:
    """Limits from a published statistics row. The brake limit takes its
    deviation from the accelerating pairs; pass ``std_dnaspeed`` for the
    braking ones."""
    def s(name: str) -> Column:
        return F.col(f"{stats}.{name}")

    three = F.lit(3.0)
    return Limits(
        accel=s("avg_upaspeed") + three * s("std_upaspeed"),
        brake=s("avg_dnaspeed") - three * s(brake_sigma),
        up_gap=(s("iqr_updist"), s("iqr_updist_max")),
        dn_gap=(s("iqr_dndist"), s("iqr_dndist_max")),
        turn=s("avg_turn"),
        turn_rate=s("avg_aturn") + three * s("std_aturn"),
        turn_speed_kmh=s("avg_tnspeed") + three * s("std_tnspeed"))


def _chain(rules: Sequence[tuple[Column, int]]) -> Column:
    first, *rest = rules
    mark = F.when(first[0], F.lit(first[1]))
    for condition, code in rest:
        mark = mark.when(condition, F.lit(code))
    return mark.otherwise(F.lit(NONE))


def band_mark(limits: Limits, straight: float | None = None, turn_first: bool = True,
              check_mileage: bool = True) -> Column:
    """The band rule: a speed change counts only where the mileage is both
    outside its theoretical limits and off by an amount inside the gap band."""
    a, gap, d = F.col("a_speed"), F.col("gap"), F.col("actual_dist")
    up, dn = a > limits.accel, a < limits.brake
    if check_mileage:
        up &= (d > F.col("up_max")) | (d < F.col("up_min"))
        dn &= (d > F.col("dn_max")) | (d < F.col("dn_min"))
    if limits.up_gap is not None:
        up &= (gap > limits.up_gap[0]) & (gap < limits.up_gap[1])
    if limits.dn_gap is not None:
        dn &= (gap > limits.dn_gap[0]) & (gap < limits.dn_gap[1])
    if straight is not None:
        up &= F.col("orient") < straight
        dn &= F.col("orient") < straight
    mean_kmh = F.col("avg_speed") * F.lit(3.6)
    turn = ((F.col("angle_speed") > limits.turn_rate) & (mean_kmh > limits.turn_speed_kmh)
            & (F.col("orient") > limits.turn))
    speed_rules = [(up, ACCELERATE), (dn, BRAKE)]
    return _chain([(turn, TURN), *speed_rules] if turn_first else [*speed_rules, (turn, TURN)])


def simple_mark(accel: float = SIMPLE_ACCEL, turn_rate: float = SIMPLE_TURN_RATE,
                speed: float = SIMPLE_SPEED) -> Column:
    """Speed rule: a change counts only at speed (km/h), with no mileage check."""
    return simple_rule(F.col("a_speed"), F.col("angle_speed"), F.col("v0_kmh"), F.col("v1_kmh"),
                       accel, turn_rate, speed)


def simple_rule(a: Column, w: Column, v0_kmh: Column, v1_kmh: Column, accel: float = SIMPLE_ACCEL,
                turn_rate: float = SIMPLE_TURN_RATE, speed: float = SIMPLE_SPEED) -> Column:
    """The simple rule over given columns: ``a`` in m/s^2, ``w`` in degrees/s."""
    return _chain([
        ((a > accel) & (v1_kmh > speed), ACCELERATE),
        ((a < -accel) & (v0_kmh > speed), BRAKE),
        ((w > turn_rate) & ((v0_kmh + v1_kmh) / F.lit(2.0) > speed), TURN)])


def either_mark(stats: str, straight_turn: float = 60.0, short: int = 30) -> Column:
    """Three alternatives per speed change: both measures moderately high, or
    acceleration very high at speed, or mileage gap very high on a short interval."""
    def limit(name: str, k: float) -> Column:
        return F.col(f"{stats}.avg_{name}") + F.lit(k) * F.col(f"{stats}.std_{name}")

    a, gap = F.col("a_speed"), F.col("gap")
    mean_kmh = (F.col("v0_kmh") + F.col("v1_kmh")) / F.lit(2.0)
    fast = mean_kmh > limit("tnspeed", 1.0)
    brief = F.col("time_interval") <= short
    up = (((a > limit("upaspeed", 2.0)) & (gap > limit("updist", 1.0)))
          | ((a > limit("upaspeed", 3.0)) & fast)
          | ((a > 0) & (gap > limit("updist", 3.0)) & brief))
    dn = (((a < limit("dnaspeed", -2.0)) & (gap > limit("dndist", 1.0)))
          | ((a < limit("dnaspeed", -3.0)) & fast)
          | ((a < 0) & (gap > limit("dndist", 3.0)) & brief))
    turn = (F.col("angle_speed") > limit("aturn", 1.0)) & (F.col("orient") > straight_turn) & fast
    return _chain([(up, ACCELERATE), (dn, BRAKE), (turn, TURN)])


def fence_mark(stats: str, short: int = 30) -> Column:
    """Every measure of a pair beyond its IQR fence."""
    def fence(name: str) -> Column:
        return F.col(f"{stats}.iqr_{name}")

    a, gap, vgap = F.col("a_speed"), F.col("gap"), F.col("speedgap")
    mean_kmh = (F.col("v0_kmh") + F.col("v1_kmh")) / F.lit(2.0)
    brief = F.col("time_interval") <= short
    return _chain([
        ((a > fence("upaspeed")) & (gap > fence("updist")) & (vgap > fence("upgap")) & brief, ACCELERATE),
        ((a < fence("dnaspeed")) & (gap > fence("dndist")) & (vgap > fence("dngap")) & brief, BRAKE),
        ((F.col("angle_speed") > fence("aturn")) & (F.col("orient") > fence("turn"))
         & (mean_kmh > fence("tnspeed")), TURN)])


def brief_mark(preset: Preset) -> Column:
    """Acceleration and turn rule, applied only when the pair before was short;
    the caller filters on that earlier gap."""
    return band_mark(batch_limits(preset), straight=None, turn_first=False, check_mileage=False)


def sigma_mark(value: str, high: str, low: str) -> Column:
    """Acceleration outside the driver's own limits."""
    return _chain([(F.col(value) > F.col(high), ACCELERATE), (F.col(value) < F.col(low), BRAKE)])


def with_marks(df: DataFrame, mark: Column, keep_zero: bool = False) -> DataFrame:
    """Add ``rapid_mark``; unmarked pairs are dropped unless ``keep_zero``.

    A filter on the mark would be pushed below the projection that computes it,
    and every distance and limit would be evaluated again inside the filter.
    Exploding a possibly empty array drops the same rows after one evaluation.
    """
    if keep_zero:
        return df.withColumn("rapid_mark", mark)
    return (df.withColumn("_mark", mark)
            .withColumn("rapid_mark", F.explode(F.when(F.col("_mark") != NONE, F.array("_mark"))))
            .drop("_mark"))


def learn_and_mark(motion: DataFrame, preset: Preset, keep_zero: bool = False,
                   sketch: int | None = None) -> DataFrame:
    """Offline detector: learn the global limits, then classify.

    The pairs are stored in between: they are shuffled once, learning then
    reads two columns of them and classifying the rest.
    """
    motion = materialise(motion, "motion")
    learned = attach_row(motion, global_limits(motion, sketch=sketch), "limits")
    mark = band_mark(batch_limits(preset, "limits"), preset.straight, preset.turn_first)
    return with_marks(learned, mark, keep_zero).drop("limits")


def gap_band_mark(motion: DataFrame, accel: float, brake: float) -> DataFrame:
    """Gap band first as a row filter, then the two speed-change rules."""
    motion = materialise(motion, "motion")
    learned = attach_row(motion, global_limits(motion), "limits").where(
        "gap > limits.threshold_gap_min AND gap < limits.threshold_gap_max")
    d = F.col("actual_dist")
    mark = _chain([
        ((F.col("a_speed") > accel) & ((d > F.col("up_max")) | (d < F.col("up_min"))), ACCELERATE),
        ((F.col("a_speed") < brake) & ((d > F.col("dn_max")) | (d < F.col("dn_min"))), BRAKE)])
    return with_marks(learned, mark).drop("limits")


def drop_repeats(marked: DataFrame, keys: Sequence[str] = ("jsy",), within: int = 15,
                 tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Drop a mark equal to the one before it within ``within`` seconds.

    An older mark never suppresses, so a look-back of ``within`` seconds is all
    the context a time slice needs.
    """
    window = Window.partitionBy(*keys, "slice").orderBy("longtime", *tie)
    sliced = time_slices(marked.drop("slice"), "longtime", within)
    return (sliced
            .withColumn("_before", F.lag(F.struct("longtime", "rapid_mark")).over(window))
            .where("is_home AND (_before IS NULL OR longtime - _before.longtime > %d "
                   "OR rapid_mark <> _before.rapid_mark)" % within)
            .drop("_before", "is_home", "slice"))
