"""Detector with limits learned per driver, and its detail report.

Fixes 5-20 s apart survive; neighbours are then taken among the survivors, on
both sides. Speed changes outside the driver's own mean +- k sigma are marks,
repeats within 15 s are dropped; turns above the driver's own limits count at a
crossing. Both kinds are merged by (driver, time) and reported with the detail.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import motion
from ..session import materialise
from .marks import drop_repeats, sigma_mark, with_marks
from .pairs import PairRule, neighbours, pair_fixes
from .thresholds import driver_limits


@dataclass(frozen=True)
class SigmaRule:
    """``k`` and ``k_turn`` are the deviations allowed; ``smooth`` averages the
    backward, forward and central acceleration; ``min_turn`` is the turn from
    which the turn statistics are taken."""

    max_speed: float = 80.0
    max_gap: int = 20
    k: float = 3.0
    k_turn: float = 1.0
    smooth: bool = False
    min_turn: float = 45.0
    heading: str = "orientation"
    full_circle: float = motion.FULL_CIRCLE_DEGREES
    match_crossing: bool = True


def survivors(fixes: DataFrame, rule: SigmaRule, carry: Sequence[str] = (),
              tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Plausible fixes that follow another within the gap rule."""
    wanted = list(dict.fromkeys(["wayname", "waytype", "roadcross", "roadsection", *carry]))
    kept = pair_fixes(
        fixes, PairRule(max_gap=rule.max_gap, speed_before=rule.max_speed, speed_after=None,
                        heading=rule.heading, full_circle=rule.full_circle), carry=wanted, tie=tie)
    return kept.select("jsy", *tie, "longtime", "llon", "llat", "orientation",
                       F.col("lspeed").alias("speed"), *wanted)


def with_neighbours(kept: DataFrame, rule: SigmaRule, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    around = neighbours(kept, ["jsy"], ["longtime", "speed", "orientation", "roadcross"],
                        back=1, ahead=1, tie=tie)
    rows = around.withColumns({
        "pretime": F.col("p1.longtime"), "prespeed": F.col("p1.speed"),
        "preorien": F.col("p1.orientation"), "precross": F.col("p1.roadcross"),
        "lattime": F.col("n1.longtime"), "latspeed": F.col("n1.speed"),
        "latorien": F.col("n1.orientation"), "latcross": F.col("n1.roadcross"),
    }).drop("p1", "n1")
    v0, v1, v2 = F.col("prespeed"), F.col("speed"), F.col("latspeed")
    t0, t1, t2 = (F.col(c).cast("double") for c in ("pretime", "longtime", "lattime"))
    change = (motion.smoothed_acceleration(v0, v1, v2, t0, t1, t2) if rule.smooth
              else motion.acceleration(v0, v1, t1 - t0))
    turn = motion.heading_change(F.col("preorien"), F.col("orientation"), rule.full_circle)
    return rows.withColumns({
        "a_speed": change, "avg_speed": motion.mean_speed(v0, v1), "orient": turn,
        "angle_speed": motion.turn_rate(turn, t1 - t0)})


def attach_driver(rows: DataFrame, stats: DataFrame, block: str = "block") -> DataFrame:
    """Put per-driver statistics next to every row.

    Joining on the driver alone would send a driver's whole history to one
    task. The statistics are copied to each of the driver's blocks first, and
    the join is on (driver, block), as the rows already lie.
    """
    spread = rows.select("jsy", block).distinct().join(stats, "jsy")
    return rows.join(spread, ["jsy", block], "left")


def speed_marks(detail: DataFrame, rule: SigmaRule, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    limits = driver_limits(detail, "a_speed", rule.k, "a").select("jsy", "a_hi", "a_lo")
    marked = with_marks(attach_driver(detail, limits), sigma_mark("a_speed", "a_hi", "a_lo"))
    return drop_repeats(marked, tie=tie).where(F.col("roadsection").isNotNull())


def turn_marks(detail: DataFrame, rule: SigmaRule) -> DataFrame:
    turns = detail.where(F.col("orient") > rule.min_turn)
    stats = turns.groupBy("jsy").agg(
        (F.avg("avg_speed") + F.lit(rule.k_turn) * F.stddev_samp("avg_speed")).alias("v_limit"),
        (F.avg("angle_speed") + F.lit(rule.k_turn) * F.stddev_samp("angle_speed")).alias("g_limit"))
    over = attach_driver(turns, stats).where("avg_speed > v_limit AND angle_speed > g_limit")
    crossing = F.coalesce("precross", "roadcross", "latcross")
    out = over.withColumns({"iscross": crossing, "angle_mark": F.lit(1)})
    return out.where(F.col("iscross").isNotNull()) if rule.match_crossing else out


def merge_marks(speed: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per (driver, time) with a speed mark, a turn mark or both."""
    left = speed.select("jsy", "longtime", "roadsection", "rapid_mark")
    right = turns.select("jsy", "longtime", "iscross", "angle_mark")
    return left.join(right, ["jsy", "longtime"], "full_outer")


def report(detail: DataFrame, merged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The merged marks with their detail, speeds back in km/h, and the columns ``carry`` of the fix."""
    kmh = motion.kilometres_per_hour
    d = detail.select(
        "jsy", "longtime", "llat", "llon", "pretime", "lattime", kmh(F.col("prespeed")).alias("pre_speed"),
        kmh(F.col("speed")).alias("speed_kmh"), kmh(F.col("latspeed")).alias("lat_speed"),
        "preorien", "orientation", "latorien", "wayname", "waytype", *carry)
    return d.join(merged, ["jsy", "longtime"]).select(
        F.col("jsy").alias("user_id"), F.col("llat").alias("lat"), F.col("llon").alias("lon"),
        F.col("pretime").alias("pre_timestamp"), F.col("longtime").alias("timestamp"),
        F.col("lattime").alias("lat_timestamp"), "pre_speed", F.col("speed_kmh").alias("speed"), "lat_speed",
        F.col("preorien").alias("pre_orientation"), "orientation", F.col("latorien").alias("lat_orientation"),
        F.col("iscross").alias("cross"), F.col("roadsection").alias("section"),
        F.col("wayname").alias("way_name"), F.col("waytype").alias("way_type"),
        F.col("rapid_mark").alias("rapid_change"), F.col("angle_mark").alias("rapid_turn"), *carry)


def detect(fixes: DataFrame, rule: SigmaRule = SigmaRule(), tie: Sequence[str] = ("event_id",),
           carry: Sequence[str] = ()) -> DataFrame:
    """The whole detector. The detail feeds five branches, so it is written once."""
    detail = materialise(with_neighbours(survivors(fixes, rule, carry, tie), rule, tie), "sigma-detail")
    merged = merge_marks(speed_marks(detail, rule, tie), turn_marks(detail, rule))
    return report(detail, merged, carry)
