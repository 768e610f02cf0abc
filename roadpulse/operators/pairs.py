"""Consecutive fixes of a driver, and the motion between them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import motion
from ..functions.envelope import mileage_limits
from .slices import HOUR, crowded, row_blocks, time_slices, with_rank


@dataclass(frozen=True)
class PairRule:
    """Which fixes form a pair.

    ``speed_before`` drops implausible fixes before pairing, so the pair spans
    the gap they leave; ``speed_after`` drops pairs that touch one. ``strict``
    makes the speed limit exclusive and applies it to the later fix only, as
    the stream detectors do.
    """

    keys: tuple[str, ...] = ("jsy",)
    min_gap: int = 5
    max_gap: int = 60
    speed_before: float | None = None
    speed_after: float | None = 80.0
    strict: bool = False
    heading: str = "orientation"
    full_circle: float = motion.FULL_CIRCLE_DEGREES


BUS = PairRule()
TAXI = PairRule(keys=("jsy", "dbuscard"), speed_after=120.0, heading="carheadangle",
                full_circle=motion.FULL_CIRCLE_SECTORS)

PREVIOUS = ("llon", "llat", "longtime", "speed", "heading")


def pair_fixes(fixes: DataFrame, rule: PairRule = BUS, carry: Sequence[str] = (),
               previous: Sequence[str] = (), tie: Sequence[str] = ("event_id",),
               width: int | None = None) -> DataFrame:
    """Each fix with the one before it, where the gap rule holds.

    ``carry`` names columns of the later fix to keep, ``previous`` columns to
    take from the earlier fix too (as ``pre<name>``). ``prespeed`` and ``lspeed``
    come out in m/s, ``v0_kmh`` and ``v1_kmh`` as recorded.
    Since only gaps up to ``max_gap`` survive, time slices with that much
    context pair exactly, in one shuffle. ``width`` is the slice length in
    seconds: an hour, or six times the gap where that is longer. Where a key
    crowds into a slice, rows are numbered and paired in blocks of equal length.
    """
    source = fixes.withColumn("heading", F.col(rule.heading))
    if rule.speed_before is not None:
        source = source.where(F.col("speed") <= F.lit(rule.speed_before))
    wanted = dict.fromkeys([*rule.keys, *PREVIOUS, *tie, *carry, *previous])
    source = source.select(*wanted)
    window = Window.partitionBy(*rule.keys, "slice").orderBy("longtime", *tie)
    before = [*dict.fromkeys([*PREVIOUS, *previous])]
    width = width or max(HOUR, 6 * rule.max_gap)
    home = F.expr(f"longtime div {width}")
    if crowded(fixes, rule.keys, home):
        whole = source.withColumn("_key", F.struct(*rule.keys))  # equal to itself also where a key is null
        paired = (neighbours(whole, ["_key"], before, tie=tie, rank_slice=width)
                  .withColumnRenamed("p1", "pre").withColumn("slice", home).where("pre IS NOT NULL"))
    else:
        paired = (time_slices(source, "longtime", rule.max_gap, width)
                  .withColumn("pre", F.lag(F.struct(*before)).over(window))
                  .where("is_home AND pre IS NOT NULL"))
    gap = F.col("longtime") - F.col("pre.longtime")
    kept = paired.where(gap.between(rule.min_gap, rule.max_gap))
    if rule.speed_after is not None and rule.strict:
        kept = kept.where(F.col("speed") < F.lit(rule.speed_after))
    elif rule.speed_after is not None:
        limit = F.lit(rule.speed_after)
        kept = kept.where((F.col("speed") <= limit) & (F.col("pre.speed") <= limit))
    return kept.select(
        *rule.keys, "slice", *tie, *[c for c in carry if c not in (*rule.keys, *tie)],
        *[F.col(f"pre.{c}").alias(f"pre{c}") for c in previous],
        F.col("pre.llon").alias("prelon"), F.col("pre.llat").alias("prelat"),
        F.col("pre.longtime").alias("pretime"),
        F.col("pre.speed").alias("v0_kmh"), F.col("speed").alias("v1_kmh"),
        motion.metres_per_second(F.col("pre.speed")).alias("prespeed"),
        F.col("pre.heading").alias("preorien"),
        "llon", "llat", "longtime",
        motion.metres_per_second(F.col("speed")).alias("lspeed"),
        F.col("heading").alias("orientation"),
        gap.alias("time_interval"),
    )


def every_pair(fixes: DataFrame, keys: Sequence[str] = ("jsy",), speed_before: float | None = None, earlier: int = 1,
               carry: Sequence[str] = (), tie: Sequence[str] = ("event_id",), heading: str = "orientation") -> DataFrame:
    """Each fix with the one before it, however far away, in the columns of ``pair_fixes``.

    Only later times form a pair. With ``earlier`` = 2 a fix needs two fixes
    before it, in order, as the detectors do that keep two states; the speed of
    the first of them is ``pp_kmh``.
    """
    source = fixes.withColumn("heading", F.col(heading))
    if speed_before is not None:
        source = source.where(F.col("speed") <= F.lit(speed_before))
    source = source.select(*dict.fromkeys([*keys, *PREVIOUS, *tie, *carry]))
    rows = neighbours(source, list(keys), list(PREVIOUS), back=earlier, tie=tie).where("longtime > p1.longtime")
    if earlier > 1:
        rows = rows.where("p1.longtime > p2.longtime")
    return rows.select(
        *keys, *tie, *[c for c in carry if c not in (*keys, *tie)],
        F.col("p1.llon").alias("prelon"), F.col("p1.llat").alias("prelat"), F.col("p1.longtime").alias("pretime"),
        F.col("p1.speed").alias("v0_kmh"), F.col("speed").alias("v1_kmh"),
        motion.metres_per_second(F.col("p1.speed")).alias("prespeed"), F.col("p1.heading").alias("preorien"),
        "llon", "llat", "longtime", motion.metres_per_second(F.col("speed")).alias("lspeed"),
        F.col("heading").alias("orientation"), (F.col("longtime") - F.col("p1.longtime")).alias("time_interval"),
        *([F.col("p2.speed").alias("pp_kmh")] if earlier > 1 else []))


def add_motion(pairs: DataFrame, full_circle: float = motion.FULL_CIRCLE_DEGREES,
               limits: str = "truncated", limits_read: str = "ms",
               distance: str = "reference") -> DataFrame:
    """Acceleration, turn, turn rate, mileage and its plausible limits per pair."""
    v0, v1, T = F.col("prespeed"), F.col("lspeed"), F.col("time_interval").cast("double")
    bounds = mileage_limits(v0, v1, T, variant=limits, speeds_in=limits_read)
    return (pairs
            .withColumns({
                "a_speed": motion.acceleration(v0, v1, T),
                "avg_speed": motion.mean_speed(v0, v1),
                "orient": motion.heading_change(F.col("preorien"), F.col("orientation"), full_circle),
                "actual_dist": motion.distance_m(
                    F.col("prelon"), F.col("prelat"), F.col("llon"), F.col("llat"), distance),
                "avg_dist": motion.mean_speed(v0, v1) * T,
                "up_min": bounds.up_min, "up_max": bounds.up_max,
                "dn_min": bounds.dn_min, "dn_max": bounds.dn_max,
            })
            .withColumns({
                "angle_speed": motion.turn_rate(F.col("orient"), T),
                "gap": motion.mileage_gap(F.col("actual_dist"), F.col("avg_dist")),
            }))


def neighbours(fixes: DataFrame, keys: Sequence[str], columns: Sequence[str], back: int = 1,
               ahead: int = 0, tie: Sequence[str] = ("event_id",), time: str = "longtime",
               size: int | None = None, rank_slice: int = HOUR) -> DataFrame:
    """Every row with its neighbours, however far away in time.

    Adds ``rank``, ``block`` and structs ``p1``, ``p2``, ... (earlier rows)
    and ``n1``, ... (later rows). Works on row blocks, so no driver's history
    has to fit one task.
    """
    ranked = with_rank(fixes, keys, [time, *tie], F.expr(f"`{time}` div {rank_slice}"))
    extra = {} if size is None else {"size": size}
    blocks = row_blocks(ranked, before=back, after=ahead, **extra)
    window = Window.partitionBy(*keys, "block").orderBy("rank")
    payload = F.struct(*columns)
    return blocks.withColumns({
        **{f"p{k}": F.lag(payload, k).over(window) for k in range(1, back + 1)},
        **{f"n{k}": F.lead(payload, k).over(window) for k in range(1, ahead + 1)},
    }).where("is_home").drop("is_home")
