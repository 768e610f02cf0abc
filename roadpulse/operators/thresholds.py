"""Learned limits: moments, quartiles and fences.

Quartiles are found exactly (``ranks``), over all pairs and per group, which
needs no single task to merge the sketches of the whole input. Statistics of a
stream's windows take them from Spark's mergeable quantile sketch, in the same
aggregation as the moments.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import motion
from ..session import materialise
from .ranks import grouped_quantiles, quantile_arrays
from .slices import attach_row

ACCURACY = 10_000
QUARTILES = ((0.25, "approx25"), (0.5, "median"), (0.75, "approx75"))


def moments(name: str) -> list[Column]:
    """avg, std, min and max of a column as aggregate columns."""
    return [F.avg(name).alias(f"avg_{name}"), F.stddev_samp(name).alias(f"std_{name}"),
            F.min(name).alias(f"mi_{name}"), F.max(name).alias(f"mx_{name}")]


def expand(stats: DataFrame, suffixes: Iterable[str], low_side: Iterable[str] = ()) -> DataFrame:
    """Split the quartile arrays into columns and add the two IQR fences.

    Fences lie above the third quartile; for ``low_side`` columns (braking)
    below the first.
    """
    low_side = set(low_side)
    out = stats
    for s in suffixes:
        q = F.col(f"_q_{s}")
        out = out.withColumns({f"{label}_{s}": F.get(q, i) for i, (_, label) in enumerate(QUARTILES)})
        q1, q3 = F.col(f"approx25_{s}"), F.col(f"approx75_{s}")
        spread = q3 - q1
        start, sign = (q1, -1.0) if s in low_side else (q3, 1.0)
        out = out.withColumns({f"iqr_{s}": start + F.lit(sign * 1.5) * spread,
                               f"iqr_{s}_max": start + F.lit(sign * 3.0) * spread}).drop(f"_q_{s}")
    return out


def global_limits(pairs: DataFrame, k: float = 3.0, sketch: int | None = None) -> DataFrame:
    """One row: moments of acceleration and mileage gap, sigma limits, IQR band.

    The quartiles are exact by default, for which ``pairs`` is read five times
    and should be stored (``session.materialise``). A quantile sketch of
    accuracy ``sketch`` takes one pass, but a single task merges the sketches
    of all map tasks, and the result depends on the merge order.
    """
    aggregates = [F.avg("a_speed").alias("avg_aspeed"), F.stddev_samp("a_speed").alias("std_aspeed"),
                  F.avg("gap").alias("avg_gap"), F.stddev_samp("gap").alias("std_gap"),
                  F.min("gap").alias("mi_gap"), F.max("gap").alias("mx_gap")]
    if sketch is not None:
        raw = pairs.agg(*aggregates, F.percentile_approx("gap", [0.25, 0.5, 0.75], sketch).alias("_q"))
    else:
        quartiles = quantile_arrays(pairs, {"gap": [0.25, 0.5, 0.75]})
        raw = attach_row(pairs.agg(*aggregates), quartiles, "_row").withColumn("_q", F.col("_row.gap"))
    q1, q3 = F.get("_q", 0), F.get("_q", 2)
    return raw.select(
        (F.col("avg_aspeed") + F.lit(k) * F.col("std_aspeed")).alias("threshold_up"),
        (F.col("avg_aspeed") - F.lit(k) * F.col("std_aspeed")).alias("threshold_dn"),
        (q3 + F.lit(1.5) * (q3 - q1)).alias("threshold_gap_min"),
        (q3 + F.lit(3.0) * (q3 - q1)).alias("threshold_gap_max"),
        "avg_gap", "std_gap", "mi_gap", q1.alias("approx25_gap"), F.get("_q", 1).alias("approx50_gap"),
        q3.alias("approx75_gap"), "mx_gap", "avg_aspeed", "std_aspeed")


# --- statistics published to the stream detectors ---------------------------

MEASURES = ("aspeed", "distance", "turn", "aturn", "tnspeed", "speedgap")


def add_published_motion(pairs: DataFrame) -> DataFrame:
    """The measures the published statistics are about, per pair.

    ``aspeed`` m/s^2, ``distance`` mileage gap in m, ``turn`` and ``aturn`` in
    degrees (per second), ``tnspeed`` mean speed and ``speedgap`` in km/h.
    """
    v0, v1, T = F.col("prespeed"), F.col("lspeed"), F.col("time_interval").cast("double")
    mean_kmh = motion.mean_speed(F.col("v0_kmh"), F.col("v1_kmh"))
    out = pairs.withColumns({
        "aspeed": motion.acceleration(v0, v1, T),
        "turn": motion.heading_change(F.col("preorien"), F.col("orientation")),
        "tnspeed": mean_kmh,
        "_actual": motion.distance_m(F.col("prelon"), F.col("prelat"), F.col("llon"), F.col("llat")),
    })
    return out.withColumns({
        "aturn": motion.turn_rate(F.col("turn"), T),
        "distance": motion.mileage_gap(F.col("_actual"), motion.mean_speed(v0, v1) * T),
        "speedgap": motion.speed_gap(
            motion.driven_speed_kmh(F.col("_actual"), T, digits=None), mean_kmh, digits=None),
    }).drop("_actual")


def published_stats(pairs: DataFrame, by: Sequence[str] = (), mode: str = "two_pass",
                    turn_floor: float = 45.0, sketch: int | None = None) -> DataFrame:
    """The statistics row the detectors read (per group of ``by``, if given).

    ``two_pass``: turning pairs are those above the mean of the turns over
    ``turn_floor``. ``full`` adds turn and speed-gap summaries over all turns
    above zero. ``moments`` leaves the quartiles out and takes turns over 60.

    The conditional summaries of a mode share their passes. The measures are
    stored once and the quartiles are exact; of a stream, or if ``sketch`` gives
    an accuracy, they come from a sketch in the same pass.
    """
    by = list(by)
    exact = sketch is None and mode != "moments" and not pairs.isStreaming
    rows = pairs.select(*by, *MEASURES)
    if exact:
        rows = materialise(rows, "measures")
    up, dn = F.col("aspeed") > 0, F.col("aspeed") < 0
    parts = {"upaspeed": ("aspeed", up), "updist": ("distance", up),
             "dnaspeed": ("aspeed", dn), "dndist": ("distance", dn)}
    extra = []
    if mode == "two_pass":
        mean_turn = F.avg(F.when(F.col("turn") > turn_floor, F.col("turn"))).alias("avg_turn")
        if by:
            rows = rows.join(rows.groupBy(*by).agg(mean_turn), by)
        else:
            rows = attach_row(rows, rows.agg(mean_turn), "_floor").withColumn("avg_turn", F.col("_floor.avg_turn"))
        turning = F.col("turn") > F.col("avg_turn")
        extra = [F.max("avg_turn").alias("avg_turn")]
    elif mode == "full":
        turning = F.col("turn") > 0
        parts |= {"upgap": ("speedgap", up), "dngap": ("speedgap", dn), "turn": ("turn", turning)}
    elif mode == "moments":
        turning = F.col("turn") > 60
        parts["turn"] = ("turn", turning)
    else:
        raise ValueError(f"unknown statistics mode {mode!r}")
    parts |= {"aturn": ("aturn", turning), "tnspeed": ("tnspeed", turning)}
    # "turn" is both a measure and a summary: the measures keep their names until here
    values = rows.select(*by, *[c for c in ("avg_turn",) if mode == "two_pass"],
                         *[F.when(condition, F.col(c)).alias(name) for name, (c, condition) in parts.items()])
    aggregates = [a for name in parts for a in moments(name)]
    if mode == "moments":
        return values.groupBy(*by).agg(*aggregates)
    probs = [p for p, _ in QUARTILES]
    if exact and by:
        quartiles = quantile_arrays(values, dict.fromkeys(parts, probs), by)
        quartiles = quartiles.select(*[F.col(c).alias(f"_by_{c}") for c in by], *[F.col(name).alias(f"_q_{name}") for name in parts])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
        stats = values.groupBy(*by).agg(*aggregates, *extra).join(quartiles, same, "left").drop(*[f"_by_{c}" for c in by])
    elif exact:
        row = attach_row(values.agg(*aggregates, *extra), quantile_arrays(values, dict.fromkeys(parts, probs)), "_q")
        stats = row.withColumns({f"_q_{name}": F.col(f"_q.{name}") for name in parts}).drop("_q")
    else:
        sketches = [F.percentile_approx(name, probs, sketch or ACCURACY).alias(f"_q_{name}") for name in parts]
        stats = values.groupBy(*by).agg(*aggregates, *extra, *sketches)
    return expand(stats, parts, low_side=("dnaspeed",))


def driver_speed_gaps(pairs: DataFrame) -> DataFrame:
    """Per driver: moments and exact percentiles of the gap between driven and mean speed.

    The gaps are stored once; moments and bins are combined map-side, so a
    dominant driver costs no more than any other.
    """
    metres = motion.distance_m(F.col("prelon"), F.col("prelat"), F.col("llon"), F.col("llat"))
    driven = motion.driven_speed_kmh(metres, F.col("time_interval"))
    mean_kmh = motion.round_half_up(motion.mean_speed(F.col("v0_kmh"), F.col("v1_kmh")), 1)
    gaps = materialise(pairs.select("jsy", motion.speed_gap(driven, mean_kmh).alias("g")), "speed-gaps")
    labels = ("approx25", "median", "approx75", "approx90", "approx95")
    summary = gaps.groupBy("jsy").agg(
        F.avg("g").alias("avg_upgap"), F.stddev_samp("g").alias("std_upgap"), F.min("g").alias("mi_upgap"),
        F.max("g").alias("mx_upgap"))
    found = grouped_quantiles(gaps, ["jsy"], "g", [0.25, 0.5, 0.75, 0.9, 0.95]).withColumnRenamed("jsy", "_jsy")
    stats = summary.join(found, F.col("jsy").eqNullSafe(F.col("_jsy")), "left")
    return stats.select("jsy", "avg_upgap", "std_upgap", "mi_upgap",
                        *[F.get("q", i).alias(f"{label}_upgap") for i, label in enumerate(labels)],
                        "mx_upgap")


def driver_limits(df: DataFrame, value: str, k: float, prefix: str) -> DataFrame:
    """Per driver: mean, deviation and the two k-sigma limits of one column."""
    mean, dev = F.avg(value), F.stddev_samp(value)
    return df.groupBy("jsy").agg(
        mean.alias(f"avg_{prefix}"), dev.alias(f"std_{prefix}"),
        (mean + F.lit(k) * dev).alias(f"{prefix}_hi"), (mean - F.lit(k) * dev).alias(f"{prefix}_lo"))


def turn_limits(pairs: DataFrame, floor: float = 1.0, k: float = 2.0) -> DataFrame:
    """Speed and turn-rate limits from clear turns, in one row.

    Turns of at least ``floor`` are averaged; turns of at least that average
    give mean + k sigma of mean speed (km/h) and turn rate.
    """
    kmh = motion.mean_speed(F.col("v0_kmh"), F.col("v1_kmh"))
    turns = pairs.where(F.col("orient") >= floor).select(
        "orient", kmh.alias("v"), (F.col("orient") / F.col("time_interval")).alias("w"))
    mean = turns.agg(F.avg("orient").alias("avg_orient"))
    clear = attach_row(turns, mean, "_m").where("orient >= _m.avg_orient")
    return clear.agg(
        F.max("_m.avg_orient").alias("avg_orient"),
        F.avg("v").alias("avg_speed"), F.stddev_samp("v").alias("std_speed"),
        F.avg("w").alias("avg_angle"), F.stddev_samp("w").alias("std_angle"),
    ).withColumns({"speed_limit": F.col("avg_speed") + F.lit(k) * F.col("std_speed"),
                   "angle_limit": F.col("avg_angle") + F.lit(k) * F.col("std_angle")})
