"""Driver features and scores.

Detail and event features come from the same input row, so both are projected
side by side; quantiles of all features are found together; scoring is one more
projection. ``blend_scores`` joins detail and event scores kept as two tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import grading
from ..functions.grading import rate, smoothed_rate, weighted
from ..session import materialise
from .ranks import quantile_arrays
from .slices import attach_row
from .weights import bus_tree, taxi_tree

DIMENSIONS = ("over_count", "over_level", "over_time", "rapid_up", "rapid_down", "rapid_turn")


def _col(name: str) -> Column:
    return F.col(name).cast("double")


def bus_features(inputs: DataFrame, distance: str = "distance") -> DataFrame:
    """Detail and event features of bus drivers.

    ``inputs``: ``user_id``, the distance, and counts ``<place>_count``,
    ``<place>_{a,b,c}_count`` for section, cross and station, ``section_time``,
    ``upper_sudden``, ``low_sudden``, ``turn_sudden``; the same with ``_event``.
    The place weights are applied in the published order, which differs between
    the detail and the event level.
    """
    km, w, e = _col(distance), bus_tree(), bus_tree(event=True)

    def level(place: str, letters: str, suffix: str, tree: dict) -> Column:
        return weighted([rate(_col(f"{place}_{x}_count{suffix}"), km) for x in letters], tree[place])

    def sudden(name: str) -> tuple[Column, Column]:
        return smoothed_rate(_col(name), km), rate(_col(f"{name}_event"), km)

    up, down, turn = sudden("upper_sudden"), sudden("low_sudden"), sudden("turn_sudden")
    return inputs.select(
        F.col("user_id"),
        weighted([smoothed_rate(_col("section_count"), km), rate(_col("cross_count"), km),
                  rate(_col("station_count"), km)], w["count"]).alias("over_count"),
        weighted([level("section", "abc", "", w), level("cross", "abc", "", w),
                  level("station", "abc", "", w)], w["level"]).alias("over_level"),
        smoothed_rate(_col("section_time"), km).alias("over_time"),
        up[0].alias("rapid_up"), down[0].alias("rapid_down"), turn[0].alias("rapid_turn"),
        weighted([rate(_col(f"{p}_count_event"), km) for p in ("section", "cross", "station")],
                 e["count"]).alias("over_count_event"),
        weighted([level("section", "bc", "_event", e), level("station", "bc", "_event", e),
                  level("cross", "bc", "_event", e)], e["level"]).alias("over_level_event"),
        rate(_col("section_time_event"), km).alias("over_time_event"),
        up[1].alias("rapid_up_event"), down[1].alias("rapid_down_event"),
        turn[1].alias("rapid_turn_event"))


def taxi_features(inputs: DataFrame, distance: str = "kilometers", min_km: float | None = 50.0) -> DataFrame:
    """Detail and event features of taxi drivers with enough mileage."""
    km, w, e = _col(distance), taxi_tree(), taxi_tree(event=True)
    if min_km is not None:
        inputs = inputs.where(km > min_km)
    return inputs.select(
        F.col("jsy").alias("user_id"),
        weighted([rate(_col("lift_kilometers"), km), rate(_col("empty_kilometers"), km)],
                 w["mileage"]).alias("mileage"),
        smoothed_rate(_col("overspeed_count"), km).alias("over_count"),
        weighted([smoothed_rate(_col(f"overspeed_{x}"), km) for x in "abc"], w["level"]).alias("over_level"),
        smoothed_rate(_col("overspeed_time"), km).alias("over_time"),
        smoothed_rate(_col("up_sudden_count"), km).alias("rapid_up"),
        smoothed_rate(_col("down_sudden_count"), km).alias("rapid_down"),
        smoothed_rate(_col("turn_sudden_count"), km).alias("rapid_turn"),
        rate(_col("overspeed_event_count"), km).alias("over_count_event"),
        weighted([rate(_col(f"overspeed_event_{x}"), km) for x in "bc"], e["level"]).alias("over_level_event"),
        rate(_col("overspeed_event_time"), km).alias("over_time_event"),
        rate(_col("up_sudden_event"), km).alias("rapid_up_event"),
        rate(_col("down_sudden_event"), km).alias("rapid_down_event"),
        rate(_col("turn_sudden_event"), km).alias("rapid_turn_event"))


def score_drivers(features: DataFrame, kind: str, bands: tuple = grading.BANDS, mode: str = "reference",
                  cap: float | None = 95.0, share: float = 0.7) -> DataFrame:
    """Scores per dimension and the weighted total, ``kind`` is "bus" or "taxi"."""
    extra = ["mileage"] if kind == "taxi" else []
    detail = [*extra, *DIMENSIONS]
    event = [f"{d}_event" for d in DIMENSIONS]
    # one row per driver, read again by every step of the quantile search
    features = materialise(features, "features")
    event_probs = grading.DETAIL_PROBS if kind == "taxi" else grading.BUS_EVENT_PROBS
    probs = {**dict.fromkeys(detail, grading.DETAIL_PROBS), **dict.fromkeys(event, event_probs)}
    out = attach_row(features, quantile_arrays(features, probs), "_q")
    graded = out.select("user_id", *[
        grading.band_score(F.col(c), F.col(f"_q.{c}"), bands, mode).alias(c) for c in (*detail, *event)])
    blended = graded.select(
        "user_id", *[F.col(c).alias(f"{c}_score") for c in extra],
        *[grading.blend(F.col(d), F.col(f"{d}_event"), share).alias(f"{d}_score") for d in DIMENSIONS])
    return total_score(blended, kind, cap)


def total_score(scores: DataFrame, kind: str, cap: float | None = 95.0) -> DataFrame:
    tree = taxi_tree() if kind == "taxi" else bus_tree()
    parts = [F.col(f"{d}_score") for d in DIMENSIONS]
    if kind == "taxi":
        parts.append(F.col("mileage_score"))
    return scores.withColumn("comprehensive_score", grading.composite(parts, tree["total"], cap))


def blend_scores(detail: DataFrame, event: DataFrame, share: float = 0.7) -> DataFrame:
    """Join detail and event scores kept as separate tables and blend them."""
    events = event.select("user_id", *[F.col(d).alias(f"_{d}") for d in DIMENSIONS])
    return detail.join(events, "user_id").select(
        *[c for c in detail.columns if c not in DIMENSIONS],
        *[grading.blend(F.col(d), F.col(f"_{d}"), share).alias(f"{d}_score") for d in DIMENSIONS])
