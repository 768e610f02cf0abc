"""The query catalogue: one callable per operator or job."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import grading, motion, text
from ..functions.envelope import VARIANTS, mileage_limits
from ..operators import accidents as acc
from ..operators import cells, driver_sigma, episodes, marks, ranks, scores, thresholds, trips, weights
from ..operators.pairs import BUS, TAXI, PairRule, add_motion, every_pair, pair_fixes
from ..operators.presets import PRESETS
from ..operators.slices import attach_row
from ..functions.registry import register_sql_functions
from ..session import checkpoint_dir, materialise
from ..sources import celltable, files, jdbc, records, snapshots
from ..sources.detail import detail_cells
from ..streaming import detectors
from ..streaming.jobs import alarm_tips
from ..streaming.summaries import NAMES
from . import streams
from .fixture import table, telemetry
from .inputs import accidents as accident_rows
from .inputs import bus_inputs, free_pairs, order_cells, over_code, taxi_inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the doubles, so that the last bits of engine-specific arithmetic
    do not count, and turn negative zero into zero."""
    return df.select(*[
        (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
        if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema.fields])


# --- pairing -----------------------------------------------------------------

PAIR = ["jsy", "event_id", "pretime", "longtime", "time_interval", "prelon", "prelat", "llon", "llat",
        "prespeed", "lspeed", "preorien", "orientation"]
MOTION = ["jsy", "event_id", "a_speed", "avg_speed", "orient", "angle_speed", "actual_dist", "avg_dist", "gap"]
MARKED = ["jsy", "event_id", "longtime", "a_speed", "orient", "gap", "rapid_mark"]


def bus_motion(spark, sf_dir, rule=BUS, carry=(), previous=(), **kwargs):
    pairs = pair_fixes(telemetry(spark, sf_dir), rule, carry=carry, previous=previous)
    return add_motion(pairs, rule.full_circle, **kwargs)


@query
def pairs_bus(spark, sf_dir):
    return tidy(pair_fixes(telemetry(spark, sf_dir)).select(*PAIR))


@query
def pairs_taxi(spark, sf_dir):
    return tidy(pair_fixes(telemetry(spark, sf_dir), TAXI).select("dbuscard", *PAIR))


@query
def pairs_prefilter(spark, sf_dir):
    rule = PairRule(min_gap=0, speed_before=80.0, speed_after=None)
    return tidy(pair_fixes(telemetry(spark, sf_dir), rule).select(*PAIR))


@query
def pairs_strict(spark, sf_dir):
    rule = PairRule(speed_after=80.0, strict=True)
    return tidy(pair_fixes(telemetry(spark, sf_dir), rule).select(*PAIR))


@query
def kinematics(spark, sf_dir):
    return tidy(bus_motion(spark, sf_dir).select(*MOTION, "up_min", "up_max", "dn_min", "dn_max"))


@query
def theoretic_distance(spark, sf_dir):
    pairs = pair_fixes(telemetry(spark, sf_dir))
    columns = []
    for variant in VARIANTS:
        b = mileage_limits(F.col("v0_kmh"), F.col("v1_kmh"), F.col("time_interval").cast("double"), variant)
        columns += [b.up_min.alias(f"{variant}_up_min"), b.up_max.alias(f"{variant}_up_max"),
                    b.dn_min.alias(f"{variant}_dn_min"), b.dn_max.alias(f"{variant}_dn_max")]
    return tidy(pairs.select("jsy", "event_id", *columns))


@query
def distance_variants(spark, sf_dir):
    ends = [F.col(c) for c in ("prelon", "prelat", "llon", "llat")]
    return tidy(pair_fixes(telemetry(spark, sf_dir)).select(
        "jsy", "event_id", motion.distance_m(*ends).alias("reference_m"),
        motion.distance_m(*ends, variant="haversine").alias("haversine_m")))


@query
def crossing_pairs(spark, sf_dir):
    """Crossing and turn flag of a pair: the earlier fix's, else the later's."""
    pairs = pair_fixes(telemetry(spark, sf_dir), carry=["roadcross", "isturn"], previous=["roadcross", "isturn"])
    flag = (F.when(F.col("preisturn") > 0, F.col("preisturn"))
            .when(F.col("isturn") > 0, F.col("isturn")).otherwise(F.lit(0)))
    return pairs.select("jsy", "event_id", F.coalesce("preroadcross", "roadcross").alias("iscross"),
                        flag.alias("turn_flag"))


@query
def speed_gap(spark, sf_dir):
    m = thresholds.add_published_motion(pair_fixes(telemetry(spark, sf_dir)))
    return tidy(m.select("jsy", "event_id", "aspeed", "turn", "aturn", "tnspeed", "distance", "speedgap"))


# --- thresholds --------------------------------------------------------------

@query
def fences_global(spark, sf_dir):
    return tidy(thresholds.global_limits(materialise(bus_motion(spark, sf_dir).select("a_speed", "gap"), "gaps")))


def _stat_pairs(spark, sf_dir, speed):
    """Consecutive fixes below the speed limit, at any distance in time."""
    return thresholds.add_published_motion(every_pair(telemetry(spark, sf_dir), speed_before=speed))


def _third_fixes(spark, sf_dir, below=None, gaps=None, carry=()):
    """Pairs of fixes that have two others before them, as the stateful rules see them."""
    pairs = every_pair(telemetry(spark, sf_dir), earlier=2, carry=carry)
    if gaps is not None:
        pairs = pairs.where(F.col("time_interval").between(*gaps))
    return pairs if below is None else pairs.where(F.col("v1_kmh") < F.lit(below))


@query
def stats_updn_turn(spark, sf_dir):
    return tidy(thresholds.published_stats(_stat_pairs(spark, sf_dir, 120.0)))


@query
def stats_full(spark, sf_dir):
    return tidy(thresholds.published_stats(_stat_pairs(spark, sf_dir, 80.0), mode="full"))


@query
def stats_moments(spark, sf_dir):
    return tidy(thresholds.published_stats(_stat_pairs(spark, sf_dir, 80.0), mode="moments"))


@query
def stats_sliding(spark, sf_dir):
    """Statistics per sliding window of 120 minutes every 30, pairs inside each window."""
    from ..streaming.statistics import sliding_pairs
    pairs = thresholds.add_published_motion(sliding_pairs(telemetry(spark, sf_dir), 7200, 1800))
    counts = (telemetry(spark, sf_dir)
              .select(F.explode(_windows()).alias("window_start")).groupBy("window_start")
              .agg(F.count(F.lit(1)).alias("cnt")))
    return tidy(thresholds.published_stats(pairs, by=["window_start"]).join(counts, "window_start"))


def _windows(length: int = 7200, slide: int = 1800):
    from ..streaming.statistics import window_starts
    return window_starts("longtime", length, slide)


@query
def turn_threshold(spark, sf_dir):
    rule = PairRule(min_gap=18, max_gap=22, speed_before=120.0, speed_after=None,
                    heading="carheadangle", full_circle=8.0)
    return tidy(thresholds.turn_limits(bus_motion(spark, sf_dir, rule)))


@query
def driver_speedgap(spark, sf_dir):
    rule = PairRule(min_gap=0, speed_before=120.0, speed_after=None)
    return tidy(thresholds.driver_speed_gaps(pair_fixes(telemetry(spark, sf_dir), rule)))


@query
def driver_limits(spark, sf_dir):
    return tidy(thresholds.driver_limits(bus_motion(spark, sf_dir), "a_speed", 3.0, "a"))


@query
def quantiles(spark, sf_dir):
    """Exact quantiles of whole columns."""
    m = materialise(bus_motion(spark, sf_dir).select("a_speed", "gap", "orient"), "motion")
    return tidy(ranks.exact_quantiles(m, dict.fromkeys(["a_speed", "gap", "orient"], grading.DETAIL_PROBS)))


# --- marks -------------------------------------------------------------------

def _preset_marks(spark, sf_dir, name, rule=BUS):
    p = PRESETS[name]
    m = bus_motion(spark, sf_dir, rule, limits=p.limits, limits_read=p.limits_read)
    return tidy(marks.learn_and_mark(m, p).select(*MARKED))


@query
def marks_bus_jr(spark, sf_dir):
    return _preset_marks(spark, sf_dir, "bus_jr_offline")


@query
def marks_bus_stat(spark, sf_dir):
    return _preset_marks(spark, sf_dir, "bus_jr_stat")


@query
def marks_bus_pd(spark, sf_dir):
    return _preset_marks(spark, sf_dir, "bus_pd_offline")


@query
def marks_taxi_dz(spark, sf_dir):
    return _preset_marks(spark, sf_dir, "taxi_dz_offline", TAXI)


@query
def marks_gap_band(spark, sf_dir):
    m = bus_motion(spark, sf_dir, limits="ramp", limits_read="kmh")
    return tidy(marks.gap_band_mark(m, 0.885, -0.878).select(*MARKED))


def _preset_motion(spark, sf_dir, name, below=None, carry=()):
    """Marked pairs of a preset with fixed limits, with all motion columns."""
    p = PRESETS[name]
    m = add_motion(_third_fixes(spark, sf_dir, below, (p.least_gap, 60), carry), limits=p.limits, limits_read=p.limits_read)
    return marks.with_marks(m, marks.band_mark(marks.batch_limits(p), p.straight, p.turn_first))


def _fixed_marks(spark, sf_dir, name, below=None):
    return tidy(_preset_motion(spark, sf_dir, name, below).select(*MARKED))


def _detail_marks(spark, sf_dir):
    """Marks of the bus detail detector, whose alarms and cells are written."""
    return _preset_motion(spark, sf_dir, "bus_detail_stream", 80.0, ("dbuscard",))


@query
def marks_bus_detail(spark, sf_dir):
    return _fixed_marks(spark, sf_dir, "bus_detail_stream", 80.0)


@query
def marks_bus_event(spark, sf_dir):
    return _fixed_marks(spark, sf_dir, "bus_event_stream")


@query
def marks_taxi_detail_old(spark, sf_dir):
    return _fixed_marks(spark, sf_dir, "taxi_detail_bk", 120.0)


@query
def marks_taxi_event_old(spark, sf_dir):
    return _fixed_marks(spark, sf_dir, "taxi_event_bk", 120.0)


@query
def marks_bus_event_old(spark, sf_dir):
    return _fixed_marks(spark, sf_dir, "bus_event_bk")


@query
def marks_taxi_learned(spark, sf_dir):
    """Stream order of the rules with limits from the published statistics."""
    stats = thresholds.published_stats(_stat_pairs(spark, sf_dir, 120.0))
    m = add_motion(_third_fixes(spark, sf_dir, 120.0, (5, 60)), limits="ramp")
    mark = marks.band_mark(marks.published_limits("stats"), straight=30.0, turn_first=False)
    return tidy(marks.with_marks(attach_row(m, stats, "stats"), mark).select(*MARKED))


@query
def marks_simple(spark, sf_dir):
    return tidy(marks.with_marks(add_motion(_third_fixes(spark, sf_dir)), marks.simple_mark()).select(*MARKED))


@query
def marks_or_rule(spark, sf_dir):
    stats = thresholds.published_stats(_stat_pairs(spark, sf_dir, 80.0), mode="moments")
    m = attach_row(add_motion(_third_fixes(spark, sf_dir)), stats, "stats")
    return tidy(marks.with_marks(m, marks.either_mark("stats")).select(*MARKED))


@query
def marks_iqr_rule(spark, sf_dir):
    stats = thresholds.published_stats(_stat_pairs(spark, sf_dir, 80.0), mode="full")
    m = add_motion(thresholds.add_published_motion(_third_fixes(spark, sf_dir)))
    mark = marks.fence_mark("stats")
    return tidy(marks.with_marks(attach_row(m, stats, "stats"), mark).select(*MARKED))


@query
def marks_brief(spark, sf_dir):
    """The quantile preset where the pair before was at most 20 s."""
    from ..operators.pairs import neighbours
    rows = neighbours(telemetry(spark, sf_dir), ["jsy"], ["longtime", "speed", "orientation", "llon", "llat"], back=2)
    pairs = rows.where("p2 IS NOT NULL AND p1.longtime - p2.longtime <= 20").select(
        "jsy", "event_id", "longtime", F.col("p1.llon").alias("prelon"), F.col("p1.llat").alias("prelat"),
        "llon", "llat", motion.metres_per_second(F.col("p1.speed")).alias("prespeed"),
        motion.metres_per_second(F.col("speed")).alias("lspeed"),
        F.col("p1.orientation").alias("preorien"), "orientation",
        (F.col("longtime") - F.col("p1.longtime")).alias("time_interval"))
    return tidy(marks.with_marks(add_motion(pairs), marks.brief_mark(PRESETS["quantile_event_bk"])).select(*MARKED))


@query
def mark_dedup(spark, sf_dir):
    m = marks.with_marks(free_pairs(spark, sf_dir), marks.simple_mark())
    return marks.drop_repeats(m).select("jsy", "event_id", "longtime", "rapid_mark")


# --- limits per driver -------------------------------------------------------

def _sigma_detail(spark, sf_dir, rule):
    return driver_sigma.with_neighbours(driver_sigma.survivors(telemetry(spark, sf_dir), rule), rule)


SIGMA = driver_sigma.SigmaRule(k=1.5)


@query
def accel_smoothed(spark, sf_dir):
    rule = driver_sigma.SigmaRule(smooth=True)
    return tidy(_sigma_detail(spark, sf_dir, rule).select("jsy", "event_id", "a_speed", "avg_speed", "orient", "angle_speed"))


@query
def marks_driver_sigma(spark, sf_dir):
    found = driver_sigma.speed_marks(_sigma_detail(spark, sf_dir, SIGMA), SIGMA)
    return tidy(found.select("jsy", "event_id", "longtime", "a_speed", "a_hi", "a_lo", "rapid_mark"))


@query
def crossing_match(spark, sf_dir):
    found = driver_sigma.turn_marks(_sigma_detail(spark, sf_dir, SIGMA), SIGMA)
    return tidy(found.select("jsy", "event_id", "longtime", "iscross", "avg_speed", "angle_speed",
                             "v_limit", "g_limit", "angle_mark"))


@query
def rapid_turn_outer(spark, sf_dir):
    fixes = telemetry(spark, sf_dir).withColumns({
        "flag": F.expr("cast(event_id % 2 AS string)"), "direcflag": F.expr("cast(event_id % 3 AS int)")})
    return tidy(driver_sigma.detect(fixes, SIGMA, carry=["flag", "direcflag"])
                .withColumnRenamed("direcflag", "direct_flag"))


# --- counts, events, alarms --------------------------------------------------

def simple_marks(spark, sf_dir, carry=()):
    return marks.with_marks(free_pairs(spark, sf_dir, carry), marks.simple_mark())


@query
def mark_counts(spark, sf_dir):
    return episodes.mark_counts(simple_marks(spark, sf_dir))


@query
def mark_counts_eh(spark, sf_dir):
    return episodes.mark_counts(simple_marks(spark, sf_dir, ("ehstatus",)), ["jsy", "ehstatus"], "eh_")


@query
def event_counts(spark, sf_dir):
    return episodes.event_counts(simple_marks(spark, sf_dir))


@query
def mark_times(spark, sf_dir):
    listed = episodes.mark_times(simple_marks(spark, sf_dir))
    return listed.select("jsy", "rapid_mark", "part", F.array_join("times", ",").alias("times"),
                         F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("marks"))


@query
def alarms_2nd(spark, sf_dir):
    return episodes.fired(simple_marks(spark, sf_dir), rule=episodes.ALARM_2ND)


@query
def alarms_3rd(spark, sf_dir):
    return episodes.fired(simple_marks(spark, sf_dir), rule=episodes.ALARM_3RD)


@query
def alarms_sliding(spark, sf_dir):
    return episodes.fired(simple_marks(spark, sf_dir), rule=episodes.ALARM_SLIDING)


@query
def alarm_texts(spark, sf_dir):
    m = _detail_marks(spark, sf_dir)
    tip = alarm_tips(PRESETS["bus_detail_stream"])
    return m.select("jsy", "event_id", text.scatter_key(F.col("jsy"), F.col("longtime")).alias("rowkey"),
                    text.time_text(F.col("pretime")).alias("start_time"),
                    text.time_text(F.col("longtime")).alias("end_time"), tip.alias("tips"))


# --- trips -------------------------------------------------------------------

def _trips(spark, sf_dir, ends=None, codes=trips.TAXI_OVER_CODES):
    return trips.split_trips(trips.step_marks(telemetry(spark, sf_dir)), ends=ends,
                             over=over_code(codes), over_codes=codes)


@query
def step_marks(spark, sf_dir):
    rows = trips.step_marks(telemetry(spark, sf_dir)).where("raw_mark IS NOT NULL")
    return tidy(rows.select("jsy", "event_id", "raw_mark", "mark", "average", "pre_average"))


@query
def trips_any(spark, sf_dir):
    return _trips(spark, sf_dir).drop("trip_no")


@query
def trips_bus(spark, sf_dir):
    return _trips(spark, sf_dir, trips.BUS_ENDS, trips.BUS_OVER_CODES).drop("trip_no")


@query
def trip_mark_lists(spark, sf_dir):
    listed = trips.trip_mark_lists(trips.step_marks(telemetry(spark, sf_dir)))
    return listed.select("jsy", "begin_time", "end_time", "marks", text.sorted_codes(F.col("marks")).alias("sorted_marks"),
                         *[text.count_code(F.col("marks"), c).alias(f"n{c}") for c in "123"])


@query
def trip_scores(spark, sf_dir):
    return tidy(trips.score_trips(_trips(spark, sf_dir)).select(
        "jsy", "begin_time", "end_time", "score", "minutes"), 4)


@query
def trip_scores_bus(spark, sf_dir):
    t = _trips(spark, sf_dir, trips.BUS_ENDS, trips.BUS_OVER_CODES)
    return tidy(trips.score_trips(t, "bus").select("jsy", "begin_time", "end_time", "score", "minutes"), 4)


@query
def running_score(spark, sf_dir):
    scored = trips.score_trips(_trips(spark, sf_dir))
    return trips.running_score(scored).select("jsy", "end_time", F.round("score", 2).alias("score"), "running")


@query
def status_rendezvous(spark, sf_dir):
    """Trips confirmed by both status streams, scored once; messages repeat."""
    t = _trips(spark, sf_dir)
    key = ["jsy", "begin_time", "end_time"]
    over = t.select(*key, *[f"over{i}" for i in range(4)])
    rapid = t.where("accelerations + brakings + turns > 3").select(*key, "accelerations", "brakings", "turns", "seconds")
    met = trips.meet_statuses(over.unionByName(over.where("over0 > 0")), rapid)
    return tidy(trips.score_trips(met).select(*key, "score"), 4)


# --- driver scores -----------------------------------------------------------

@query
def ahp_weights(spark, sf_dir):
    """Weights from one judgement matrix per supplier: shares of the return flags."""
    line = table(spark, sf_dir, "lineitem")
    q = line.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    a = q.select(F.col("l_suppkey").alias("matrix_id"), F.col("l_returnflag").alias("i"), F.col("q").alias("qi"))
    b = q.select(F.col("l_suppkey").alias("matrix_id"), F.col("l_returnflag").alias("j"), F.col("q").alias("qj"))
    matrices = a.join(b, "matrix_id").select("matrix_id", "i", "j", (F.col("qi") / (F.col("qi") + F.col("qj"))).alias("v"))
    return tidy(weights.matrix_weights(matrices))


@query
def features_bus(spark, sf_dir):
    return tidy(scores.bus_features(bus_inputs(spark, sf_dir)))


@query
def features_taxi(spark, sf_dir):
    return tidy(scores.taxi_features(taxi_inputs(spark, sf_dir), min_km=5.0))


def _bus_scores(spark, sf_dir):
    return scores.score_drivers(scores.bus_features(bus_inputs(spark, sf_dir)), "bus")


@query
def scores_bus(spark, sf_dir):
    return tidy(_bus_scores(spark, sf_dir), 4)


@query
def scores_bus_plain(spark, sf_dir):
    """Older cut points, no cap on a perfect score, interpolation inside bands."""
    f = scores.bus_features(bus_inputs(spark, sf_dir))
    return tidy(scores.score_drivers(f, "bus", grading.BANDS_OLD, "interpolated", cap=None), 4)


@query
def scores_taxi(spark, sf_dir):
    f = scores.taxi_features(taxi_inputs(spark, sf_dir), min_km=5.0)
    return tidy(scores.score_drivers(f, "taxi"), 4)


# --- accidents ---------------------------------------------------------------

def _driver_scores(spark, sf_dir):
    """A score per driver that spreads over all bins: the mean trip score stretched."""
    scored = trips.score_trips(_trips(spark, sf_dir))
    return scored.groupBy("jsy").agg(
        F.round((F.avg("score") - 90) * 10 + F.lit(1e-9), 2).alias("comprehensive_score"))


@query
def score_hist(spark, sf_dir):
    return acc.histogram(_driver_scores(spark, sf_dir), "comprehensive_score", "score_count")


@query
def accident_scores(spark, sf_dir):
    return acc.scores_with_accidents(_driver_scores(spark, sf_dir), accident_rows(spark, sf_dir))


@query
def accident_rate(spark, sf_dir):
    return tidy(acc.accident_rate(_driver_scores(spark, sf_dir), accident_rows(spark, sf_dir), "comprehensive_score"))


# --- cells -------------------------------------------------------------------

WANTED = {"o": ["price", "status"], "m": ["priority"]}


def _flat(nested: DataFrame, columns=WANTED) -> DataFrame:
    return nested.select("rowkey", *[
        F.col("families")[f][c].alias(f"{f}_{c}") for f, cs in columns.items() for c in cs])


@query
def cells_put(spark, sf_dir):
    return order_cells(spark, sf_dir)


@query
def cells_read(spark, sf_dir):
    return _flat(cells.read_columns(order_cells(spark, sf_dir), WANTED))


@query
def cells_read_ts(spark, sf_dir):
    nested = cells.read_columns(order_cells(spark, sf_dir), {"o": ["price"]}, versions=True)
    price = F.col("families")["o"]["price"]
    return nested.select("rowkey", price["value"].alias("price"), price["version"].alias("version"))


@query
def cells_families(spark, sf_dir):
    """Whole families nested per row key, shown as columns with the version of every cell."""
    whole = {"o": ["price", "status"], "m": ["date", "priority"]}
    nested = cells.nest(cells.read_families(order_cells(spark, sf_dir), list(whole)), versions=True)
    found = {f"{f}_{c}": F.col("families")[f][c] for f, cs in whole.items() for c in cs}
    return nested.select("rowkey", *[cell["value"].alias(name) for name, cell in found.items()],
                         *[cell["version"].alias(f"{name}_version") for name, cell in found.items()])


@query
def cells_where(spark, sf_dir):
    """Row-range scan with a value filter, un-nested."""
    return order_cells(spark, sf_dir).where("rowkey >= '3' AND rowkey < '6' AND qualifier = 'status' AND value = 'F'")


@query
def cells_get(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").where("l_quantity = 50").select(
        F.reverse(F.col("l_orderkey").cast("string")).alias("rowkey"))
    return cells.latest(cells.get_rows(order_cells(spark, sf_dir), keys))


def _gone(spark, sf_dir, condition):
    return table(spark, sf_dir, "orders").where(condition).select(
        F.reverse(F.col("o_orderkey").cast("string")).alias("rowkey"), "o_orderkey")


@query
def cells_delete(spark, sf_dir):
    """Rows, families, columns, listed columns and single versions, all at once."""
    listed = cells.listed_columns(
        _gone(spark, sf_dir, "o_orderkey % 13 = 0").withColumn(
            "columns", F.array(F.lit("date"), F.lit("priority"))), family="m")
    versions = _gone(spark, sf_dir, "o_orderkey % 9 = 0").select(
        "rowkey", F.lit("o").alias("family"), F.lit("price").alias("qualifier"),
        (F.col("o_orderkey") + 1_000_000_000).alias("version"))
    return cells.delete_marked(order_cells(spark, sf_dir), cells.union_cells(
        cells.row_markers(_gone(spark, sf_dir, "o_orderkey % 11 = 0")),
        cells.family_markers(_gone(spark, sf_dir, "o_orderkey % 7 = 0"), ["m"]),
        cells.column_markers(_gone(spark, sf_dir, "o_orderkey % 5 = 0"), {"o": ["status"]}),
        cells.listed_markers(listed), cells.listed_markers(versions)))


@query
def cells_delete_listed(spark, sf_dir):
    """Listed cells, some in one version and some in all, by the whole cell key."""
    o = _gone(spark, sf_dir, "o_orderkey % 3 = 0")
    gone = o.select("rowkey", F.lit("o").alias("family"), F.lit("price").alias("qualifier"),
                    F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END").alias("version"))
    return cells.delete_listed(order_cells(spark, sf_dir), gone)


@query
def cells_bulk_load(spark, sf_dir):
    """All cells written in key order, and a range of keys of one family read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/roadpulse/cells-{uuid.uuid4().hex}"
    celltable.bulk_load(order_cells(spark, sf_dir), path)
    return celltable.read_range(spark, path, "o", "3", "6")


@query
def cells_splits(spark, sf_dir):
    return ranks.split_keys(order_cells(spark, sf_dir).select("rowkey"), "rowkey", 8)


@query
def cells_regions(spark, sf_dir):
    """How evenly the split keys cut the cells."""
    c = order_cells(spark, sf_dir)
    placed = cells.with_range(c, ranks.split_keys(c.select("rowkey"), "rowkey", 8))
    return placed.groupBy("region").agg(F.count(F.lit(1)).alias("cells"), F.min("rowkey").alias("first_key"),
                                        F.max("rowkey").alias("last_key"))


@query
def mark_detail_cells(spark, sf_dir):
    return detail_cells(_detail_marks(spark, sf_dir))


# --- records and snapshots ---------------------------------------------------

@query
def wire_round_trip(spark, sf_dir):
    """Telemetry written as wire records and parsed back."""
    lines = records.format_records(telemetry(spark, sf_dir), records.L_EVENT)
    back = records.parse_records(lines, records.L_EVENT)
    return tidy(back.select("jsy", "dbuscard", "longtime", "speed", "llon", "llat", "orientation"))


@query
def raw_text_parse(spark, sf_dir):
    """Header-less text lines to fixes; the time text becomes epoch seconds."""
    t = telemetry(spark, sf_dir)
    lines = t.select(F.concat_ws(
        ",", F.col("event_id").cast("string"), "jsy", text.time_text(F.col("longtime")), F.col("llon").cast("string"),
        F.col("llat").cast("string"), F.col("speed").cast("string"), F.col("orientation").cast("string")).alias("value"))
    return tidy(records.parse_raw_text(lines).select("jsy", "longtime", "llon", "llat", "speed", "orientation"))


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/roadpulse/{name}-{uuid.uuid4().hex}"


@query
def raw_text_files(spark, sf_dir):
    """A header-less text export, written and read."""
    path = _scratch(spark, "export")
    t = telemetry(spark, sf_dir)
    t.select(F.concat_ws(",", F.col("event_id").cast("string"), "jsy", text.time_text(F.col("longtime")),
                         *[F.col(c).cast("string") for c in ("llon", "llat", "speed")],
                         F.concat(F.col("orientation").cast("string"), F.lit("]"))).alias("value")).write.text(path)
    return tidy(files.read_raw_text(spark, path).select("jsy", "longtime", "llon", "llat", "speed", "orientation"))


@query
def csv_append(spark, sf_dir):
    """Limits per driver, appended to one CSV table by two runs."""
    path = _scratch(spark, "limits")
    found = materialise(thresholds.driver_limits(bus_motion(spark, sf_dir), "a_speed", 3.0, "a"), "limits")
    for part in (0, 1):
        files.write_csv(found.where(F.pmod(F.hash("jsy"), F.lit(2)) == part), path, mode="append")
    return tidy(files.read_table(spark, path, "jsy string, avg_a double, std_a double, a_hi double, a_lo double"))


@query
def mark_messages(spark, sf_dir):
    """Records of all classified steps; of the four times only their number and order are fixed."""
    sent = records.mark_message(trips.step_marks(telemetry(spark, sf_dir)))
    parts = F.split("value", ",")
    times = F.transform(F.slice(parts, 12, 4), lambda t: t.cast("bigint"))
    return sent.select("key", F.substring_index("value", ",", 11).alias("record"), F.size(parts).alias("fields"),
                       (times == F.array_sort(times)).alias("in_order"))


@query
def bus_mark_messages(spark, sf_dir):
    """Records of all classified pairs of the OR rule, marked or not."""
    stats = thresholds.published_stats(_stat_pairs(spark, sf_dir, 80.0), mode="moments")
    m = attach_row(add_motion(_third_fixes(spark, sf_dir, carry=("dbuscard",))), stats, "stats")
    return records.bus_mark_message(marks.with_marks(m, marks.either_mark("stats"), keep_zero=True))


@query
def ride_status(spark, sf_dir):
    """Trip messages written as ``driver_begin_end`` and parsed back."""
    sent = records.status_message(_trips(spark, sf_dir))
    return records.parse_status(sent)


@query
def json_snapshot(spark, sf_dir):
    """Statistics through their JSON form and back."""
    stats = thresholds.published_stats(_stat_pairs(spark, sf_dir, 120.0))
    packed = snapshots.pack(stats)
    back = snapshots.unpack(packed, stats.columns)
    return tidy(back.select("avg_upaspeed", "std_upaspeed", "iqr_updist", "iqr_dnaspeed", "avg_turn", "std_aturn"))


@query
def published_snapshot(spark, sf_dir):
    """All statistics with the count behind them, published twice; the newest is read."""
    stats = materialise(thresholds.published_stats(_stat_pairs(spark, sf_dir, 120.0)), "stats")
    stamped = snapshots.stamp(stats, telemetry(spark, sf_dir).where("speed <= 120"))
    path = _scratch(spark, "snapshots")
    snapshots.publish(snapshots.pack_named(stamped.withColumn("avg_turn", F.lit(0.0)), stats.columns[:7]), path, 1)
    snapshots.publish(snapshots.pack(stamped), path, 2)
    return tidy(snapshots.read_latest(spark, path, stamped.columns)
                .withColumns({"time": F.col("time").isNotNull(), "cnt": F.col("cnt").cast("bigint")}))


@query
def csv_round_trip(spark, sf_dir):
    """Telemetry written as monthly header CSV and read back with its schema."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/roadpulse/csv-{uuid.uuid4().hex}"
    names = files.TAXI_MATCHED
    out = files.with_time_text(telemetry(spark, sf_dir))
    files.write_csv(files.by_month(out).select(*[F.col(a).alias(b) for a, b in names.items()], "month"),
                    path, partition_by=["month"])
    return tidy(files.read_csv(spark, path, names).withColumn("month", F.col("month").cast("string")))


@query
def alarm_rows(spark, sf_dir):
    m = _detail_marks(spark, sf_dir)
    return jdbc.alarm_rows(m.withColumn("tips", alarm_tips(PRESETS["bus_detail_stream"]))).drop("updatetime")


@query
def score_messages(spark, sf_dir):
    scored = trips.running_score(trips.score_trips(_trips(spark, sf_dir)))
    return records.score_message(scored)


@query
def trip_lookup(spark, sf_dir):
    """Stored counts of the trips that have any, next to every trip's status."""
    t = _trips(spark, sf_dir)
    counts = t.where("accelerations > 2")
    return detectors.lookup_counts(t.select("jsy", "begin_time", "end_time"), counts, ["accelerations", "turns"])


@query
def sql_functions(spark, sf_dir):
    """The distance functions under their SQL names."""
    register_sql_functions(spark)
    names = {"theroyDistUpMin": "up_min", "theroyDistUpMax": "up_max",
             "theroyDistDnMin": "dn_min", "theroyDistDnMax": "dn_max"}
    return tidy(pair_fixes(telemetry(spark, sf_dir)).selectExpr(
        "jsy", "event_id", "Dist(prelon, prelat, llon, llat) AS metres",
        *[f"{f}(v0_kmh, v1_kmh, time_interval) AS {a}" for f, a in names.items()]))


@query
def cells_put_forms(spark, sf_dir):
    """Cells from lists with headers, from nested maps and from versioned maps."""
    o = table(spark, sf_dir, "orders").withColumn("rowkey", F.reverse(F.col("o_orderkey").cast("string")))
    lists = cells.put_headers(o.withColumn("vals", F.array("o_orderstatus", "o_orderpriority")), "h",
                              ["status", "priority"], F.col("o_orderkey"))
    inner = F.create_map(F.lit("status"), F.col("o_orderstatus"))
    nested = cells.put_nested(o.withColumn("families", F.create_map(F.lit("n"), inner)), 5)
    pair = F.struct(F.col("o_orderpriority").alias("value"), F.col("o_custkey").alias("version"))
    versioned = cells.put_versioned(o.withColumn("cells", F.create_map(F.lit("priority"), pair)), "v")
    return cells.union_cells(lists, nested, versioned)


# --- streams -----------------------------------------------------------------

@query
def stream_steps(spark, sf_dir):
    return streams.steps(spark, sf_dir)


@query
def stream_scores(spark, sf_dir):
    return streams.scores(spark, sf_dir)


@query
def stream_alarms(spark, sf_dir):
    return streams.alarms(spark, sf_dir)


@query
def stream_simple(spark, sf_dir):
    """Marks from the second fix on."""
    return streams.simple_marks(spark, sf_dir)


@query
def stream_windows(spark, sf_dir):
    return tidy(streams.windows(spark, sf_dir))


@query
def stream_rendezvous_scores(spark, sf_dir):
    """Trips scored once both of their messages have come, some of them late, repeated or too late."""
    scored = streams.rendezvous_scores(_trips(spark, sf_dir)).drop("ts")
    return scored.withColumn("score", F.round("score", 2)).withColumn("minutes", F.round("minutes", 1))


@query
def stream_learned(spark, sf_dir):
    """Marks (0 for none) whose limits a second stream learns and publishes, and those limits."""
    return tidy(streams.learned(spark, sf_dir).select(*MARKED, *[F.col(f"stats.{n}") for n in NAMES]))


@query
def stream_fixed_detail(spark, sf_dir):
    return streams.fixed_detail(spark, sf_dir)[0].drop("updatetime")


@query
def stream_detail_cells(spark, sf_dir):
    """The cells that the same job writes."""
    return streams.fixed_detail(spark, sf_dir)[1]


@query
def stream_event_alarms(spark, sf_dir):
    return streams.event_alarms(spark, sf_dir).drop("updatetime")
