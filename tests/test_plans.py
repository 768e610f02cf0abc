"""The plans: no Python, no cross products, one shuffle per layout, pruned scans."""

import re

import brute
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import episodes, marks, pairs, scores, thresholds, trips
from roadpulse.operators.presets import PRESETS
from roadpulse.plans.catalog import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_products(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for word in ("Python", "ArrowEval", "CartesianProduct", "NestedLoop"):
        assert word not in text
    # no window runs over a whole table in one task
    for spec in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert not re.match(r"\S+ (ASC|DESC)", spec), spec


@pytest.fixture(scope="module")
def stored(spark, fixes, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("t") / "telemetry")
    fixes.write.parquet(path)
    return spark.read.parquet(path)


def test_pairing_is_one_shuffle_and_one_window(stored):
    text = plan(pairs.add_motion(pairs.pair_fixes(stored)))
    assert text.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"^\W*Window ", text, re.M)) == 1
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert "wayname" not in schema and "ehstatus" not in schema and "roadcross" not in schema


def test_speed_filter_reaches_the_scan_only_where_it_may(stored):
    before = plan(pairs.pair_fixes(stored, pairs.PairRule(speed_before=80.0, speed_after=None)))
    after = plan(pairs.pair_fixes(stored))
    assert "LessThanOrEqual(speed,80.0)" in before
    assert "LessThanOrEqual(speed,80.0)" not in after


def test_counts_are_combined_before_the_shuffle(stored):
    m = marks.with_marks(pairs.add_motion(pairs.pair_fixes(stored)), marks.simple_mark())
    text = plan(episodes.mark_counts(m))
    assert "partial_count" in text and text.count("Exchange hashpartitioning") == 2


def test_marks_are_computed_once(stored):
    p = PRESETS["bus_detail_stream"]
    m = pairs.add_motion(pairs.pair_fixes(stored), limits="ramp")
    text = plan(marks.with_marks(m, marks.band_mark(marks.batch_limits(p), p.straight, p.turn_first)))
    filters = [line for line in text.splitlines() if re.match(r"^\W*(\*\(\d+\) )?Filter", line)]
    assert filters and not any("ASIN" in f for f in filters)


def test_hot_driver_is_spread(stored):
    """One driver with nearly all rows ends up in many shuffle groups."""
    hot = stored.withColumn("jsy", F.lit("one"))
    groups = pairs.pair_fixes(hot, pairs.PairRule(min_gap=0), width=70).select("slice").distinct().count()
    assert groups > 10
    blocks = pairs.neighbours(hot, ["jsy"], ["speed"], size=50).groupBy("block").count()
    assert blocks.count() >= 20 and blocks.agg(F.max("count")).first()[0] <= 50


def test_statistics_columns(stored):
    p = thresholds.add_published_motion(pairs.pair_fixes(stored))
    assert len(thresholds.published_stats(p).columns) == 55
    assert len(thresholds.published_stats(p, mode="full").columns) == 81
    assert len(thresholds.published_stats(p, mode="moments").columns) == 28
    sketched = thresholds.published_stats(p, sketch=10_000).first()
    exact = thresholds.published_stats(p).first()
    for c in ("approx25_upaspeed", "iqr_updist_max", "avg_turn"):
        assert sketched[c] == pytest.approx(exact[c], rel=1e-2)


def test_separate_score_tables_blend(spark):
    d = spark.createDataFrame([("a", 50.0, *[80.0] * 6)], "user_id string, mileage double, "
                              + ", ".join(f"{x} double" for x in scores.DIMENSIONS))
    e = spark.createDataFrame([("a", *[100.0] * 6), ("b", *[1.0] * 6)],
                              "user_id string, " + ", ".join(f"{x} double" for x in scores.DIMENSIONS))
    rows = scores.blend_scores(d, e).collect()
    assert len(rows) == 1 and rows[0].over_count_score == pytest.approx(86.0) and rows[0].mileage == 50.0


def test_perfect_score_is_capped(spark):
    row = spark.createDataFrame([("a", *[100.0] * 6)], "user_id string, "
                                + ", ".join(f"{x}_score double" for x in scores.DIMENSIONS))
    assert scores.total_score(row, "bus").first().comprehensive_score == pytest.approx(95.0)
    assert scores.total_score(row, "bus", cap=None).first().comprehensive_score == pytest.approx(100.0)


def test_mark_list_of_a_trip(stored):
    """One row per finished trip whatever the blocks; marks count from the last trip's end, as in one pass."""
    steps = trips.step_marks(stored)
    lists = trips.trip_mark_lists(steps)
    want = []
    rows = sorted(steps.select("jsy", "rank", "longtime", "mark", "ehstatus").collect(), key=lambda r: (r.jsy, r["rank"]))
    for (driver,), fixes in brute.by_key(rows, "jsy").items():
        codes, status, begin = [], None, None
        for f in fixes:
            if f.mark:
                codes.append(str(f.mark))
            if status is not None and f.ehstatus != status:
                want.append((driver, begin, f.longtime, ":".join(codes) or "0"))
                codes = []
            if f.ehstatus != status:
                status, begin = f.ehstatus, f.longtime
    assert sorted(map(tuple, lists.collect())) == sorted(want) and any(":" in w[3] for w in want)
    assert sorted(map(tuple, trips.trip_mark_lists(trips.step_marks(stored, size=3)).collect())) == sorted(want)
    found = trips.split_trips(steps).select("jsy", "begin_time", "end_time")
    assert found.exceptAll(lists.drop("marks")).count() == 0 == lists.drop("marks").exceptAll(found).count()


def test_equal_times_count_once(spark):
    rows = [("a", i, 100 + 10 * (i // 2), 30.0 + i, 0.0, 119.4, 32.2, "1") for i in range(8)]
    fixes = spark.createDataFrame(rows, "jsy string, event_id bigint, longtime bigint, speed double, "
                                        "orientation double, llon double, llat double, ehstatus string")
    got = trips.step_marks(fixes).select("event_id", "rank").collect()
    assert sorted((r.event_id, r["rank"]) for r in got) == [(0, 1), (2, 2), (4, 3), (6, 4)]
    times = episodes.mark_times(fixes.withColumn("rapid_mark", F.lit(1))).first()
    assert times.times == [100, 110, 120, 130] and times.counts == [2, 2, 2, 2]


def test_pairs_without_a_tie_column(stored):
    p = PRESETS["bus_jr_offline"]
    found = marks.learn_and_mark(pairs.add_motion(pairs.pair_fixes(stored, tie=())), p)
    assert found.count() == 83


def test_quartiles_of_a_window_are_exact(spark):
    """Windows with more values than a sketch keeps, and one without a turning pair."""
    n = 300_000
    pairs_ = spark.range(n).selectExpr(
        "cast(id % 3 AS bigint) AS window_start", "cast((id * 7919) % 300007 - 150000 AS double) / 7 AS aspeed",
        "cast((id * 104729) % 300007 AS double) / 3 AS distance", "CASE WHEN id % 3 < 2 THEN cast(id % 180 AS double) ELSE 0.0 END AS turn",
        "cast(id % 1000 AS double) AS aturn", "cast((id * 31) % 300007 AS double) AS tnspeed", "0.0 AS speedgap")
    got = {r.window_start: r for r in thresholds.published_stats(pairs_, by=["window_start"]).collect()}
    assert len(got) == 3 and got[2].approx25_tnspeed is None
    for w in range(3):
        ids = range(w, n, 3)
        gaps = sorted((i * 104729) % 300007 / 3 for i in ids if (i * 7919) % 300007 > 150000)
        assert [got[w].approx25_updist, got[w].median_updist, got[w].approx75_updist] == [
            gaps[max(-(-len(gaps) * k // 4), 1) - 1] for k in (1, 2, 3)]
