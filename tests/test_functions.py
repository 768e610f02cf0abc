import math

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import envelope, grading, motion, text
from roadpulse.functions.registry import register_sql_functions
from roadpulse.operators import weights


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_distance_variants(spark):
    a = [F.lit(x) for x in (119.40, 32.20, 119.41, 32.21)]
    row = one(spark, motion.distance_m(*a).alias("r"), motion.distance_m(*a, variant="haversine").alias("h"))
    half = math.radians(0.01) / 2
    shrink = math.cos(math.radians(32.20)) * math.cos(math.radians(32.21))
    true = 2 * math.asin(math.sqrt(math.sin(half) ** 2 * (1 + shrink))) * 6378137
    assert row.h == pytest.approx(true, rel=1e-9)
    assert row.r == pytest.approx(row.h, rel=1e-6)
    with pytest.raises(ValueError):
        motion.distance_m(*a, variant="flat")


@pytest.mark.parametrize("before,after,circle,want", [
    (350.0, 10.0, 360.0, 20.0), (10.0, 350.0, 360.0, 20.0), (0.0, 180.0, 360.0, 180.0),
    (7.0, 1.0, 8.0, 2.0), (1.0, 5.0, 8.0, 4.0)])
def test_heading_change(spark, before, after, circle, want):
    assert one(spark, motion.heading_change(F.lit(before), F.lit(after), circle).alias("x")).x == want


def ramp_limits(v0, v1, T):
    """Worked by hand: seconds at 2.78 m/s^2, at least two."""
    def area(a, b, t):
        return (a + b) / 2 * t

    up, dn = (v1 - v0) / 2.78, (v0 - v1) / 2.78
    out = []
    for t, kind in ((up, "up_min"), (up, "up_max"), (dn, "dn_min"), (dn, "dn_max")):
        if t <= 0:
            out.append(0.0)
        elif t >= 2:
            steady = v0 if kind in ("up_min", "dn_max") else v1
            out.append(area(v0, v1, t) + steady * (T - t))
        elif kind == "up_min":
            m = max(v1 - 5.56, 0)
            out.append(area(v0, m, T - 2) + area(m, v1, 2))
        elif kind == "up_max":
            out.append(area(v0, v0 + 5.56, 2) + area(v0 + 5.56, v1, T - 2))
        elif kind == "dn_min":
            m = max(v0 - 5.56, 0)
            out.append(area(v0, m, 2) + area(m, v1, T - 2))
        else:
            out.append(area(v0, v1 + 5.56, T - 2) + area(v1 + 5.56, v1, 2))
    return out


@pytest.mark.parametrize("v0,v1,T", [(36.0, 72.0, 10.0), (72.0, 36.0, 10.0), (36.0, 40.0, 8.0),
                                     (40.0, 36.0, 8.0), (3.0, 5.0, 6.0), (50.0, 50.0, 9.0)])
def test_ramp_limits(spark, v0, v1, T):
    b = envelope.mileage_limits(F.lit(v0), F.lit(v1), F.lit(T))
    row = one(spark, b.up_min.alias("a"), b.up_max.alias("b"), b.dn_min.alias("c"), b.dn_max.alias("d"))
    assert list(row) == pytest.approx(ramp_limits(v0 / 3.6, v1 / 3.6, T))


def test_truncated_and_steady_limits(spark):
    t = envelope.mileage_limits(F.lit(10.0), F.lit(12.0), F.lit(8.0), "truncated", "ms")
    row = one(spark, t.up_min, t.up_max, t.dn_min, t.dn_max)
    assert list(row) == pytest.approx([
        (10 + 6.44) / 2 * 6 + 6.44 * 2, 20 + (15.56 + 12) / 2 * 6,
        20 + (4.44 + 12) / 2 * 6, (10 + 17.56) / 2 * 6 + 17.56 * 2])
    s = envelope.mileage_limits(F.lit(10.0), F.lit(12.0), F.lit(8.0), "steady", "ms")
    assert list(one(spark, s.up_min, s.up_max, s.dn_min, s.dn_max)) == pytest.approx([82.0, 94.0, 96.0, 80.0])


def test_sql_functions_match_columns(spark):
    names = register_sql_functions(spark)
    assert names[0] == "Dist" and len(names) == 5
    pairs = spark.createDataFrame([(36.0, 72.0, 10.0), (40.0, 36.0, 8.0), (36.0, 40.0, 8.0), (72.0, 30.0, 9.0),
                                   (5.0, 5.0, 7.0)], "a double, b double, t double")
    b = envelope.mileage_limits(F.col("a"), F.col("b"), F.col("t"))
    for name, column in zip(names[1:], (b.up_min, b.up_max, b.dn_min, b.dn_max)):
        for x, y in pairs.select(F.expr(f"{name}(a, b, t)"), column).collect():
            assert x == pytest.approx(y)
    x, y = spark.range(1).select(
        F.expr("Dist(119.4D, 32.2D, 119.41D, 32.21D)"),
        motion.distance_m(F.lit(119.4), F.lit(32.2), F.lit(119.41), F.lit(32.21))).first()
    assert x == pytest.approx(y)
    plan = pairs.selectExpr("theroyDistUpMin(a, b, t) AS x")._jdf.queryExecution().executedPlan().toString()
    assert "theroyDist" not in plan and "Python" not in plan


def test_band_score(spark):
    q = F.array(*[F.lit(float(x)) for x in (1, 2, 3, 4, 5, 6, 7)])

    def score(x, **kw):
        return one(spark, grading.band_score(F.lit(float(x)), q, **kw).alias("s")).s

    assert score(0) == 100
    assert score(1.5) == pytest.approx(80 + 0.5 / (2 - 1 * 15))
    assert score(2) == pytest.approx(80)                      # the better interval wins on an edge
    assert score(6.5) == pytest.approx(35 + 0.5 / (7 - 6 * 15))
    assert score(1.5, mode="interpolated") == pytest.approx(80 + 0.5 * 15)
    flat = F.array(*[F.lit(15.0), F.lit(225.0), *[F.lit(300.0)] * 5])
    assert one(spark, grading.band_score(F.lit(20.0), flat).alias("s")).s is None   # zero denominator


def test_trip_score(spark):
    args = [F.lit(x) for x in (1, 2, 0, 1)]
    taxi = grading.trip_score(args, F.lit(3), F.lit(25), F.lit(1), F.lit(1800))
    bus = grading.trip_score(args, F.lit(3), F.lit(25), F.lit(1), F.lit(1800), "bus")
    row = one(spark, taxi.alias("t"), bus.alias("b"))
    penalty = int(1 + 3 + 2.5) + 3 + 20 + 1
    assert row.t == pytest.approx(math.sqrt(100 - penalty * (1 - math.tanh(0.5))) * 10)
    assert row.b == pytest.approx(math.sqrt((100 - penalty) * math.tanh(0.5)) * 10)


def test_weights(spark):
    # worked out by hand
    assert weights.small_weights(weights.OVER_VS_MARKS) == pytest.approx([0.65, 0.35])
    assert weights.small_weights(weights.OVER_KINDS) == pytest.approx([0.270833, 0.333333, 0.395833], abs=1e-6)
    assert weights.small_weights(weights.MARK_KINDS) == pytest.approx([0.383333, 0.333333, 0.283333], abs=1e-6)
    assert weights.small_weights(weights.PLACES) == pytest.approx([0.258333, 0.320833, 0.420833], abs=1e-6)
    assert weights.small_weights(weights.LEVELS_ABC) == pytest.approx([0.208333, 0.333333, 0.458333], abs=1e-6)
    assert weights.small_weights(weights.LEVELS_BC) == pytest.approx([0.3, 0.7])
    assert weights.small_weights(weights.OVER_MARKS_MILEAGE) == pytest.approx([0.433333, 0.345833, 0.220833], abs=1e-6)
    for tree in (weights.bus_tree(), weights.taxi_tree(), weights.bus_tree(True), weights.taxi_tree(True)):
        assert all(sum(w) == pytest.approx(1) for w in tree.values())
    long = [(m, i, j, v) for m, x in (("a", weights.PLACES), ("b", weights.OVER_VS_MARKS))
            for i, r in enumerate(x) for j, v in enumerate(r)]
    got = weights.matrix_weights(spark.createDataFrame(long, "matrix_id string, i int, j int, v double"))
    found = {(r.matrix_id, r.i): r.weight for r in got.collect()}
    for m, x in (("a", weights.PLACES), ("b", weights.OVER_VS_MARKS)):
        for i, w in enumerate(weights.small_weights(x)):
            assert found[m, i] == pytest.approx(w)


def test_text(spark):
    row = one(
        spark, text.epoch_seconds(F.lit("2019-01-01 00:00:01")).alias("s"),
        text.epoch_millis(F.lit("2019-01-01 00:00:01.250")).alias("ms"),
        text.time_text(F.lit(1546300801)).alias("t"), text.scatter_key(F.lit("7"), F.lit(1234)).alias("k"),
        text.fixed(F.lit(2.675), 2).alias("f"), text.count_code(F.lit("1:2:1:3"), "1").alias("n"),
        text.count_code(F.lit(None).cast("string"), "1").alias("none"),
        text.sorted_codes(F.lit("3:1:2")).alias("sorted"), text.canonical_mark(F.lit("5")).alias("five"),
        text.canonical_mark(F.lit("4")).alias("four"), text.sink_mark(F.lit(3), turn_code=5).alias("sink"),
        text.epoch_seconds(F.lit("nonsense")).alias("bad"))
    assert row.s == 1546300801 and row.ms == 1546300801250 and row.t == "2019-01-01 00:00:01"
    assert row.k == "7_4321" and row.f == "2.68" and row.n == 2 and row.none == 0 and row.sorted == "1:2:3"
    assert row.five == 3 and row.four == 1 and row.sink == 5 and row.bad is None


def test_alarm_text_needs_mileage(spark):
    rows = spark.createDataFrame([(1, 10.0), (1, 0.0), (2, 10.0), (3, 0.0), (0, 5.0)], "mark int, d double")
    args = [F.lit(x) for x in (0.6, 0.503, -0.5, 1.0, 2.0, 3.0, 4.0)]
    got = [r[0] for r in rows.select(text.alarm_text(F.col("mark"), *args, F.col("d"))).collect()]
    assert got[0] == "acceleration 0.60 (limit 0.503); normal mileage [1.00m - 2.00m]; actual mileage 10.00m"
    assert got[1] is None and "limit -0.500" in got[2] and got[3] == "hard turn" and got[4] is None
