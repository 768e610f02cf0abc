"""Slices, blocks and chunks give what one pass over a driver's history gives."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from roadpulse.operators import episodes, marks, pairs, ranks, slices, trips
from roadpulse.operators.slices import with_rank


def random_fixes(spark, seed, drivers=4, rows=300, hot=3):
    """One driver has most of the rows; gaps run from seconds to days."""
    rnd = random.Random(seed)
    out, event = [], 0
    for d in range(drivers):
        t = 1_546_300_800
        for _ in range(rows * (hot if d == 0 else 1)):
            t += rnd.choice([3, 5, 8, 12, 30, 60, 61, 200, 700, rnd.choice([10, 90_000])])
            out.append((f"d_{d}", event, t, float(rnd.randint(0, 1200)) / 10, float(rnd.randint(0, 359)),
                        119.4 + rnd.random() / 100, 32.2 + rnd.random() / 100, str(rnd.randint(0, 3))))
            event += 1
    rnd.shuffle(out)
    return spark.createDataFrame(out, "jsy string, event_id bigint, longtime bigint, speed double, "
                                      "orientation double, llon double, llat double, ehstatus string")


@pytest.mark.parametrize("width", [100, 3600])
def test_pairs_match_one_pass(spark, width):
    fixes = random_fixes(spark, 1)
    got = {(r.jsy, r.event_id, r.pretime) for r in pairs.pair_fixes(fixes, width=width).collect()}
    want = set()
    for (d,), rows in brute.by_key(fixes.collect(), "jsy").items():
        rows.sort(key=lambda r: (r.longtime, r.event_id))
        for a, b in zip(rows, rows[1:]):
            if 5 <= b.longtime - a.longtime <= 60 and a.speed <= 80 and b.speed <= 80:
                want.add((d, b.event_id, a.longtime))
    assert got == want and want


def crowded_fixes(spark):
    """A driver with one hour of three fixes a second, one with a single time, a null one, and a few others."""
    rnd = random.Random(11)
    times = [("hour", 1_546_300_800 + rnd.randrange(3600)) for _ in range(1500)]
    times += [("once", 1_546_300_800)] * 600 + [("once", 1_546_300_800 + k) for k in (7, 7, 30, 95)]
    times += [(None, 1_546_300_800 + rnd.randrange(9000)) for _ in range(400)]
    times += [(f"d_{d}", 1_546_300_800 + 20 * k) for d in range(5) for k in range(30)]
    rows = [(d, n, t, float(rnd.randint(0, 1200)) / 10, 1.0, 119.4, 32.2) for n, (d, t) in enumerate(times)]
    return spark.createDataFrame(rows, "jsy string, event_id bigint, longtime bigint, speed double, orientation double, "
                                       "llon double, llat double").repartition(3)


def test_crowded_hours_give_the_same_pairs(spark, monkeypatch):
    fixes = crowded_fixes(spark)
    want, wide = pairs.pair_fixes(fixes), pairs.every_pair(fixes)
    monkeypatch.setattr(slices, "CROWD", 100)
    got, got_wide = pairs.pair_fixes(fixes), pairs.every_pair(fixes)
    assert got.columns == want.columns and got_wide.columns == wide.columns
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(got) == key(want) and {r.jsy for r in want.collect()} > {"hour", "once", None}
    assert key(got_wide) == key(wide)


def test_slices_cut_by_count_part_heavy_hours(spark):
    fixes = crowded_fixes(spark)
    assert slices.crowded(fixes, ["jsy"], F.expr("longtime div 3600"), 600)
    assert not slices.crowded(fixes, ["jsy"], F.expr("longtime div 3600"), 1500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = slices.cut_by_count(fixes, ["jsy"], ["longtime", "event_id"], "_slice")
        sizes = [r["count"] for r in cut.groupBy("jsy", "_slice").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == fixes.count() and max(sizes) < 1.5 * sum(sizes) / 4  # four ranges


@pytest.mark.parametrize("crowd", [5, 1_000_000])
def test_ranks_count_on_over_slices(spark, monkeypatch, crowd):
    monkeypatch.setattr(slices, "CROWD", crowd)
    got = with_rank(random_fixes(spark, 5), ["jsy"], ["longtime", "event_id"], F.expr("longtime div 3600")).collect()
    for (d,), rows in brute.by_key(got, "jsy").items():
        rows.sort(key=lambda r: (r.longtime, r.event_id))
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def test_prefilter_pairs_across_removed_fixes(spark):
    fixes = random_fixes(spark, 2)
    rule = pairs.PairRule(speed_before=80.0, speed_after=None)
    got = {(r.jsy, r.event_id, r.pretime) for r in pairs.pair_fixes(fixes, rule, width=90).collect()}
    want = set()
    for (d,), rows in brute.by_key(fixes.collect(), "jsy").items():
        rows = sorted((r for r in rows if r.speed <= 80), key=lambda r: (r.longtime, r.event_id))
        want |= {(d, b.event_id, a.longtime) for a, b in zip(rows, rows[1:]) if 5 <= b.longtime - a.longtime <= 60}
    assert got == want


@pytest.mark.parametrize("size", [3, 7, 10_000])
def test_neighbours_match_one_pass(spark, size):
    fixes = random_fixes(spark, 3)
    got = pairs.neighbours(fixes, ["jsy"], ["event_id"], back=2, ahead=1, size=size, rank_slice=1000).collect()
    found = {(r.jsy, r.event_id): (r["rank"], r.p1 and r.p1.event_id, r.p2 and r.p2.event_id, r.n1 and r.n1.event_id)
             for r in got}
    assert len(found) == len(got) == fixes.count()
    for (d,), rows in brute.by_key(fixes.collect(), "jsy").items():
        ids = [r.event_id for r in sorted(rows, key=lambda r: (r.longtime, r.event_id))]
        for i, e in enumerate(ids):
            assert found[d, e] == (i + 1, ids[i - 1] if i else None, ids[i - 2] if i > 1 else None,
                                   ids[i + 1] if i + 1 < len(ids) else None)


def test_rank_ignores_slicing(spark):
    fixes = random_fixes(spark, 4)
    a = with_rank(fixes, ["jsy"], ["longtime", "event_id"], F.expr("longtime div 50")).select("event_id", "rank")
    b = with_rank(fixes, ["jsy"], ["longtime", "event_id"], F.lit(0)).select("event_id", "rank")
    assert a.exceptAll(b).count() == 0


def random_marks(spark, seed, ties=False):
    rnd = random.Random(seed)
    out = []
    for d, n in (("hot_1", 1200), ("b", 150), ("c", 1), ("d", 2)):
        for m in (1, 2):
            t = 1_546_300_800 + rnd.randint(0, 500)
            for _ in range(n):
                step = rnd.choice([1, 20, 45, 60, 90, 179, 180, 181, 182, 400, 5000])
                t += step if not ties else rnd.choice([0, step])
                out.append((d, m, t, t - rnd.choice([5, 10, 60])))
    rnd.shuffle(out)
    return spark.createDataFrame(out, "jsy string, rapid_mark int, longtime bigint, pretime bigint")


@pytest.mark.parametrize("chunk", [150, 1000, 86_400])
@pytest.mark.parametrize("ties", [False, True])
def test_event_counts_match_one_pass(spark, chunk, ties):
    m = random_marks(spark, 5, ties)
    got = {(r.jsy, r.rapid_mark): r.cnt for r in episodes.count_events(m, chunk=chunk).collect()}
    want = {k: brute.count_events([r.longtime for r in rows])
            for k, rows in brute.by_key(m.collect(), "jsy", "rapid_mark").items()}
    assert got == want


@pytest.mark.parametrize("chunk", [170, 1000, 86_400])
@pytest.mark.parametrize("rule", [episodes.ALARM_2ND, episodes.ALARM_3RD, episodes.ALARM_SLIDING])
def test_alarms_match_one_pass(spark, chunk, rule):
    m = random_marks(spark, 6)
    got = sorted((r.jsy, r.rapid_mark, r.fired_at, r.opened, r.ends)
                 for r in episodes.fired(m, rule=rule, chunk=chunk).collect())
    want = []
    for k, rows in brute.by_key(m.collect(), "jsy", "rapid_mark").items():
        seq = sorted((r.longtime, r.pretime) for r in rows)
        want += [(*k, *f) for f in brute.alarms(seq, rule.fire_at, rule.slide)]
    assert got == sorted(want) and want


def test_published_example_rows(spark):
    rows = [("A", 1, 50), ("A", 1, 60), ("A", 1, 100), ("A", 1, 400), ("B", 2, 10), ("B", 2, 190), ("B", 2, 371)]
    m = spark.createDataFrame(rows, "jsy string, rapid_mark int, longtime bigint")
    got = {r.jsy: r.asDict() for r in episodes.event_counts(m).collect()}
    assert got["A"]["up_sudden_count"] == 4 and got["A"]["up_sudden_event"] == 1
    assert got["B"]["down_sudden_event"] == 1 and got["B"]["turn_sudden_event"] == 0


@pytest.mark.parametrize("size", [4, 50_000])
@pytest.mark.parametrize("ends", [None, trips.BUS_ENDS])
def test_trips_match_one_pass(spark, size, ends):
    fixes = random_fixes(spark, 7)
    steps = trips.step_marks(fixes, size=size)
    over = F.when(F.col("speed") > 60, "0")
    got = sorted((r.jsy, r.begin_time, r.end_time, r.accelerations, r.brakings, r.turns, r.over0)
                 for r in trips.split_trips(steps, ends=ends, over=over).collect())
    want = []
    for (d,), rows in brute.by_key(steps.collect(), "jsy").items():
        rows.sort(key=lambda r: r["rank"])
        seq = [{"t": r.longtime, "status": r.ehstatus, "mark": r.mark, "over": "0" if r.speed > 60 else None}
               for r in rows]
        want += [(d, *t) for t in brute.trips(seq, ends)]
    assert got == sorted(want) and want


def test_repeated_marks_are_silenced(spark):
    steps = trips.step_marks(random_fixes(spark, 8), size=5).collect()
    for rows in brute.by_key(steps, "jsy").values():
        rows.sort(key=lambda r: r["rank"])
        last = None
        for r in rows:
            if r["rank"] < 3:
                assert r.raw_mark is None and r.mark is None
                continue
            assert r.mark == (0 if r.raw_mark == last else r.raw_mark)
            last = r.raw_mark


@pytest.mark.parametrize("chunk", [50, 400, 5000, 10**7])
def test_running_score_matches_one_pass(spark, chunk):
    rnd = random.Random(9)
    rows = [(f"d{d}", 1000 + 10 * i, rnd.choice([100.0, 100.0, 0.0, 99.99, rnd.uniform(20, 100)]))
            for d in range(3) for i in range(400 if d == 0 else 30)]
    t = spark.createDataFrame(rows, "jsy string, end_time bigint, score double")
    got = trips.running_score(t, chunk=chunk).collect()
    assert len(got) == len(rows)
    for (d,), found in brute.by_key(got, "jsy").items():
        found.sort(key=lambda r: r.end_time)
        assert [r.running for r in found] == pytest.approx(brute.running([r.score for r in found]), abs=1e-9)


def test_drop_repeats(spark):
    rows = [(0, 0, 1), (1, 10, 1), (2, 20, 2), (3, 25, 2), (4, 41, 2), (5, 100_000, 2), (6, 100_014, 2)]
    m = spark.createDataFrame([("a", *r) for r in rows], "jsy string, event_id int, longtime bigint, rapid_mark int")
    assert sorted(r.event_id for r in marks.drop_repeats(m).collect()) == [0, 2, 4, 5]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([0.0, 1.0, rnd.gauss(0, 1), 1e9, -1e-9]), 5.0, rnd.choice([None, float(i)]))
            for i in range(997)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = [0, 0.05, 0.2, 0.45, 0.75, 0.9, 1]
    got = {(r.feature, r.idx): r.v for r in ranks.exact_quantiles(df, dict.fromkeys("abc", probs)).collect()}
    for i, name in enumerate("abc"):
        values = sorted(r[i] for r in rows if r[i] is not None)
        for k, p in enumerate(probs):
            assert got[name, k] == values[max(1, -int(-(p * len(values)) // 1)) - 1]


def test_split_keys(spark):
    rnd = random.Random(3)
    keys = [f"row-{rnd.choice(['a', 'a', 'a', 'é', 'zz'])}-{rnd.randint(0, 400)}" for _ in range(1003)]
    df = spark.createDataFrame([(k,) for k in keys], "rowkey string")
    ordered = sorted(keys, key=lambda k: k.encode())
    q, r = divmod(len(keys), 6)
    want = [ordered[i * q + min(i, r)] for i in range(1, 6)]
    got = [x.rowkey for x in ranks.split_keys(df, "rowkey", 6).orderBy("split").collect()]
    assert got == want


def _at(values, p):
    return values[max(1, -int(-(p * len(values)) // 1)) - 1]


@pytest.mark.parametrize("kind", ["outlier", "infinities", "tiny", "equal", "signs"])
def test_rounds_reach_every_spread(spark, kind):
    rnd = random.Random(kind)
    values = {
        "outlier": [rnd.uniform(1, 1 + 1e-9) for _ in range(600)] + [1e300, -1e300],
        "infinities": [float("inf")] * 50 + [float("-inf")] * 60 + [rnd.gauss(0, 1) for _ in range(400)],
        "tiny": [rnd.choice([5e-324, 1e-310, -1e-310, 0.0, -0.0, 2.0**-1022]) for _ in range(300)],
        "equal": [3.25] * 500,
        "signs": [s * 2.0 ** rnd.randint(-40, 40) * rnd.choice([1, 1 + 2.0**-52]) for s in (1, -1) for _ in range(300)],
    }[kind]
    df = spark.createDataFrame([("x", v, 1) for v in values], "feature string, v double, n int")
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    wanted = spark.createDataFrame([("x", i, max(1, -int(-(p * len(values)) // 1))) for i, p in enumerate(probs)],
                                   "feature string, idx int, rank bigint")
    got = {r.idx: r.v for r in ranks.select_ranks(df, lambda totals: wanted, sorted_rows=3).collect()}
    assert got == {i: _at(sorted(values), p) for i, p in enumerate(probs)}


def test_rounds_of_strings(spark):
    rnd = random.Random(5)
    keys = [rnd.choice(["p" * 300 + t for t in ("", "\x00", "\x00\x00", "a", "é", "\U0001f600")] + ["p" * 40 + str(rnd.random())])
            for _ in range(400)] + ["", "zz"]
    df = spark.createDataFrame([("x", k, 1) for k in keys], "feature string, v string, n int")
    wanted = spark.createDataFrame([("x", i, i) for i in range(1, len(keys) + 1)], "feature string, idx int, rank bigint")
    got = {r.idx: r.v for r in ranks.select_ranks(df, lambda totals: wanted, sorted_rows=1).collect()}
    assert got == dict(enumerate(sorted(keys, key=str.encode), 1))


def test_quantiles_of_a_driver_are_exact(spark):
    """A driver of 20,000 distinct values, one of a few, one without any, and a null one."""
    rnd = random.Random(9)
    values = {"hot": rnd.sample(range(10**7), 20_000), "few": [3, 1, 2], None: [7, 7, 9, 8]}
    rows = [(d, float(v)) for d, vs in values.items() for v in vs] + [("none", None), ("few", None), ("few", float("nan"))]
    df = spark.createDataFrame(rows, "jsy string, g double").repartition(4)
    probs = [0.25, 0.5, 0.75, 0.9, 0.95]
    got = {r.jsy: r.q for r in ranks.grouped_quantiles(df, ["jsy"], "g", probs).collect()}
    assert got == {d: [float(_at(sorted(vs), p)) for p in probs] for d, vs in values.items()}
