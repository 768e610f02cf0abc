"""Streams give what the batch operators give, across files and restarts."""

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import episodes, marks, pairs, trips
from roadpulse.operators.presets import PRESETS
from roadpulse.plans.inputs import over_code
from roadpulse.streaming import detectors, state

COLUMNS = ["jsy", "dbuscard", "event_id", "longtime", "speed", "orientation", "llon", "llat", "ehstatus"]


@pytest.fixture(scope="module")
def source(spark, fixes, tmp_path_factory):
    """The fixes as three files in time order."""
    path = str(tmp_path_factory.mktemp("stream") / "in")
    t = fixes.select(*COLUMNS)
    for k, condition in enumerate(("< 1000", "BETWEEN 1000 AND 1499", ">= 1500")):
        t.where(f"longtime - 1546300800 {condition}").coalesce(1).write.mode("append").parquet(path)
    return path, t


def stream(spark, source):
    path, t = source
    raw = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return detectors.with_event_time(raw)


def finish(df, name, checkpoint, mode="append"):
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    return df.sparkSession.table(name)


def same(a, b, columns):
    a, b = a.select(*columns), b.select(*columns)
    assert b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scores(spark, source, tmp_path):
    over = over_code(trips.TAXI_OVER_CODES)
    got = finish(detectors.score_stream(stream(spark, source), over), "s_scores", str(tmp_path))
    want = trips.running_score(trips.score_trips(trips.split_trips(trips.step_marks(source[1]), over=over)))
    same(got, want, ["jsy", "begin_time", "end_time", "over0", "over1", "accelerations", "brakings", "turns", "running"])


def test_fixed_detector_and_alarms(spark, source, tmp_path):
    preset = PRESETS["bus_event_stream"]
    got = finish(detectors.fixed_alarms(stream(spark, source), preset), "s_alarms", str(tmp_path / "a"))
    motion = pairs.add_motion(pairs.every_pair(source[1], earlier=2).where("time_interval BETWEEN 5 AND 60"), limits="ramp")
    m = marks.with_marks(motion, marks.band_mark(marks.batch_limits(preset), preset.straight, preset.turn_first))
    same(got, episodes.fired(m), ["jsy", "rapid_mark", "fired_at", "opened", "ends"])


def test_restart_goes_on_from_the_checkpoint(spark, fixes, tmp_path):
    path, t = str(tmp_path / "in"), fixes.select(*COLUMNS)
    t.where("longtime - 1546300800 < 700").write.parquet(path)

    def run():
        raw = spark.readStream.schema(t.schema).parquet(path)
        steps = detectors.step_marks(detectors.with_event_time(raw)).where("raw_mark IS NOT NULL")
        q = (steps.select("jsy", "event_id", "mark").writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination(300)

    run()
    half = spark.read.parquet(str(tmp_path / "out")).count()
    t.where("longtime - 1546300800 >= 700").write.mode("append").parquet(path)
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert 0 < half < got.count()
    same(got, trips.step_marks(t).where("raw_mark IS NOT NULL"), ["jsy", "event_id", "mark"])


def test_late_fix_is_dropped(spark, tmp_path):
    rows = [("a", "B", i, 1000 + 10 * i, 30.0, 0.0, 119.4, 32.2, "1") for i in range(4)]
    late = [("a", "B", 99, 1005, 30.0, 0.0, 119.4, 32.2, "2"), ("a", "B", 5, 1050, 30.0, 0.0, 119.4, 32.2, "1")]
    schema = ("jsy string, dbuscard string, event_id bigint, longtime bigint, speed double, orientation double, "
              "llon double, llat double, ehstatus string")
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(path)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = finish(state.previous_fixes(detectors.with_event_time(raw)), "s_late", str(tmp_path / "ck"))
    assert sorted((r.event_id, r["rank"]) for r in got.collect()) == [(0, 1), (1, 2), (2, 3), (3, 4), (5, 5)]


def test_rendezvous_scores_a_trip_once(spark, tmp_path):
    done = trips_ = [("a", 100, 200), ("a", 200, 300), ("b", 100, 150)]
    over = [(*k, 1) for k in done] + [("a", 100, 200, 1)]
    rapid = [(*k, 2) for k in trips_[:2]] + [("a", 200, 300, 2)]
    for name, rows, col in (("over", over, "over0"), ("rapid", rapid, "turns")):
        spark.createDataFrame(rows, f"jsy string, begin_time bigint, end_time bigint, {col} int").write.parquet(
            str(tmp_path / name))

    def read(name, col):
        schema = f"jsy string, begin_time bigint, end_time bigint, {col} int"
        return (spark.readStream.schema(schema).parquet(str(tmp_path / name))
                .withColumn("ts", F.timestamp_seconds("end_time")))

    got = finish(detectors.rendezvous(read("over", "over0"), read("rapid", "turns")), "s_meet", str(tmp_path / "ck"))
    assert sorted((r.jsy, r.begin_time, r.over0, r.turns) for r in got.collect()) == [("a", 100, 1, 2), ("a", 200, 1, 2)]


def test_lookup_of_missing_counts(spark):
    s = spark.createDataFrame([("a", 1, 2), ("b", 1, 2)], "jsy string, begin_time bigint, end_time bigint")
    c = spark.createDataFrame([("a", 1, 2, 5)], "jsy string, begin_time bigint, end_time bigint, over0 int")
    got = {r.jsy: r.over0 for r in detectors.lookup_counts(s, c, ["over0"]).collect()}
    assert got == {"a": 5, "b": 0}


def test_stream_reads_a_table_of_many_files(spark, data, tmp_path):
    from roadpulse.plans import streams

    spark.read.parquet(f"{data}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    rows = lambda d: {tuple(r) for r in streams.steps(spark, d).collect()}
    whole = rows(data)
    assert whole and rows(str(tmp_path)) == whole


def test_every_pair_takes_any_gap(spark):
    from roadpulse.operators.pairs import every_pair

    at = [0, 3, 1000, 1000, 90_000]
    fixes = spark.createDataFrame([("a", i, t, 50.0, 0.0, 116.0, 32.0) for i, t in enumerate(at)],
                                  "jsy string, event_id long, longtime long, speed double, orientation double, llon double, llat double")
    gaps = lambda n: sorted((r.event_id, r.time_interval) for r in every_pair(fixes, earlier=n).collect())
    assert gaps(1) == [(1, 3), (2, 997), (4, 89_000)]
    assert gaps(2) == [(2, 997)]


def _batches(spark, path, batches):
    """A source with one file per batch of (driver, second)."""
    schema = "jsy string, dbuscard string, event_id bigint, longtime bigint, speed double, orientation double, llon double, llat double, ehstatus string"
    for k, rows in enumerate(batches):
        spark.createDataFrame([(d, "B", 100 * k + i, t, 30.0, 0.0, 119.4, 32.2, "1") for i, (d, t) in enumerate(rows)], schema) \
            .coalesce(1).write.mode("append").parquet(path)
        yield detectors.with_event_time(spark.readStream.schema(schema).parquet(path))


DAY = 86400


@pytest.mark.parametrize("idle", [None, 3600])
def test_idle_drivers_are_forgotten(spark, tmp_path, idle):
    """Two drivers go, a third drives a day later, then one of the two comes back."""
    batches = [[("a", 100), ("a", 110), ("b", 105)], [("c", DAY), ("c", DAY + 10)], [("c", DAY + 20)], [("a", DAY + 30), ("c", DAY + 30)]]
    kept = []
    for k, fixes in enumerate(_batches(spark, str(tmp_path / "in"), batches)):
        out = state.previous_fixes(fixes, idle).select("jsy", "longtime", "rank")
        q = (out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "s"))
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
        kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    ranks = {(r.jsy, r.longtime): r["rank"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert ranks["a", DAY + 30] == (3 if idle is None else 1) and ranks["c", DAY + 30] == 4 and len(ranks) == 8
    assert (kept[2] < kept[0]) == (idle is not None)


def test_windows_of_alarms_go_when_they_are_over(spark, tmp_path):
    schema = "jsy string, rapid_mark int, dbuscard string, longtime bigint, pretime bigint"
    batches = [[("a", 100), ("a", 110), ("b", 105)], [("c", 5000)], [("a", 5200), ("a", 5300), ("b", 5400)]]
    kept = []
    for rows in batches:
        spark.createDataFrame([(d, 1, "B", t, t - 10) for d, t in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        marked = detectors.with_event_time(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
        q = (state.alarms(marked).select("jsy", "fired_at", "opened", "ends").writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
        kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [
        ("a", 110, 90, 270), ("a", 5300, 5190, 5370)]
    assert kept[1] < kept[0]
