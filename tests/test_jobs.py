"""Whole streaming jobs: what they keep, write and read again, and what a repeated batch does."""

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import marks, pairs, thresholds
from roadpulse.operators.presets import PRESETS
from roadpulse.plans import streams
from roadpulse.sources import jdbc
from roadpulse.sources.detail import detail_cells
from roadpulse.sources.folders import read_folders
from roadpulse.streaming import detectors, jobs, summaries

COLUMNS = ["jsy", "dbuscard", "event_id", "longtime", "speed", "orientation", "llon", "llat", "ehstatus"]


def stream(spark, fixes, path, cuts=(700, 1400)):
    """The fixes as a stream of files in time order, one a micro-batch."""
    t = fixes.select(*COLUMNS)
    for low, high in zip((0, *cuts), (*cuts, 1 << 30)):
        t.where(f"longtime - 1546300800 >= {low} AND longtime - 1546300800 < {high}").coalesce(1).write.mode("append").parquet(path)
    return detectors.with_event_time(spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 1).parquet(path))


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


WINDOWS = summaries.Windows(seconds=300, slides=4)


@pytest.fixture(scope="module")
def learned(spark, fixes, tmp_path_factory):
    """Summaries and windows that the publishing job leaves after three micro-batches."""
    base = str(tmp_path_factory.mktemp("learned"))
    plausible = detectors.pair_stream(stream(spark, fixes, f"{base}/in").where("speed <= 120"), min_rank=2)
    streams.finish(jobs.start(plausible, summaries.publish(base, WINDOWS), f"{base}/ck", availableNow=True))
    return base


def published(spark, base):
    found = spark.read.schema(summaries.PUBLISHED).parquet(f"{base}/stats")
    return found.select("window_end", F.from_json("stat", "cnt bigint, " + ", ".join(f"{n} double" for n in summaries.NAMES)).alias("s")).select("window_end", "s.*")


def test_published_windows_are_those_of_all_pairs(spark, fixes, learned):
    paired = pairs.every_pair(fixes, speed_before=120.0)
    both = thresholds.add_published_motion(paired).withColumn("e", F.explode(F.sequence(
        F.expr("longtime div 300 + 1"), F.greatest(F.expr("pretime div 300 + 4"), F.expr("longtime div 300 + 1"))))).where("e <= pretime div 300 + 4")
    want = {r.e: r for r in both.groupBy("e").agg(
        F.avg(F.when(F.col("aspeed") > 0, F.col("aspeed"))).alias("up"), F.stddev_samp(F.when(F.col("aspeed") < 0, F.col("aspeed"))).alias("dn"),
        F.avg(F.when(F.col("turn") > 45, F.col("turn"))).alias("turn")).collect()}
    got = published(spark, learned).collect()
    assert len(got) >= 5 and {r.window_end for r in got} <= set(want)
    for r in got:
        w = want[r.window_end]
        assert (r.avg_upaspeed, r.std_dnaspeed, r.avg_turn) == pytest.approx((w.up, w.dn, w.turn))


def test_a_batch_reads_the_slides_of_its_windows_only(spark, learned):
    every = sorted(r.slide for r in spark.read.schema(summaries.SUMMARY).parquet(f"{learned}/slides").select("slide").distinct().collect())
    assert len(every) > 4
    wanted = range(every[1], every[3])
    files = summaries.slides(spark, learned, wanted).inputFiles()
    assert files and {f.split("slide=")[1].split("/")[0] for f in files} == {str(s) for s in wanted if s in every}
    stats = summaries.newest_for(spark, learned, range(every[-1], every[-1] + 1), WINDOWS)
    assert {int(f.split("window_end=")[1].split("/")[0]) for f in stats.inputFiles()} <= set(range(every[-1] - 3, every[-1] + 1))
    assert summaries.slides(spark, learned, range(5, 9)).count() == 0


def test_a_repeated_batch_changes_no_statistics(spark, fixes, tmp_path):
    base, paired = str(tmp_path), pairs.every_pair(fixes, speed_before=120.0)
    run = summaries.publish(base, WINDOWS)
    early, late = paired.where("longtime < 1546301500"), paired.where("longtime >= 1546301500")
    run(early, 0)
    run(late, 1)
    before = rows(published(spark, base).drop("cnt"), "*"), rows(published(spark, base), "window_end", "cnt")
    run(late, 1)
    run(paired.where("false"), 2)
    assert (rows(published(spark, base).drop("cnt"), "*"), rows(published(spark, base), "window_end", "cnt")) == before
    whole = str(tmp_path / "whole")
    summaries.publish(whole, WINDOWS)(paired, 0)
    assert rows(published(spark, whole), "window_end", "cnt") == before[1]


def test_the_detector_takes_the_newest_window_before(spark, fixes, learned):
    found = []
    judge = summaries.detect(learned, lambda df, _: found.extend(df.select("longtime", "stats.avg_turn").collect()), WINDOWS, keep_zero=True)
    judge(pairs.every_pair(fixes, earlier=2), 0)
    ends = {r.window_end: r.avg_turn for r in published(spark, learned).collect()}
    assert found
    for r in found:
        newest = max(e for e in ends if e <= r.longtime // 300 and e > r.longtime // 300 - 4)
        assert r.avg_turn == ends[newest]


def test_fixed_detail_writes_a_batch_once(spark, fixes, tmp_path):
    source, out = stream(spark, fixes, str(tmp_path / "in")), str(tmp_path / "out")
    detectors.use_state_store(spark)
    streams.finish(jobs.fixed_detail(source, out, str(tmp_path / "ck"), availableNow=True))
    p = PRESETS["bus_detail_stream"]
    batch = pairs.every_pair(fixes, earlier=2, carry=("dbuscard",)).where("time_interval BETWEEN 5 AND 60 AND v1_kmh < 80")
    m = marks.with_marks(pairs.add_motion(batch, limits=p.limits), marks.band_mark(marks.batch_limits(p), p.straight, p.turn_first))
    want = jdbc.alarm_rows(m.withColumn("tips", jobs.alarm_tips(p)))
    alarms = spark.read.parquet(f"{out}/alarms")
    columns = ["uid", "dbuscard", "starttime", "tips", "startpos"]
    assert want.count() > 0 and rows(alarms, *columns) == rows(want, *columns)
    cells = spark.read.parquet(f"{out}/cells")
    assert rows(cells, "rowkey", "qualifier", "value") == rows(detail_cells(m), "rowkey", "qualifier", "value")
    assert cells.where("qualifier = 'ppspeed'").count() == m.count()
    write = jobs.table_sink(f"{out}/alarms")
    again = alarms.where("batch = 1").drop("batch").collect()
    write(spark.createDataFrame(again, alarms.drop("batch").schema), 1)  # as after a failure between writing and committing
    assert rows(spark.read.parquet(f"{out}/alarms"), *columns) == rows(want, *columns)


def test_fired_alarms_carry_the_vehicle_of_the_mark(spark, fixes, tmp_path):
    detectors.use_state_store(spark)
    quick = jobs.Preset("quick", 0.2, -0.2, 0.0, 1e9, 0.0, 0.0, 0.0, turn_first=False)
    streams.finish(jobs.event_alarms(stream(spark, fixes, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"), quick, availableNow=True))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 0 and got.where("dbuscard <> 'B' || cast(cast(dguid AS bigint) % 40 AS string)").count() == 0


def messages(spark, path, trips, schema="jsy string, begin_time bigint, end_time bigint"):
    if trips is not None:
        spark.createDataFrame(trips, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.timestamp_seconds("end_time"))


def test_rendezvous_scores_late_and_repeated_messages_once(spark, tmp_path):
    detectors.use_state_store(spark)
    base = str(tmp_path)
    counts = spark.createDataFrame([("a", 0, 1000, 1, 0, 0, 0, 3, 1, 0), ("a", 1000, 2000, 0, 0, 0, 0, 0, 0, 0), ("b", 100, 9000, 0, 0, 2, 0, 0, 0, 1)],
                                   "jsy string, begin_time bigint, end_time bigint, over0 int, over1 int, over2 int, over3 int, "
                                   "accelerations int, brakings int, turns int")
    for kind, names in (("over", jobs.OVER), ("marks", jobs.MARKS)):
        jobs.store_counts(counts, f"{base}/counts/{kind}", names, 0)
        jobs.store_counts(counts, f"{base}/counts/{kind}", names, 0)  # again, as after a failure
    progress = []

    def run(over, marked):
        q = jobs.rendezvous_scores(messages(spark, f"{base}/over", over), messages(spark, f"{base}/marks", marked),
                                   f"{base}/counts", f"{base}/out", f"{base}/ck", "1000 seconds", availableNow=True)
        streams.finish(q)
        progress.append(sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"]))

    run([("a", 0, 1000), ("a", 0, 1000), ("x", 5, 700)], [("a", 1000, 2000)])
    run([("a", 1000, 2000)], [("a", 0, 1000), ("b", 100, 9000)])       # the late one still meets its other half
    run([("b", 100, 9000)], [("a", 0, 1000), ("x", 5, 700)])           # a repeat; one for which it is too late
    got = spark.read.parquet(f"{base}/out")
    assert rows(got, "jsy", "begin_time", "over0", "over2", "accelerations", "turns") == [
        ("a", 0, 1, 0, 3, 0), ("a", 1000, 0, 0, 0, 0), ("b", 100, 0, 2, 0, 1)]
    assert got.where("score IS NULL OR minutes IS NULL").count() == 0
    run([("z", 0, 1_000_000)], [("z", 0, 1_000_000)])
    run([("z", 1, 2_000_000)], [("z", 1, 2_000_000)])
    assert max(progress[:3]) > progress[-1]  # what waited is gone once the interval has passed


def test_only_existing_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 5), (2, 6), (3, 9)], "x int, hour bigint").write.partitionBy("hour").parquet(path)
    assert rows(read_folders(spark, path, "hour", range(5, 9), "x int, hour bigint"), "x", "hour") == [(1, 5), (2, 6)]
    assert read_folders(spark, path, "hour", [7], "x int, hour bigint").count() == 0
    assert read_folders(spark, str(tmp_path / "none"), "hour", [7], "x int, hour bigint").columns == ["x", "hour"]


def test_pairs_of_batches_are_those_of_the_whole(spark, fixes, tmp_path):
    """Batches of a native job: pairs reach over the cuts, late fixes and a repeated batch change nothing."""
    from roadpulse.streaming import carried

    t = detectors.with_event_time(fixes.select(*COLUMNS))
    late = t.where("longtime - 1546300800 < 700").limit(50)
    batches = [t.where("longtime - 1546300800 < 700"), t.where("longtime - 1546300800 BETWEEN 700 AND 709").unionByName(late),
               t.where("false"), t.where("longtime - 1546300800 >= 710")]
    got = {}
    step = carried.with_pairs(str(tmp_path / "c"), lambda df, k: got.__setitem__(k, rows(df, "event_id", "pretime", "pp_kmh", "time_interval")))
    for k in (0, 1, 1, 2, 3):
        step(batches[k], k)
    want = rows(pairs.every_pair(fixes, earlier=2), "event_id", "pretime", "pp_kmh", "time_interval")
    assert all(got[k] for k in (0, 1, 3)) and sorted(sum(got.values(), []), key=str) == want
    ranks = carried.previous_fixes(t.where("false"), str(tmp_path / "c"), 4)
    kept = spark.read.parquet(str(tmp_path / "c/last/batch=4"))
    assert ranks.count() == 0 and kept.groupBy("jsy").count().where("count > 2").count() == 0
    counts = fixes.groupBy("jsy").agg(F.countDistinct("longtime").alias("n")).where("n > 2")
    assert counts.join(kept.groupBy("jsy").agg(F.max("ahead").alias("a")), "jsy").where("a <> n - 2").count() == 0


def test_running_scores_of_batches_are_those_of_the_whole(spark, tmp_path):
    """A driver's score goes on over the cuts, also past a batch without a trip; a repeated batch changes nothing."""
    from roadpulse.operators import trips
    from roadpulse.streaming import carried

    scored = spark.createDataFrame([(d, 100 * k, 60.0 + (7 * k + len(d)) % 40 + 0.37) for d in ("a", "bb") for k in range(1, 40)],
                                   "jsy string, end_time bigint, score double")
    batches = [scored.where("end_time <= 900"), scored.where("jsy = 'a' AND end_time BETWEEN 901 AND 2500"), scored.where("false"),
               scored.where("end_time > 2500 OR jsy = 'bb' AND end_time > 900")]
    got = {}
    step = carried.with_running(str(tmp_path / "c"), lambda df, k: got.__setitem__(k, rows(df, "jsy", "end_time", "running")))
    for k in (0, 1, 1, 2, 3, 3):
        step(batches[k], k)
    assert sorted(sum(got.values(), []), key=str) == rows(trips.running_score(scored), "jsy", "end_time", "running")
    assert spark.read.parquet(str(tmp_path / "c/running/batch=3")).count() == 2


@pytest.mark.parametrize("ends", [None, (("1", "2"), ("3", "0"))])
def test_scores_of_batches_are_those_of_the_whole(spark, fixes, tmp_path, ends):
    """Trips, their counts and scores reach over the cuts; late fixes and a repeated batch change nothing."""
    from roadpulse.operators import trips
    from roadpulse.plans.inputs import over_code
    from roadpulse.streaming import carried

    columns = ["jsy", "begin_time", "end_time", "over0", "over1", "accelerations", "brakings", "turns", "score", "running"]
    over = over_code(trips.TAXI_OVER_CODES)
    t = detectors.with_event_time(fixes.select(*COLUMNS))
    late = t.where("longtime - 1546300800 < 700").limit(50)
    batches = [t.where("longtime - 1546300800 < 700"), t.where("longtime - 1546300800 BETWEEN 700 AND 709").unionByName(late),
               t.where("false"), t.where("longtime - 1546300800 >= 710")]
    got = {}
    step = carried.with_scores(str(tmp_path / "c"), lambda df, k: got.__setitem__(k, rows(df, *columns)), over, ends=ends)
    for k in (0, 1, 1, 2, 3):
        step(batches[k], k)
    whole = trips.split_trips(trips.step_marks(fixes), ends=ends, over=over)
    assert sorted(sum(got.values(), []), key=str) == rows(trips.running_score(trips.score_trips(whole)), *columns)
    assert got[3] and spark.read.parquet(str(tmp_path / "c/open/batch=3")).groupBy("jsy").count().where("count > 1").count() == 0
