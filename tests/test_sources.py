import os

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import marks, pairs, thresholds, trips
from roadpulse.sources import files, jdbc, kafka, records, snapshots


def test_csv_months(spark, fixes, tmp_path):
    out = fixes.withColumn("LUTC", F.from_unixtime("longtime")).select(
        F.col("jsy").alias("DBusCard"), "LUTC", F.col("longtime").alias("lutclong"), "llon", "llat",
        F.col("speed").alias("lspeed"), F.col("orientation").alias("LDir"), F.lit("201901").alias("month"))
    path = str(tmp_path / "jr")
    files.write_csv(out, path, partition_by=["month"])
    back = files.read_csv(spark, path, files.BUS_MATCHED)
    assert back.schema["speed"].dataType.simpleString() == "double" and "month" in back.columns
    cols = ["jsy", "longtime", "speed", "orientation", "llon", "llat"]
    assert back.select(*cols).exceptAll(fixes.select(*cols)).count() == 0
    assert back.count() == fixes.count()
    plan = back.where("month = '201901'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    files.write_csv(out.limit(5).drop("month"), str(tmp_path / "one"), one_file=True)
    files.write_csv(out.limit(5).drop("month"), str(tmp_path / "one"), mode="append", one_file=True)
    assert len([f for f in os.listdir(tmp_path / "one") if f.endswith(".csv")]) == 2
    assert files.by_month(fixes).select("month").distinct().first()[0] == "201901"


def test_csv_bad_numbers_become_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("DBusCard,LUTC,lutclong,llon,llat,lspeed,LDir\n7,t,100,119.4,32.2,fast,90\n")
    row = files.read_csv(spark, str(tmp_path / "x.csv"), files.BUS_MATCHED).first()
    assert row.speed is None and row.longtime == 100 and row.orientation == 90.0


def test_csv_wrong_header_is_rejected(spark, tmp_path):
    (tmp_path / "y.csv").write_text("a,b,c,d,e,f,g\n1,2,3,4,5,6,7\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path / "y.csv"), files.BUS_MATCHED).collect()


def test_raw_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("0,7,2019-01-01 00:00:01,119.4,32.2,35.5,90]\nshort,line\n")
    rows = files.read_raw_text(spark, str(tmp_path / "t.txt")).orderBy(F.col("jsy").desc_nulls_last()).collect()
    first = next(r for r in rows if r.jsy == "7")
    assert first.longtime == 1546300801 and first.orientation == 90.0 and first.speed == 35.5


@pytest.mark.parametrize("name", list(records.LAYOUTS))
@pytest.mark.parametrize("unit", ["s", "ms"])
def test_wire_layouts(spark, fixes, name, unit):
    layout = records.LAYOUTS[name]
    back = records.parse_records(records.format_records(fixes, layout, unit), layout, unit=unit)
    assert back.count() == fixes.count()
    cols = [c for c in ("jsy", "longtime", "speed", "llon", "llat", "orientation") if c in layout]
    assert back.select(*cols).exceptAll(fixes.select(*cols)).count() == 0


def test_bad_records_are_dropped(spark):
    df = spark.createDataFrame([("7,B1,x,t,100,119,32,0",), ("",), ("only,two",)], "value string")
    got = records.parse_records(df, records.L_EVENT).collect()
    assert len(got) == 1 and got[0].speed is None


def test_status_messages(spark):
    df = spark.createDataFrame([("a_b_100_200",), ("7_100_200_rp",)], "value string")
    assert [tuple(r) for r in records.parse_status(df).collect()] == [("a_b", 100, 200, None), ("7", 100, 200, "rp")]


def test_messages(spark, fixes):
    steps = trips.step_marks(fixes)
    all_marks = records.mark_message(steps)
    some = records.mark_message(steps, keep_zero=False)
    assert 0 < some.count() < all_marks.count()
    assert all(len(r.value.split(",")) == 15 for r in some.limit(20).collect())
    timed = records.mark_message(steps.withColumn("received", F.timestamp_seconds(F.lit(7))).withColumn("wayname", F.lit(None).cast("string")),
                                 last="wayname").first().value.split(",")
    assert timed[10] == "" and timed[12] == "7000" and int(timed[11]) <= int(timed[13]) <= int(timed[14])
    scored = trips.running_score(trips.score_trips(trips.split_trips(steps)))
    fields = records.score_message(scored).first().value.split(",")
    assert len(fields) == 12 and all(len(fields[i].split(".")[1]) == 2 for i in (2, 3))


def test_snapshot_versions(spark, fixes, tmp_path):
    pairs_ = thresholds.add_published_motion(pairs.pair_fixes(fixes))
    stats = thresholds.published_stats(pairs_)
    path = str(tmp_path / "stats")
    snapshots.publish(snapshots.pack(stats), path, 1)
    snapshots.publish(snapshots.pack(stats.withColumn("avg_turn", F.lit(1.5))), path, 2)
    got = snapshots.read_latest(spark, path, stats.columns).first()
    assert got.avg_turn == 1.5
    assert got.avg_upaspeed == pytest.approx(stats.first().avg_upaspeed)
    broken = stats.withColumn("avg_turn", F.lit(None).cast("double"))
    assert snapshots.pack(broken).count() == 0
    assert snapshots.pack_named(broken, ["avg_upaspeed"]).count() == 1
    snapshots.publish(snapshots.pack(broken), path, 3)
    assert snapshots.read_latest(spark, path, stats.columns).first().avg_turn == 1.5


def test_alarm_table_rows(spark, fixes):
    m = marks.with_marks(pairs.add_motion(pairs.pair_fixes(fixes, carry=["dbuscard"])), marks.simple_mark())
    rows = jdbc.alarm_rows(m.withColumn("tips", F.when(F.col("rapid_mark") == 3, "hard turn")))
    assert rows.count() == m.where("rapid_mark = 3").count()
    first = rows.first()
    assert first.alarmtype == "5" and first.contime >= 5 and "," in first.startpos
    assert rows.select("uid").distinct().count() == rows.count()


def test_jdbc_and_kafka_options(spark):
    opts = {"url": "jdbc:db://host/x", "user": "u", "password": "p"}
    assert jdbc.reader(spark, opts, "t", "a > 1", ("id", 0, 100, 4)) is not None
    k = kafka.source_options("h:1", ["a", "b"], per_trigger=5)
    assert k["subscribe"] == "a,b" and k["startingOffsets"] == "latest" and k["maxOffsetsPerTrigger"] == "5"
    values = spark.createDataFrame([("7,B1,10.0,t,100000,119,32,0",)], "value string")
    row = kafka.telemetry(values).first()
    assert row.longtime == 100 and row.event_id is not None
