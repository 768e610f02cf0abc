"""Further inputs derived from the driver tables: score inputs, accidents, cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.cells import put_columns, union_cells
from ..operators.episodes import count_events
from ..operators.marks import simple_mark, with_marks
from ..operators.pairs import PairRule, add_motion, pair_fixes
from .fixture import table, telemetry

PLACES = {0: "section", 1: "cross", 2: "station"}


def free_pairs(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Pairs 5-60 s apart, the gaps that mileage and counts are taken over, at any speed, with their motion."""
    return add_motion(pair_fixes(telemetry(spark, sf_dir), PairRule(speed_after=None), carry=carry))


def over_code(codes: tuple[str, ...]) -> Column:
    """Over-speed code of a fix: bands from 60 km/h up, 20 km/h wide."""
    s = F.col("speed")
    return (F.when(s > 120, codes[3]).when(s > 100, codes[2])
            .when(s > 80, codes[1]).when(s > 60, codes[0]))


def _level(speed: Column) -> Column:
    return F.when(speed > 100, "c").when(speed > 80, "b").when(speed > 60, "a")


def score_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per driver with mileage, over-speed and mark counts and events.

    Over-speed pairs are put in a place by ``event_id % 3``. Every counted kind
    is one key of a single event count; the counts are combined per driver.
    """
    pairs = with_marks(free_pairs(spark, sf_dir, ("ehstatus",)), simple_mark(), keep_zero=True)
    place = F.create_map(*[F.lit(x) for kv in PLACES.items() for x in kv])[(F.col("event_id") % 3).cast("int")]
    rows = pairs.select(
        "jsy", "longtime", "time_interval", "actual_dist", "ehstatus", "rapid_mark",
        place.alias("place"), _level(F.col("v1_kmh")).alias("level"))

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    km = F.col("actual_dist") / 1000
    over, lv = F.col("level").isNotNull(), F.col("level")
    sums = [F.sum(km).alias("km"),
            F.coalesce(F.sum(F.when(F.col("ehstatus").isin("1", "3"), km)), F.lit(0.0)).alias("loaded_km"),
            F.coalesce(F.sum(F.when(~F.col("ehstatus").isin("1", "3"), km)), F.lit(0.0)).alias("empty_km"),
            F.coalesce(F.sum(F.when(over, F.col("time_interval"))), F.lit(0)).alias("over_time"),
            F.coalesce(F.sum(F.when(lv.isin("b", "c"), F.col("time_interval"))), F.lit(0)).alias("over_time_event"),
            *[count((F.col("place") == p) & over).alias(f"{p}_count") for p in PLACES.values()],
            *[count((F.col("place") == p) & (lv == x)).alias(f"{p}_{x}_count")
              for p in PLACES.values() for x in "abc"],
            *[count(lv == x).alias(f"over_{x}") for x in "abc"],
            *[count(F.col("rapid_mark") == i).alias(f"mark{i}") for i in (1, 2, 3)]]
    totals = rows.groupBy("jsy").agg(*sums)
    kinds = F.array_compact(F.array(
        F.when(over, "over"), F.when(over, F.concat(F.lit("over_"), lv)),
        F.when(over, F.col("place")), F.when(over, F.concat_ws("_", "place", "level")),
        F.when(F.col("rapid_mark") != 0, F.concat(F.lit("mark"), F.col("rapid_mark").cast("string")))))
    events = count_events(rows.select("jsy", "longtime", F.explode(kinds).alias("kind")), ["jsy", "kind"])
    names = ["over", "over_b", "over_c", *PLACES.values(),
             *[f"{p}_{x}" for p in PLACES.values() for x in "bc"], "mark1", "mark2", "mark3"]
    per_driver = events.groupBy("jsy").agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("cnt"))), F.lit(0)).alias(f"ev_{k}") for k in names])
    joined = totals.join(per_driver, "jsy", "left")
    return joined.fillna(0, [f"ev_{k}" for k in names])


def bus_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = score_inputs(spark, sf_dir)
    return x.select(
        F.col("jsy").alias("user_id"), F.col("km").alias("distance"),
        *[f"{p}_count" for p in PLACES.values()],
        *[f"{p}_{c}_count" for p in PLACES.values() for c in "abc"],
        F.col("over_time").alias("section_time"), F.col("mark1").alias("upper_sudden"),
        F.col("mark2").alias("low_sudden"), F.col("mark3").alias("turn_sudden"),
        *[F.col(f"ev_{p}").alias(f"{p}_count_event") for p in PLACES.values()],
        *[F.col(f"ev_{p}_{c}").alias(f"{p}_{c}_count_event") for p in PLACES.values() for c in "bc"],
        F.col("over_time_event").alias("section_time_event"),
        F.col("ev_mark1").alias("upper_sudden_event"), F.col("ev_mark2").alias("low_sudden_event"),
        F.col("ev_mark3").alias("turn_sudden_event"))


def taxi_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = score_inputs(spark, sf_dir)
    return x.select(
        "jsy", F.col("km").alias("kilometers"), F.col("loaded_km").alias("lift_kilometers"),
        F.col("empty_km").alias("empty_kilometers"),
        (F.col("over_a") + F.col("over_b") + F.col("over_c")).alias("overspeed_count"),
        *[F.col(f"over_{c}").alias(f"overspeed_{c}") for c in "abc"],
        F.col("over_time").alias("overspeed_time"), F.col("mark1").alias("up_sudden_count"),
        F.col("mark2").alias("down_sudden_count"), F.col("mark3").alias("turn_sudden_count"),
        F.col("ev_over").alias("overspeed_event_count"),
        *[F.col(f"ev_over_{c}").alias(f"overspeed_event_{c}") for c in "bc"],
        F.col("over_time_event").alias("overspeed_event_time"),
        F.col("ev_mark1").alias("up_sudden_event"), F.col("ev_mark2").alias("down_sudden_event"),
        F.col("ev_mark3").alias("turn_sudden_event"))


def accidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accidents ``(accident_no, driver)``; some have no known driver."""
    return (table(spark, sf_dir, "events").where("event_type = 'error' AND value > 150")
            .select(F.col("event_id").alias("accident_no"),
                    F.when(F.col("event_id") % 50 != 0, F.col("user_id").cast("string")).alias("driver")))


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cells of two families; every third order has a newer price."""
    orders = table(spark, sf_dir, "orders").select(
        F.reverse(F.col("o_orderkey").cast("string")).alias("rowkey"), "o_orderkey",
        F.format_string("%.2f", "o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderpriority").alias("priority"))
    first = put_columns(orders, {"o": ["price", "status"], "m": ["date", "priority"]},
                        F.col("o_orderkey"), key="rowkey")
    newer = put_columns(
        orders.where("o_orderkey % 3 = 0").withColumn("price", F.concat(F.lit("9"), "price")),
        {"o": ["price"]}, F.col("o_orderkey") + 1_000_000_000, key="rowkey")
    return union_cells(first, newer)
