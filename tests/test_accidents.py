from pyspark.sql import functions as F

from roadpulse.operators.accidents import driver_number


def test_job_numbers_that_are_no_numbers(spark):
    rows = spark.createDataFrame([("007",), ("A12",), (None,), ("",)], "d string").select(driver_number(F.col("d")).alias("n"))
    assert [r.n for r in rows.collect()] == ["7", "A12", "0", ""]
