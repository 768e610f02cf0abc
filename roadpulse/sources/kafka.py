"""Kafka in and out. The Spark Kafka package has to be on the class path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from .records import L_EVENT, parse_records


def source_options(servers: str, topics: Sequence[str], start: str = "latest",
                   per_trigger: int | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": start,
               "failOnDataLoss": "false"}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return {**options, **(extra or {})}


def read_values(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Stream of record texts."""
    return (spark.readStream.format("kafka").options(**options).load()
            .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                    F.col("timestamp").alias("received")))


def telemetry(values: DataFrame, layout: Sequence[str] = L_EVENT, unit: str = "ms") -> DataFrame:
    """Fixes from record texts. A hash of the record stands in for an id, as the
    wire format has none; it only settles the order of equal times."""
    keyed = values.withColumn("event_id", F.xxhash64("value"))
    return parse_records(keyed, layout, unit=unit, keep=["event_id"])


def writer(messages: DataFrame, servers: str, topic: str, checkpoint: str,
           every: str = "1 second") -> DataStreamWriter:
    """Writer of (key, value) messages to a topic."""
    return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every))
