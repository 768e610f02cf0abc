"""Session set-up shared by the bench, the tests and ad-hoc use."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_local_dir: str | None = None


def build_session(app: str = "roadpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Anything a cluster already sets (shuffle partitions, checkpoint folder,
    memory) is left alone: only the semantics-bearing settings are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    The cluster's ``spark.checkpoint.dir`` wins. A temporary folder is made
    only where nothing is set and the master is local, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="roadpulse-ckpt-")
    return _local_dir


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    For results that several later passes read: they are computed once, the
    lineage ends here, and a lost executor only costs a re-read. The folder is
    the cluster's to expire, as for any checkpoint.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/roadpulse/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_cores() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
