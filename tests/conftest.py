import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadpulse.session import build_session

    session = build_session("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "1000",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def fixes(spark, data):
    from roadpulse.plans.fixture import telemetry

    return telemetry(spark, data)
