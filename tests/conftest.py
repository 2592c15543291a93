from __future__ import annotations

import os

import pytest

from eventloom.session import get_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "eventloom-tests",
        master=f"local[{os.cpu_count() or 4}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.session.timeZone": "UTC",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def zone(request, spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)
