import json
import os
import sys
import time

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("creditloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")  # large results are fetched from there
        .config("spark.sql.debug.maxToStringFields", "1000")  # plans are compared as text
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{tmp_path_factory.mktemp('events')}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collect as a sorted list of plain tuples (NULLs sort as text)."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def shuffled_rows(spark):
    """``shuffled_rows(action)``: for each stage that ``action`` runs, the rows that its tasks read from shuffles."""
    folder = spark.conf.get("spark.eventLog.dir").removeprefix("file://")

    def events():
        for name in os.listdir(folder):
            with open(f"{folder}/{name}") as file:
                yield from filter(None, map(str.strip, file))

    def measure(action):
        known = sum(1 for _ in events())
        action()
        spark.range(1).selectExpr("'the end' AS x").count()
        stages, seen = {}, -1
        while seen != (seen := sum(1 for _ in events())):
            time.sleep(1)  # the log is written behind the jobs
        for line in list(events())[known:]:
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                stages.setdefault(event["Stage ID"], []).append(read)
        return [tasks for tasks in stages.values() if sum(tasks)]

    return measure
