import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import build_session

    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def logs(spark):
    from tidegauge.sources.events import event_logs

    return event_logs(spark, SF).cache()


@pytest.fixture
def make_logs(spark):
    """Normalised logs from (seconds, ip, url, status, response_time) rows, event ids in row order."""
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from tidegauge.sources.logs import normalize_logs

    schema = (
        "event_id bigint, event_timestamp timestamp, source_ip string, method string, url string, "
        "status_code int, bytes_sent int, response_time double, user_agent string"
    )

    def build(rows, start=datetime(2024, 1, 1)):
        full = [
            (i, start + timedelta(seconds=r[0]), r[1], "GET", r[2], r[3], 100, r[4], "Mozilla/5.0")
            for i, r in enumerate(rows)
        ]
        return normalize_logs(spark.createDataFrame(full, schema).withColumn("timestamp", F.lit(None).cast("string")))

    return build
