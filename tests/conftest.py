import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

BASE = datetime(2026, 1, 1, 10, 0, 0)
TELEMETRY_DDL = ("timestamp timestamp, device_id string, state string, rpm int, temp_c double, vibration_g double, "
                 "current_a double, voltage_v double, error_code int, anomaly_tag string")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("sensorloom-tests")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(minutes: float) -> datetime:
    return BASE + timedelta(minutes=minutes)


@pytest.fixture
def telemetry(spark):
    """Rows as dicts with defaults to a telemetry frame with a row id."""
    def build(rows):
        full = []
        for i, row in enumerate(rows):
            base = dict(timestamp=at(i), device_id="DEV-0001", state="RUN", rpm=1700, temp_c=50.0, vibration_g=0.2,
                        current_a=4.0, voltage_v=24.0, error_code=0, anomaly_tag=" ")
            base.update(row)
            full.append((*base.values(), i))
        return spark.createDataFrame(full, TELEMETRY_DDL + ", row_id bigint")
    return build


@pytest.fixture
def events(spark):
    """Flagged readings: (device, minutes) pairs, or dicts with more fields."""
    def build(rows):
        full = []
        for row in rows:
            row = row if isinstance(row, dict) else {"device_id": row[0], "minutes": row[1]}
            full.append((at(row["minutes"]), row.get("device_id", "DEV-001"), row.get("state", "RUN"),
                         row.get("score", 0.16), row.get("pred", 1), row.get("anomaly_tag"),
                         row.get("families_sorted", []), row.get("top_features", [("feature_1", 10.0)])))
        return spark.createDataFrame(full, "timestamp timestamp, device_id string, state string, score double, pred int, "
                                     "anomaly_tag string, families_sorted array<struct<family:string,pct:double>>, "
                                     "top_features array<struct<feature:string,pct:double>>")
    return build
