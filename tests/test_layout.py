"""Bucketed report tables: no exchange below windows and joins, same rows."""

import re

import pytest

from tirepulse.operators import features
from tirepulse.sources import layout
from tirepulse.sources.fixtures import load_reports

S, E = "2024-01-01", "2024-01-31"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def reports(spark):
    return load_reports(spark, "/root/testdata/sf0.001")


def test_windows_of_a_bucketed_table_need_no_exchange(spark, reports, tmp_path):
    sensors, _ = reports
    table = layout.write_bucketed(sensors, "bucketed_wheels", str(tmp_path / "wheels"), "sensor_id", 4)
    try:
        rolled = features.rolling_stats(table, S, E)
        plan = _plan(rolled)
        assert "Window" in plan and not re.search(r"\bExchange\b", plan), plan
        assert _rows(rolled) == _rows(features.rolling_stats(sensors, S, E))
        spark.sql("DROP TABLE bucketed_wheels")
        again = layout.register_bucketed(spark, sensors.schema, "bucketed_wheels", str(tmp_path / "wheels"), "sensor_id", 4)
        assert again.count() == sensors.count()
        assert not re.search(r"\bExchange\b", _plan(features.rolling_stats(again, S, E)))
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_wheels")


def test_the_hub_join_of_bucketed_tables_needs_no_exchange(spark, reports, tmp_path):
    sensors, devices = reports
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(name, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wheels = layout.write_bucketed(sensors, "bucketed_wheels", str(tmp_path / "w"), "vehicle_id", 4)
        hubs = layout.write_bucketed(devices, "bucketed_hubs", str(tmp_path / "h"), "vehicle_id", 4)
        joined = features.device_features(hubs, wheels, S, E)
        plan = _plan(joined)
        assert "Join" in plan and not re.search(r"\bExchange\b", plan), plan
        assert _rows(joined) == _rows(features.device_features(devices, sensors, S, E))
    finally:
        spark.conf.unset(name)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("bucketed_wheels", "bucketed_hubs"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_missing_sensors_and_no_rows(spark, reports, tmp_path):
    from pyspark.sql import functions as F
    sensors = reports[0].withColumn("sensor_id", F.when(F.col("sensor_id") % 2 == 0, F.col("sensor_id")))
    try:
        table = layout.write_bucketed(sensors, "bucketed_some", str(tmp_path / "some"), "sensor_id", 3)
        assert _rows(features.rolling_stats(table, S, E)) == _rows(features.rolling_stats(sensors, S, E))
        none = layout.write_bucketed(sensors.limit(0), "bucketed_none", str(tmp_path / "none"), "sensor_id", 3)
        assert features.rolling_stats(none, S, E).count() == 0
    finally:
        for t in ("bucketed_some", "bucketed_none"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
