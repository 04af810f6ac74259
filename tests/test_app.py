"""End to end: raw CSV report files -> all four reports through the batch entry point."""

import glob
import os
import tempfile

from tirepulse import app
from tirepulse.sources.fixtures import load_reports
from tirepulse.sources.schema import DEVICE_TABLE, SENSOR_TABLE


def _write_csv_table(spark, df, folder, table):
    # data file with a header row whose names differ (they are ignored)
    tmp = os.path.join(folder, f"_{table}")
    df.toDF(*[f"c{i}" for i in range(len(df.columns))]).coalesce(1) \
      .write.option("header", True).csv(tmp)
    part = glob.glob(f"{tmp}/part-*.csv")[0]
    os.rename(part, os.path.join(folder, f"{table}.csv"))
    with open(os.path.join(folder, f"{table}_desc.csv"), "w") as fh:
        fh.write("column_name|data_type\n" + "\n".join(f"{c}|x" for c in df.columns) + "\n")


def test_app_runs_all_reports_from_csv(spark):
    root = tempfile.mkdtemp(prefix="tp-app-")
    data, out = os.path.join(root, "data"), os.path.join(root, "output")
    os.makedirs(data)
    sensors, devices = load_reports(spark, "/root/testdata/sf0.001")
    _write_csv_table(spark, sensors, data, SENSOR_TABLE)
    _write_csv_table(spark, devices, data, DEVICE_TABLE)

    summary = app.run(spark, data, out, "2024-01-01", "2024-01-31",
                      ("fleet", "device", "anomaly", "mechanical"))
    assert 0 < summary["overall_availability"] <= 1
    assert summary["worst_device_efficiency"] is not None
    expected = ["report_sensor_availability_daily", "report_sensor_availability_monthly", "fleet_status",
                "report_device_connectivity", "anomalies_from_sensors", "sensor_issues", "device_issues",
                "sensor_variables", "sensor_statistics", "device_statistics"]
    for name in expected:
        assert glob.glob(f"{out}/{name}/part-*"), name
    issues = spark.read.option("header", True).csv(f"{out}/sensor_issues")
    assert issues.count() == sensors.count()   # every report in range is classified (all are in January)

    # reading back from CSV reproduces the typed tables exactly
    back_s, _ = app.load_tables(spark, data)
    assert sorted(map(tuple, back_s.collect())) == sorted(map(tuple, sensors.collect()))


def test_app_reads_month_partitioned_parquet(spark):
    root = tempfile.mkdtemp(prefix="tp-app-pq-")
    sensors, devices = load_reports(spark, "/root/testdata/sf0.001")
    os.makedirs(f"{root}/csv")
    _write_csv_table(spark, sensors, f"{root}/csv", SENSOR_TABLE)
    _write_csv_table(spark, devices, f"{root}/csv", DEVICE_TABLE)
    app.convert(spark, f"{root}/csv", f"{root}/data")
    summary = app.run(spark, f"{root}/data", f"{root}/out", "2024-01-01", "2024-01-31",
                      ("mechanical",), parquet=True)
    assert summary["mechanical_outputs"]
    issues = spark.read.option("header", True).csv(f"{root}/out/sensor_issues")
    assert issues.count() == sensors.count()
