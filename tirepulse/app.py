"""Batch entry point: load both report tables and write the reports.

    python -m tirepulse.app --data data/ --output output/ \\
        --start 2023-01-01 --end 2023-12-31 [--reports device,mechanical,fleet,anomaly]

``--data`` holds ``time_in_level_{device,sensor}_desc.csv`` (column order,
``|``-separated) and ``time_in_level_{device,sensor}.csv`` (data; its own
header row is ignored). ``--parquet`` reads month-partitioned Parquet tables
written by ``sources.ingest.write_reports`` instead; ``--write-parquet DIR``
converts the CSV tables once and then reads the Parquet copy. The default report set is
the hub health report and the mechanical-failure report; the fleet (sensor
availability) and anomaly reports are available by name.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from tirepulse.plans import reports
from tirepulse.session import ensure_checkpoint_dir
from tirepulse.sources import ingest
from tirepulse.sources.schema import DEVICE_TABLE, SENSOR_TABLE

log = logging.getLogger("tirepulse")
DEFAULT_REPORTS = ("device", "mechanical")


def load_tables(spark: SparkSession, data: str, parquet: bool = False):
    if parquet:
        return (ingest.read_reports(spark, f"{data}/{SENSOR_TABLE}"),
                ingest.read_reports(spark, f"{data}/{DEVICE_TABLE}"))
    sensors = ingest.load_sensor_reports(spark, f"{data}/{SENSOR_TABLE}_desc.csv", f"{data}/{SENSOR_TABLE}.csv")
    devices = ingest.load_device_reports(spark, f"{data}/{DEVICE_TABLE}_desc.csv", f"{data}/{DEVICE_TABLE}.csv")
    return sensors, devices


def convert(spark: SparkSession, data: str, target: str) -> None:
    """One-time conversion of the raw CSV tables to month-partitioned Parquet."""
    sensors, devices = load_tables(spark, data)
    ingest.write_reports(sensors, f"{target}/{SENSOR_TABLE}")
    ingest.write_reports(devices, f"{target}/{DEVICE_TABLE}")


def run(spark: SparkSession, data: str, output: str, start: str, end: str,
        which=DEFAULT_REPORTS, parquet: bool = False) -> dict:
    """Run the selected reports; returns a small summary (no data rows)."""
    ensure_checkpoint_dir(spark)
    sensors, devices = load_tables(spark, data, parquet)
    ingest.register_views(sensors, devices)
    summary = {}
    if "fleet" in which:
        out = reports.generate_fleet_health_report(sensors, start, end, output)
        summary["overall_availability"] = out["overall_availability"]
    if "device" in which:
        out = reports.generate_device_health_report(devices, start, end, output)
        summary["worst_device_id"] = out["worst_device_id"]
        summary["worst_device_efficiency"] = out["worst_device_efficiency"]
    if "anomaly" in which:
        reports.sensor_anomaly_detection(sensors, start, end, f"{output}/anomalies_from_sensors")
        summary["anomaly_output"] = f"{output}/anomalies_from_sensors"
    if "mechanical" in which:
        names = reports.MechanicalPaths.__dataclass_fields__
        paths = reports.MechanicalPaths(**{k: f"{output}/{k}" for k in names})
        reports.generate_mechanical_failure_report(sensors, devices, start, end, paths)
        summary["mechanical_outputs"] = list(names)
    log.info("reports written: %s", summary)
    return summary


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--data", default="data")
    ap.add_argument("--output", default="output")
    ap.add_argument("--start", required=True)
    ap.add_argument("--end", required=True)
    ap.add_argument("--reports", default=",".join(DEFAULT_REPORTS))
    ap.add_argument("--parquet", action="store_true", help="--data holds Parquet tables")
    ap.add_argument("--write-parquet", metavar="DIR",
                    help="first convert the CSV tables under --data to Parquet in DIR, then read those")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("tirepulse").getOrCreate()
    if args.write_parquet:
        convert(spark, args.data, args.write_parquet)
        args.data, args.parquet = args.write_parquet, True
    summary = run(spark, args.data, args.output, args.start, args.end,
                  tuple(args.reports.split(",")), args.parquet)
    print(json.dumps(summary, default=str))


if __name__ == "__main__":
    main()
