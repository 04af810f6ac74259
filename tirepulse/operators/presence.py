"""Exact distinct sensors from bitmaps that add up.

``presence`` keeps, per day and bucket of 32,768 sensor ids, a bitmap of the sensors that
reported and one of those that transmitted. Bitmaps of the same bucket are merged by
OR, so the sensors of a month, or of all history, are exact without reading the
reports again, and a day that is delivered in parts is merged likewise. A row
holds two bitmaps of 4 KB; a fleet of a million sensors has 31 rows a day.

The report range includes only midnight of its last day, as in the source; so
reports at midnight and later ones of a day have rows of their own (``midnight``).
Reports without a sensor id are of no sensor; days keep a row for each bucket that reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.operators.common import TS, report_date

KEYS = ["report_date", "midnight", "bucket"]


def presence(sensors: DataFrame) -> DataFrame:
    """report_date, midnight, bucket, seen and active bitmaps of some reports; one partial aggregation."""
    at = F.bitmap_bit_position("sensor_id")
    active = F.when(F.col("transmitting_dur") > 0, at)
    rows = sensors.filter(F.col("sensor_id").isNotNull() & F.col(TS).isNotNull())
    return (rows.groupBy(report_date().alias("report_date"), (F.col(TS) == F.to_date(TS).cast(rows.schema[TS].dataType)).alias("midnight"),
                         F.bitmap_bucket_number("sensor_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(at).alias("seen"), F.bitmap_construct_agg(active).alias("active")))


def merged(*parts: DataFrame) -> DataFrame:
    """Presence of several deliveries, one row a key."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*KEYS).agg(F.bitmap_or_agg("seen").alias("seen"), F.bitmap_or_agg("active").alias("active"))


def _sensors(table: DataFrame, kind: str, *by: str) -> DataFrame:
    """Distinct sensors by the given columns: OR within a bucket, then a sum over the buckets."""
    buckets = table.groupBy(*by, "bucket").agg(F.bitmap_or_agg(kind).alias("_b"))
    return buckets.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("_b")), F.lit(0)).cast("bigint").alias("sensors"))


def _in_range(start: str, end: str) -> Column:
    """Days of a closed range of date bounds: of the last day only midnight."""
    day, last = F.col("report_date"), F.lit(end).cast("date")
    return (day >= F.lit(start).cast("date")) & ((day < last) | ((day == last) & F.col("midnight")))


def fleet_total(table: DataFrame) -> DataFrame:
    """Distinct sensors of all history (as ``kpis.fleet_sensor_total``)."""
    return _sensors(table, "seen").select(F.col("sensors").alias("total_fleet_count"))


def availability_daily(table: DataFrame, start: str, end: str) -> DataFrame:
    """As ``kpis.sensor_availability_daily``, from the bitmaps alone."""
    total = fleet_total(table).scalar()
    daily = _sensors(table.filter(_in_range(start, end)), "active", "report_date").filter("sensors > 0")
    return daily.select(
        "report_date", F.col("sensors").alias("active_sensors"), total.alias("total_sensors"),
        (F.round(F.col("sensors") / total * 100, 2) / 100).alias("availability_pct"),
        F.date_format("report_date", "yyyy-MM").alias("month_year"))


def sensors_monthly(table: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct sensors that reported and that transmitted in each month of a range."""
    months = table.filter(_in_range(start, end)).withColumn("month_year", F.date_format("report_date", "yyyy-MM"))
    seen, active = (_sensors(months, k, "month_year").withColumnRenamed("sensors", f"{k}_sensors") for k in ("seen", "active"))
    return seen.join(active, "month_year")
