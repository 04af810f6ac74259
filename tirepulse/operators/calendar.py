"""Indicators over the calendar: days without a report count as silent, not as absent.

An asset (a hub of a vehicle, a vehicle, a sensor) is expected from its first
report in the range to the last day on which the fleet reported. Expected days
come from one row an asset (its first day), exploded into days or summed up over
the calendar; they are added to the reports by a union and one grouped sum, so
there is no fleet x days cross join and no join back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tirepulse.functions.expr import ratio
from tirepulse.operators.common import report_date, report_window
from tirepulse.sources.schema import SECONDS_PER_DAY


def _days(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each key and day from the key's first day to the last day of ``rows``."""
    last = rows.agg(F.max("report_date")).scalar()
    return (rows.groupBy(*keys).agg(F.min("report_date").alias("_first"))
            .select(*keys, F.explode(F.sequence("_first", last)).alias("report_date")))


def _period(grain: str) -> Column:
    return F.col("report_date") if grain == "day" else F.date_format("report_date", "yyyy-MM").alias("month_year")


def communication_calendar(devices: DataFrame, start: str, end: str, grain: str = "day") -> DataFrame:
    """Share of time each vehicle's hubs transmitted, of all days on which they were expected (percent).

    Our definition: 100 * ΣT / (86,400 * expected hub-days). A hub that stops
    reporting counts as 0 % until the fleet's last day; hub reports without a
    hub id are one hub of their vehicle.
    """
    rows = report_window(devices, start, end).select("vehicle_id", "device_id", report_date().alias("report_date"), "transmitting_dur")
    rows = rows.filter(F.col("report_date").isNotNull())
    none = F.lit(0).cast("bigint")
    both = (rows.select("vehicle_id", "report_date", F.col("transmitting_dur").cast("bigint").alias("t"), none.alias("e"), (none + 1).alias("r"))
            .unionByName(_days(rows, ["vehicle_id", "device_id"])
                         .select("vehicle_id", "report_date", none.alias("t"), (none + 1).alias("e"), none.alias("r"))))
    return (both.groupBy("vehicle_id", _period(grain))
            .agg(F.sum("e").alias("expected_days"), F.sum("r").alias("reports"),
                 (F.sum("t") * 100.0 / (F.sum("e") * SECONDS_PER_DAY)).alias("communication_pct")))


def active_sensor_calendar(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Share of a vehicle's known sensors that transmitted on each day since its first report (percent).

    Our definition: as ``kpis.vehicle_active_sensor_pct`` by day, with a row of 0
    for the days on which no sensor of the vehicle reported.
    """
    known = (sensors.groupBy(F.col("vehicle_id").alias("_vehicle")).agg(F.count_distinct("sensor_id").alias("known_sensors")))
    rows = report_window(sensors, start, end).select("vehicle_id", report_date().alias("report_date"), "sensor_id", "transmitting_dur")
    rows = rows.filter(F.col("report_date").isNotNull())
    active = rows.select("vehicle_id", "report_date", F.when(F.col("transmitting_dur") > 0, F.col("sensor_id")).alias("active"))
    silent = _days(rows, ["vehicle_id"]).withColumn("active", F.lit(None).cast(dict(rows.dtypes)["sensor_id"]))
    daily = active.unionByName(silent).groupBy("vehicle_id", "report_date").agg(F.count_distinct("active").alias("active_sensors"))
    return (daily.join(known, F.col("vehicle_id").eqNullSafe(F.col("_vehicle")))
            .select("vehicle_id", "report_date", "active_sensors", "known_sensors",
                    ratio(F.col("active_sensors") * 100.0, "known_sensors").alias("active_sensor_pct")))


def sensor_coverage(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Per calendar day: sensors expected, reporting and transmitting, and the share without data.

    Our definition: a sensor is expected from its first report in the range on;
    ``pct_no_data`` = share of the expected sensors that did not transmit, whether
    silent or without a report. Days on which nothing reported have a row. The
    expected sensors are a running sum over the calendar (one row a day).
    """
    rows = report_window(sensors, start, end).select(report_date().alias("report_date"), "sensor_id", "transmitting_dur")
    rows = rows.filter(F.col("sensor_id").isNotNull() & F.col("report_date").isNotNull())
    per_sensor = (rows.groupBy("sensor_id", "report_date")
                  .agg(F.max(F.when(F.col("transmitting_dur") > 0, 1).otherwise(0)).alias("on")))
    told = per_sensor.groupBy("report_date").agg(F.count(F.lit(1)).alias("reporting"), F.sum("on").alias("transmitting"))
    new = (per_sensor.groupBy("sensor_id").agg(F.min("report_date").alias("report_date"))
           .groupBy("report_date").agg(F.count(F.lit(1)).alias("new")))
    bounds = rows.agg(F.min("report_date").alias("a"), F.max("report_date").alias("b")).filter("a IS NOT NULL")
    calendar = bounds.select(F.explode(F.sequence("a", "b")).alias("report_date"))
    so_far = Window.orderBy("report_date").rowsBetween(Window.unboundedPreceding, 0)       # one row a day of the range
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    daily = (calendar.join(told, "report_date", "left").join(new, "report_date", "left")
             .select("report_date", F.sum(zero("new")).over(so_far).alias("expected_sensors"),
                     zero("reporting").alias("reporting_sensors"), zero("transmitting").alias("transmitting_sensors")))
    return daily.withColumn("pct_no_data", 1 - F.col("transmitting_sensors") / F.col("expected_sensors"))
