"""Fleet indicators: sensor availability, fleet status, hub connectivity, KPIs.

Every aggregate is a grouped aggregation with map-side partial combine; exact
``COUNT(DISTINCT)`` is planned by Spark as a two-step aggregation (distinct
keys first), so no group is ever materialised in one task. Fleet-wide
constants (the sensor baseline) are scalar subqueries, not joins.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tirepulse.functions.expr import any_positive, fill0, ratio
from tirepulse.operators.common import report_date, report_window
from tirepulse.sources.schema import (
    LEVELS, METRICS, SECONDS_PER_DAY, level_col, optimal_col,
)


# --------------------------------------------------------------------------
# Sensor availability (daily, monthly, overall)
# --------------------------------------------------------------------------

def fleet_sensor_total(sensors: DataFrame) -> DataFrame:
    """Distinct sensors ever seen (the availability baseline; unfiltered)."""
    return sensors.agg(F.count_distinct("sensor_id").alias("total_fleet_count"))


def sensor_availability_daily(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Per day: distinct transmitting sensors vs all sensors ever seen.

    ``availability_pct`` is the share rounded to 2 decimals as a percentage and
    then divided by 100 (a fraction with 4 decimals, as the source exports it).
    Days on which no sensor transmitted produce no row.
    """
    total = fleet_sensor_total(sensors).scalar()
    daily = (report_window(sensors, start, end)
             .filter(F.col("transmitting_dur") > 0)
             .groupBy(report_date().alias("report_date"))
             .agg(F.count_distinct("sensor_id").alias("active_sensors")))
    return (daily
            .withColumn("total_sensors", total)
            .withColumn("availability_pct",
                        F.round(F.col("active_sensors") / F.col("total_sensors") * 100, 2) / 100)
            .withColumn("month_year", F.date_format("report_date", "yyyy-MM")))


def sensor_availability_monthly(daily: DataFrame) -> DataFrame:
    """Mean of the daily availability per month."""
    return daily.groupBy("month_year").agg(F.avg("availability_pct").alias("availability_pct"))


def sensor_availability_overall(daily: DataFrame) -> DataFrame:
    """Mean daily availability over the range; 0 when there is no day."""
    return daily.agg(F.coalesce(F.avg("availability_pct"), F.lit(0.0)).alias("overall_availability"))


# --------------------------------------------------------------------------
# Hub (device) indicators
# --------------------------------------------------------------------------

def _status_aggs():
    # The names are columns of the report's output.
    oos, mnt = F.col("vehicle_out_of_service"), F.col("vehicle_maintenance")
    one_if = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
    return [F.count_distinct("device_id").alias("total_devices"),
            one_if(oos > 0).alias("vehicles_out_of_service"),
            one_if(mnt > 0).alias("vehicles_in_maintenance"),
            one_if((oos == 0) & (mnt == 0)).alias("operational_fleet")]


def fleet_status(devices: DataFrame, start: str, end: str) -> DataFrame:
    """Per day: distinct hubs and hub-report counts by vehicle status.

    Counts are report rows (a vehicle with two hubs counts twice); a row can be
    both in maintenance and out of service; a NULL flag is in no bucket.
    """
    return (report_window(devices, start, end)
            .groupBy(report_date().alias("report_date"))
            .agg(*_status_aggs()))


def fleet_capacity_pct(devices: DataFrame, start: str, end: str) -> DataFrame:
    """Operational-capacity distribution: each status bucket over the day's hub reports.

    Our definition (the documents name the KPI without code): bucket count
    divided by the number of hub reports of that day. One aggregation computes
    the buckets and the denominator together.
    """
    out = (report_window(devices, start, end)
           .groupBy(report_date().alias("report_date"))
           .agg(*_status_aggs()[1:], F.count(F.lit(1)).alias("hub_reports")))
    return out.select("report_date", "hub_reports",
                      *[(F.col(n) / F.col("hub_reports")).alias(f"pct_{n}")
                        for n in ("operational_fleet", "vehicles_in_maintenance", "vehicles_out_of_service")])


def device_connectivity(devices: DataFrame, start: str, end: str) -> DataFrame:
    """Per (hub, vehicle, day): mean talk/silence seconds and uptime fraction.

    ``connectivity_efficiency_pct`` = round(ΣT / Σ(T+S) * 100, 2) / 100, NULL
    when the hub reported no time at all.
    """
    t, s = F.col("transmitting_dur"), F.col("not_transmitting_dur")
    return (report_window(devices, start, end)
            .groupBy("device_id", "vehicle_id", report_date().alias("report_date"))
            # fixed values: output names
            .agg(F.avg(t).alias("avg_transmit_sec"),
                 F.avg(s).alias("avg_silence_sec"),
                 (F.round(ratio(F.sum(t), F.sum(t + s)) * 100, 2) / 100)
                 .alias("connectivity_efficiency_pct")))


def worst_device(connectivity: DataFrame) -> DataFrame:
    """The hub-day with the lowest uptime (top-1 by design; ties by date, ids).

    Our reading of the disabled lookup: reports of vehicles without a hub have
    no device id and are no candidates.

    Spark plans ``orderBy().limit(1)`` as a distributed take-ordered: each
    task keeps its best row, the driver merges one row per task.
    """
    return (connectivity
            .filter(F.col("device_id").isNotNull())
            .orderBy(F.col("connectivity_efficiency_pct").asc_nulls_last(),
                     F.col("report_date").asc_nulls_last(),
                     F.col("device_id").asc_nulls_last(),
                     F.col("vehicle_id").asc_nulls_last())
            .limit(1)
            # fixed values: output names
            .select(F.col("device_id").alias("worst_device_id"),
                    F.col("vehicle_id"), F.col("report_date"),
                    F.col("connectivity_efficiency_pct").alias("worst_device_efficiency")))


def active_sensors_per_vehicle(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct transmitting sensors per (vehicle, day)."""
    return (report_window(sensors, start, end)
            .filter(F.col("transmitting_dur") > 0)
            .groupBy("vehicle_id", report_date().alias("report_date"))
            .agg(F.count_distinct("sensor_id").alias("active_sensors")))


# --------------------------------------------------------------------------
# KPIs defined in the documents without code (our definitions)
# --------------------------------------------------------------------------

def extreme_level_sensors(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Per day: distinct sensors with time in level 3 (high or low), per metric and overall.

    Our definition. Two explicit phases: flags are first reduced per
    (day, sensor) with a map-side combine, then summed per day, instead of
    four distinct aggregates (which Spark would plan with a 4x Expand).
    Reports without a sensor id count as no sensor, but their day has a row.
    """
    flags = {m: F.max(F.when(any_positive([level_col(3, sd, m) for sd in ("high", "low")]), 1)
                      .otherwise(0)) for m in METRICS}
    per_sensor = (report_window(sensors, start, end)
                  .groupBy(report_date().alias("report_date"), "sensor_id")
                  .agg(*[flags[m].alias(m) for m in METRICS]))
    known = lambda flag: F.sum(F.when(F.col("sensor_id").isNotNull(), flag).otherwise(0)).cast("bigint")
    return (per_sensor.groupBy("report_date")
            .agg(*[known(F.col(m)).alias(f"extreme_{m}_sensors") for m in METRICS],
                 known(F.greatest(*[F.col(m) for m in METRICS])).alias("extreme_sensors")))


def level_distribution(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Per day and metric: share of time in each of the 7 levels, and no-data share.

    Our definition: bucket share = Σ bucket duration / Σ all 7 bucket durations
    (NULL durations count as 0); ``pct_no_data`` = share of the day's sensor
    reports with ``transmitting_dur`` 0 or NULL. Aggregated first (one row per
    day), then unpivoted to one row per metric with ``stack``.
    """
    buckets = [("optimal", lambda m: optimal_col(m))]
    buckets += [(f"low_{lv}", (lambda lv: lambda m: level_col(lv, "low", m))(lv)) for lv in LEVELS]
    buckets += [(f"high_{lv}", (lambda lv: lambda m: level_col(lv, "high", m))(lv)) for lv in LEVELS]
    aggs = []
    for m in METRICS:
        for b, name in buckets:
            aggs.append(F.sum(fill0(name(m))).cast("bigint").alias(f"{m}__{b}"))
    no_data = (F.col("transmitting_dur").isNull()) | (F.col("transmitting_dur") == 0)
    daily = (report_window(sensors, start, end)
             .groupBy(report_date().alias("report_date"))
             .agg(*aggs,
                  F.sum(F.when(no_data, 1).otherwise(0)).cast("bigint").alias("no_data_reports"),
                  F.count(F.lit(1)).alias("reports")))
    names = [b for b, _ in buckets]
    stack_args = ", ".join(
        f"'{m}', " + ", ".join(f"`{m}__{b}`" for b in names) for m in METRICS)
    long = daily.selectExpr(
        "report_date", "no_data_reports", "reports",
        f"stack({len(METRICS)}, {stack_args}) AS (metric, {', '.join(names)})")
    total = reduce(add, [F.col(b) for b in names])
    return long.select(
        "report_date", "metric",
        *[ratio(F.col(b), total).alias(f"pct_{b}") for b in names],
        (F.col("no_data_reports") / F.col("reports")).alias("pct_no_data"))


def communication_pct(devices: DataFrame, start: str, end: str, grain: str = "day") -> DataFrame:
    """Share of time each vehicle's hubs transmitted, by day or month (percent).

    Our definition: 100 * ΣT / (86,400 * hub reports) over the vehicle's hub
    reports in the period. Expected time counts the days that have a report
    only; a hub that stopped reporting altogether is found by ``fleet_status``
    and ``silent_devices``, not here.
    """
    key = report_date().alias("report_date") if grain == "day" else \
        F.date_format(report_date(), "yyyy-MM").alias("month_year")
    return (report_window(devices, start, end)
            .groupBy("vehicle_id", key)
            .agg((F.sum("transmitting_dur") * 100.0 /
                  (F.count(F.lit(1)) * SECONDS_PER_DAY)).alias("communication_pct")))


def vehicle_active_sensor_pct(sensors: DataFrame, start: str, end: str, grain: str = "day") -> DataFrame:
    """Share of a vehicle's known sensors that transmitted, by day or month (percent).

    Our definition: distinct sensors with ``transmitting_dur > 0`` in the
    period / distinct sensors of the vehicle over all history, for each period
    in which the vehicle has a sensor report: 0 % if all were silent, NULL if
    none of its reports names a sensor. A NULL vehicle is a group like any
    other. The per-vehicle baseline is one row per vehicle; the join is a plain
    equi-join (AQE picks broadcast only if its measured size is small).
    """
    key = report_date().alias("report_date") if grain == "day" else \
        F.date_format(report_date(), "yyyy-MM").alias("month_year")
    period = "report_date" if grain == "day" else "month_year"
    known = (sensors.groupBy(F.col("vehicle_id").alias("_vehicle"))
             .agg(F.count_distinct("sensor_id").alias("known_sensors")))
    active = (report_window(sensors, start, end).groupBy("vehicle_id", key)
              .agg(F.count_distinct(F.when(F.col("transmitting_dur") > 0, F.col("sensor_id"))).alias("active_sensors")))
    return (active.join(known, F.col("vehicle_id").eqNullSafe(F.col("_vehicle")))
            .select("vehicle_id", period, "active_sensors", "known_sensors",
                    ratio(F.col("active_sensors") * 100.0, "known_sensors").alias("active_sensor_pct")))
