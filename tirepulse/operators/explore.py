"""Exploration queries over the two report tables.

Vehicle filters are optional parameters: with ``vehicle_id=None`` the filter
queries run over the whole fleet (a scan + filter + projection, no shuffle).
Filters are plain column predicates on the scan, so they reach Parquet as
pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tirepulse.functions.expr import any_positive
from tirepulse.operators.common import half_open_window
from tirepulse.sources.schema import LEVELS, SIDES, level_col, level_dur_cols, optimal_col

# Short column prefixes the exploration exports use per metric.
METRIC_PREFIX = {"temperature": "temp", "cold_pressure": "cold_p", "hot_pressure": "hot_p"}


def _vehicle(df: DataFrame, vehicle_id: int | None) -> DataFrame:
    return df if vehicle_id is None else df.filter(F.col("vehicle_id") == F.lit(vehicle_id))


def device_sensor_join_counts(devices: DataFrame, sensors: DataFrame) -> DataFrame:
    """Size of the device x sensor join on ``vehicle_id`` (all dates), per vehicle.

    The source joins every hub report with every sensor report of the vehicle.
    Emitting those pairs grows quadratically per vehicle, so both sides are
    first reduced to one count per vehicle and the pair count is their product.
    """
    d = devices.filter(F.col("vehicle_id").isNotNull()).groupBy("vehicle_id") \
        .agg(F.count(F.lit(1)).alias("device_reports"))
    s = sensors.filter(F.col("vehicle_id").isNotNull()).groupBy("vehicle_id") \
        .agg(F.count(F.lit(1)).alias("sensor_reports"))
    return (d.join(s, "vehicle_id")
            .withColumn("joined_rows", F.col("device_reports") * F.col("sensor_reports")))


# Parts into which the sensor reports of the one vehicle are dealt.
COMPARE_PARTS = 32


def transmission_comparison(devices: DataFrame, sensors: DataFrame, vehicle_id: int,
                            start: str, end: str) -> DataFrame:
    """Hub reports of one vehicle in [start, end) next to each sensor report of that
    vehicle in the same range (left join: hubs without sensor reports are kept).

    The range on the sensor side is part of the join condition in the source;
    applying it (and the vehicle) as a filter before the join is equivalent.
    Every row shares one vehicle, so the sensor reports are dealt into
    ``COMPARE_PARTS`` parts by id and each hub report meets every part: the join
    key is (vehicle, part), and no task gets all rows. Hub reports are added
    back without a partner if the vehicle has no sensor report.
    """
    if vehicle_id is None:
        raise ValueError("the comparison is of one vehicle: give its id")
    d = _vehicle(half_open_window(devices, start, end), vehicle_id)
    s = _vehicle(half_open_window(sensors, start, end), vehicle_id)
    # Output names of the comparison.
    hub_cols = [("id", "d_id"), ("vehicle_id", "vehicle_id"), ("device_id", "device_id"),
                ("transmission_level", "d_tr"), ("transmitting_dur", "d_tdur"),
                ("not_transmitting_dur", "d_ntdur"), ("report_start_at", "drsat"), ("updated_at", "duat")]
    sensor_cols = [("id", "id"), ("sensor_id", "sensor_id"), ("wheel_id", "wheel_id"),
                   ("wheel_position", "wheel_position"), ("transmission_level", "s_tr"),
                   ("transmitting_dur", "s_tdur"), ("not_transmitting_dur", "s_ntdur"),
                   ("report_start_at", "ssat"), ("updated_at", "suat")]
    hubs = d.select(*[F.col(c).alias(a) for c, a in hub_cols])
    readings = s.select(F.col("vehicle_id").alias("_v"), *[F.col(c).alias(a) for c, a in sensor_cols])
    dealt = readings.withColumn("_part", F.pmod(F.xxhash64("id", "sensor_id", "ssat"), F.lit(COMPARE_PARTS)).cast("int"))
    every = hubs.withColumn("_part_d", F.explode(F.sequence(F.lit(0), F.lit(COMPARE_PARTS - 1))))
    names = [a for _, a in hub_cols + sensor_cols]
    matched = every.join(dealt, (F.col("vehicle_id") == F.col("_v")) & (F.col("_part_d") == F.col("_part"))).select(*names)
    seen = s.select(F.col("vehicle_id").alias("_v")).distinct()
    alone = (hubs.join(seen, F.col("vehicle_id") == F.col("_v"), "left_anti")
             .select("*", *[F.lit(None).cast(s.schema[c].dataType).alias(a) for c, a in sensor_cols]))
    return matched.unionByName(alone)


def transmission_order():
    return [F.col("drsat").desc_nulls_last(), F.col("ssat").desc_nulls_last()]


def level_profile(sensors: DataFrame, metric: str, vehicle_id: int | None,
                  start: str, end: str) -> DataFrame:
    """Time and entries per level of one metric for each sensor report in [start, end).

    Output names (fixed values) follow the exploration export (the same short names for all
    three metrics): ``s_l{1..3}{h,l}td`` durations, ``s_otd`` optimal,
    ``s_l{1..3}{h,l}tc`` counts.
    """
    df = _vehicle(half_open_window(sensors, start, end), vehicle_id)
    # fixed values: output names
    durs = [F.col(level_col(lv, sd, metric)).alias(f"s_l{lv}{sd[0]}td") for sd in SIDES for lv in LEVELS]
    cnts = [F.col(level_col(lv, sd, metric, "cnt")).alias(f"s_l{lv}{sd[0]}tc") for sd in SIDES for lv in LEVELS]
    return df.select(
        "id", "sensor_id", F.col("wheel_id").alias("swid"), F.col("wheel_position").alias("swpos"),
        F.col("transmission_level").alias("s_tr"), *durs,
        F.col(optimal_col(metric)).alias("s_otd"), *cnts,
        F.col("transmitting_dur").alias("s_tdur"), F.col("not_transmitting_dur").alias("s_ntdur"),
        F.col("report_start_at").alias("ssat"))


def level_profile_order():
    return [F.col("ssat").desc_nulls_last()]


def level_excursions(sensors: DataFrame, metric: str, vehicle_id: int | None = None) -> DataFrame:
    """Sensor reports with any time outside the optimal level of ``metric`` (all dates)."""
    p = METRIC_PREFIX[metric]
    df = _vehicle(sensors, vehicle_id).filter(any_positive(level_dur_cols(metric)))
    levels = [F.col(level_col(lv, sd, metric)).alias(f"{p}_l{lv}_{sd}_dur") for sd in SIDES for lv in LEVELS]
    return df.select(
        "vehicle_id", F.col("vehicle_out_of_service").alias("v_out_of_service"),
        F.col("vehicle_maintenance").alias("v_maintenance"), "sensor_id", "wheel_position", "wheel_id",
        F.col(optimal_col(metric)).alias(f"{p}_optimal_dur"), *levels,
        f"{metric}_min", f"{metric}_max", f"{metric}_sd", f"{metric}_avg",
        "report_start_at", "updated_at")


def excursion_order():
    return [F.col("report_start_at").desc_nulls_last(), F.col("vehicle_id").asc_nulls_last(),
            F.col("sensor_id").asc_nulls_last(), F.col("wheel_position").asc_nulls_last()]


def silent_devices(devices: DataFrame, seconds: int = 86_000) -> DataFrame:
    """Hub reports silent for more than ``seconds`` of the day."""
    return devices.filter(F.col("not_transmitting_dur") > seconds).select(
        "vehicle_id", F.col("vehicle_out_of_service").alias("v_out_of_service"),
        F.col("vehicle_maintenance").alias("v_maintenance"), "device_id", "transmitting_dur",
        "not_transmitting_dur", "transmission_level", "report_start_at", "updated_at")


def silent_order():
    return [F.col("report_start_at").desc_nulls_last(), F.col("vehicle_id").asc_nulls_last(),
            F.col("device_id").asc_nulls_last()]


def data_quality(sensors: DataFrame, devices: DataFrame) -> DataFrame:
    """Invariants of the report tables, one row per table.

    ``duplicate_ids``: ids used more than once; ``grain_violations``: extra
    reports beyond one per (sensor, day) or (vehicle, hub, day); ``bad_durations``: durations outside
    0..86,400 s. Each is a grouped count (map-side combined), never a collect.
    """
    def check(df, assets, table):
        t, s = F.col("transmitting_dur"), F.col("not_transmitting_dur")
        bad = ((t < 0) | (t > 86_400) | (s < 0) | (s > 86_400))
        # one grouping per (asset, day) gives rows, bad durations and grain together
        per_day = df.groupBy(*assets, F.to_date("report_start_at").alias("d")).agg(
            F.count(F.lit(1)).alias("k"), F.sum(F.when(bad, 1).otherwise(0)).alias("b"))
        zero = F.lit(0).cast("bigint")
        totals = per_day.agg(F.coalesce(F.sum("k"), zero).cast("bigint").alias("report_rows"),
                             F.coalesce(F.sum("b"), zero).cast("bigint").alias("bad_durations"),
                             F.coalesce(F.sum(F.col("k") - 1), zero).cast("bigint").alias("grain_violations"))
        dup = df.groupBy("id").agg(F.count(F.lit(1)).alias("k")) \
            .agg(F.coalesce(F.sum(F.col("k") - 1), zero).cast("bigint").alias("duplicate_ids"))
        return totals.select(F.lit(table).alias("table_name"), "report_rows", "bad_durations",
                             dup.scalar().alias("duplicate_ids"), "grain_violations")
    return check(sensors, ["sensor_id"], "time_in_level_sensor").unionByName(
        check(devices, ["vehicle_id", "device_id"], "time_in_level_device"))
