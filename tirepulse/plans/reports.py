"""The four reports: compositions of operators, each ending in its sinks.

Every function takes the two typed report DataFrames; writing happens only
when an output folder/path is given. Of the mechanical-failure report's outputs
only the sensor issues need the windows; the others are projections of the
report rows or of the hub join, so nothing has to be kept between them.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tirepulse.operators import explore, features, forest, forest_model, kpis, rules
from tirepulse.operators.windows import rolling
from tirepulse.session import discard, discard_at_exit, stored
from tirepulse.sources.sinks import export, export_counted

log = logging.getLogger(__name__)

# Model settings of the anomaly report.
FOREST_TREES = 100
FOREST_CONTAMINATION = 0.04
FOREST_SEED = 42
FOREST_SAMPLE = 256

# Output columns of the anomaly report.
ANOMALY_COLUMNS = ["id", "report_date", "sensor_id", "vehicle_id", "wheel_position",
                   "temperature_avg", "cold_pressure_avg", "hot_pressure_avg",
                   "is_anomaly_global", "anomaly_category", "anomaly_detail_text",
                   "z_temp", "z_cold", "z_hot"]


# What the flags, the reasons and the output read of a report's row.
SCORED_COLUMNS = list(dict.fromkeys(
    ["id", "report_date", "sensor_id", "vehicle_id", "wheel_position", *features.MODEL_FEATURES, "z_dur_temp"]))


MODEL_INPUTS = [f"in_{c}" for c in features.MODEL_FEATURES]


def anomaly_scores(sensors: DataFrame, start: str, end: str, trees: int = FOREST_TREES,
                   contamination: float = FOREST_CONTAMINATION, seed: int = FOREST_SEED,
                   sample: int = FOREST_SAMPLE) -> DataFrame:
    """Statistical features + isolation-forest verdict per sensor report.

    The nine model inputs are rounded and standardised (population stddev) before the
    forest, as in the source; the z-score and reason columns pass through the
    scoring step, so no join back is needed.
    """
    # Store the window output once, in the columns that the report needs: the
    # scaler fit, the sampling and the scoring all read it.
    z, path = stored(features.sensor_zscores(sensors, start, end).select(*SCORED_COLUMNS), "anomaly-features")
    scaled = features.with_scaled(features.model_inputs(z), MODEL_INPUTS, prefix="sc_")
    scored = forest.isolation_forest(
        scaled, "id", [f"sc_{c}" for c in MODEL_INPUTS], trees=trees, sample=sample,
        contamination=contamination, seed=seed, keep=SCORED_COLUMNS, materialize=False)
    discard(sensors.sparkSession, path)
    return scored


def fit_anomaly_model(sensors: DataFrame, start: str, end: str, path: str, trees: int = FOREST_TREES,
                      contamination: float = FOREST_CONTAMINATION, seed: int = FOREST_SEED,
                      sample: int = FOREST_SAMPLE) -> int:
    """Fits the anomaly report's forest on a range of reports and stores it as the next
    version of the model table at ``path``; returns the version."""
    inputs = features.model_inputs(features.sensor_zscores(sensors, start, end)).select("id", *MODEL_INPUTS)
    model = forest_model.fit_forest(inputs, "id", MODEL_INPUTS, trees, sample, contamination, seed, trained_on=f"{start} to {end}")
    return forest_model.save_forest(sensors.sparkSession, model, path)


def stored_model_scores(sensors: DataFrame, start: str, end: str, path: str, version: int | None = None) -> DataFrame:
    """``anomaly_scores`` of a range of reports by a stored forest: one pass, nothing is fitted."""
    model = forest_model.load_forest(sensors.sparkSession, path, version)
    return forest_model.score_with(features.model_inputs(features.sensor_zscores(sensors, start, end)), model, SCORED_COLUMNS)


def sensor_anomaly_detection(sensors: DataFrame, start: str, end: str, output_path: str | None = None,
                             z_threshold: float = rules.Z_THRESHOLD, model_path: str | None = None,
                             **forest_args) -> DataFrame:
    """Hybrid detection: |z| flags over 7-report windows plus the isolation forest,
    with a global flag, reason text and chart category per report.

    The forest is fitted on the same reports, as in the source, or with ``model_path``
    read from the latest version stored there."""
    if model_path:
        scored = stored_model_scores(sensors, start, end, model_path)
    else:
        scored = anomaly_scores(sensors, start, end, **forest_args)
    flagged = rules.zscore_flags(scored, z_threshold).withColumn(
        "is_ml_anomaly", (F.col("ml_anomaly_pred") == -1).cast("int"))
    out = rules.explain_anomalies(flagged).select(*ANOMALY_COLUMNS)
    if output_path:
        export(out, output_path, order=["report_date", "sensor_id"])
    return out


def anomaly_total(anomalies: DataFrame) -> DataFrame:
    """Number of reports flagged by either strategy."""
    return anomalies.agg(F.coalesce(F.sum("is_anomaly_global"), F.lit(0)).cast("bigint")
                         .alias("global_anomalies"))


def generate_fleet_health_report(sensors: DataFrame, start: str, end: str,
                                 output_folder: str | None = None) -> dict:
    """Daily and monthly sensor availability; returns the overall mean."""
    # one row a day; the monthly and the overall figures read these
    daily = _kept_until_exit(kpis.sensor_availability_daily(sensors, start, end), "availability-daily")
    monthly = kpis.sensor_availability_monthly(daily)
    if output_folder:
        export(daily, f"{output_folder}/report_sensor_availability_daily", order=["report_date"])
        export(monthly, f"{output_folder}/report_sensor_availability_monthly", order=["month_year"])
    overall = kpis.sensor_availability_overall(daily).first()[0]
    log.info("overall sensor availability: %.2f%%", overall * 100)
    return {"daily": daily, "monthly": monthly, "overall_availability": overall}


def generate_device_health_report(devices: DataFrame, start: str, end: str,
                                  output_folder: str | None = None) -> dict:
    """Fleet status per day and hub connectivity; returns the worst hub-day."""
    status = kpis.fleet_status(devices, start, end)
    connectivity = kpis.device_connectivity(devices, start, end)
    if output_folder:
        export(status, f"{output_folder}/fleet_status", order=["report_date"])
        export(connectivity, f"{output_folder}/report_device_connectivity",
               order=[F.col("connectivity_efficiency_pct").asc_nulls_last(), "report_date", "device_id"])
    worst = kpis.worst_device(connectivity).first()
    if worst:
        log.info("worst hub-day: device %s on %s, uptime %s", worst["worst_device_id"],
                 worst["report_date"], worst["worst_device_efficiency"])
    return {"fleet_status": status, "connectivity": connectivity,
            "worst_device_id": worst["worst_device_id"] if worst else None,
            "worst_device_efficiency": worst["worst_device_efficiency"] if worst else 0}


@dataclass
class MechanicalPaths:
    sensor_issues: str = "output/sensor_anomalies"
    device_issues: str = "output/hub_anomalies"
    sensor_variables: str = "output/sensor_variables"
    sensor_statistics: str = "output/sensor_statistics"
    device_statistics: str = "output/device_statistics"


def generate_mechanical_failure_report(sensors: DataFrame, devices: DataFrame, start: str, end: str,
                                       paths: MechanicalPaths | None = None,
                                       thresholds: rules.IssueThresholds = rules.DEFAULT) -> dict:
    """Sensor and hub issue classification with risk scores; five outputs.

    With ``paths``, the sensor reports of the range are stored once, in the columns that the
    outputs read, and so is the classified hub join: all five outputs, the windows and the
    active sensors of the hub side come from these two frames. (The day origin is the minimum of
    one column of the whole sensor table.) Returned are the outputs, which read the frames."""
    daily = features.sensor_daily(sensors, start, end, features.day_origin(sensors))
    if paths:
        daily = _kept_until_exit(daily, "mechanical-sensors")
    sensor = rules.classify_sensor_issues(
        features.trend_features(rolling(daily, features.trend_spec(thresholds.slope_window_days))), thresholds)
    active = (daily.filter(F.col("transmitting_dur") > 0).groupBy("vehicle_id", "report_date")
              .agg(F.count_distinct("sensor_id").alias("active_sensors")))
    device = rules.classify_device_issues(features.device_features(devices, sensors, start, end, active), thresholds)
    if paths:
        device = _kept_until_exit(device, "mechanical-hubs")
    outputs = {
        "sensor_issues": sensor.select("id", "report_date", "vehicle_id", "sensor_id", "wheel_position",
                                       "wheel_id", "issue_category", "risk_score"),
        "device_issues": device.select("id", "report_date", "vehicle_id", "device_id", "issue_category",
                                       "risk_score"),
        "sensor_variables": daily.select("id", "report_date", "temperature_avg", "cold_pressure_avg", "hot_pressure_avg"),
        "sensor_statistics": daily.select("id", "report_date", "transmitting_dur"),
        "device_statistics": device.select("id", "report_date", "transmitting_dur", "not_transmitting_dur",
                                           "connectivity_efficiency", "active_sensors"),
    }
    if paths:
        for name, df in outputs.items():
            key = "sensor_id" if name.startswith("sensor") else "vehicle_id"
            order = [key, "report_date"] if "issues" in name else None
            export_counted(df, getattr(paths, name), order=order)       # logs the rows written
    return outputs


def _kept_until_exit(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored in the shared folder until the driver ends."""
    kept, path = stored(df, name)
    discard_at_exit(df.sparkSession, path)
    return kept


def exploration_exports(sensors: DataFrame, devices: DataFrame, vehicle_id: int | None,
                        output_folder: str | None = None) -> dict:
    """Per-metric level excursions and silent hubs, as the exploration exports them."""
    outs = {f"{m}_anomalies": explore.level_excursions(sensors, m, vehicle_id)
            for m in ("temperature", "cold_pressure", "hot_pressure")}
    outs["not_transmitting_devices"] = explore.silent_devices(devices)
    if output_folder:
        for name, df in outs.items():
            order = explore.silent_order() if name.startswith("not_") else explore.excursion_order()
            export(df, f"{output_folder}/{name}", order=order)
    return outs
