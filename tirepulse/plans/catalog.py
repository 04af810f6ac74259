"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query reads the driver tables under ``sf_dir`` (the report views are a
Spark aggregation of ``events``) and returns a lazy DataFrame. For the
cross-engine value comparison every DOUBLE output is rounded to 6 decimals
and ``-0.0`` is folded to ``0.0`` on both sides (``present`` here,
``_wrap`` in the oracle); library functions themselves return full precision.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tirepulse.operators import calendar, explore, forest, kpis, presence, rules, window_state
from tirepulse.operators import features as feat
from tirepulse.plans import reports
from tirepulse.session import discard, discard_at_exit, shared_folder, stored
from tirepulse.sources import ingest, layout, upsert
from tirepulse.sources.fixtures import REPORT_END, REPORT_START, load_reports
from tirepulse.sources.schema import METRICS, SENSOR_SCHEMA

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

S, E = REPORT_START, REPORT_END


def present(df: DataFrame) -> DataFrame:
    """Round DOUBLE columns for export/comparison (6 decimals, no -0.0)."""
    if not any(isinstance(f.dataType, T.DoubleType) for f in df.schema.fields):
        return df
    return df.selectExpr(*[f"ROUND(`{f.name}`, 6) + 0.0 AS `{f.name}`" if isinstance(f.dataType, T.DoubleType)
                           else f"`{f.name}`" for f in df.schema.fields])


def register(name: str):
    def deco(fn: Callable[[DataFrame, DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sensors, devices = load_reports(spark, sf_dir)
            return present(fn(sensors, devices))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


# ----------------------------- availability / fleet -----------------------------

@register("fleet_sensor_total")
def _q_fleet_sensor_total(sensors, devices):
    return kpis.fleet_sensor_total(sensors)


@register("sensor_availability_daily")
def _q_avail_daily(sensors, devices):
    return kpis.sensor_availability_daily(sensors, S, E)


@register("sensor_availability_monthly")
def _q_avail_monthly(sensors, devices):
    return kpis.sensor_availability_monthly(kpis.sensor_availability_daily(sensors, S, E))


@register("sensor_availability_overall")
def _q_avail_overall(sensors, devices):
    return kpis.sensor_availability_overall(kpis.sensor_availability_daily(sensors, S, E))


@register("fleet_status")
def _q_fleet_status(sensors, devices):
    return kpis.fleet_status(devices, S, E)


@register("fleet_capacity_pct")
def _q_fleet_capacity(sensors, devices):
    return kpis.fleet_capacity_pct(devices, S, E)


@register("device_connectivity")
def _q_connectivity(sensors, devices):
    return kpis.device_connectivity(devices, S, E)


@register("worst_device")
def _q_worst(sensors, devices):
    return kpis.worst_device(kpis.device_connectivity(devices, S, E))


@register("active_sensors_per_vehicle")
def _q_active_per_vehicle(sensors, devices):
    return kpis.active_sensors_per_vehicle(sensors, S, E)


@register("extreme_level_sensors")
def _q_extreme(sensors, devices):
    return kpis.extreme_level_sensors(sensors, S, E)


@register("level_distribution")
def _q_level_dist(sensors, devices):
    return kpis.level_distribution(sensors, S, E)


@register("communication_pct_daily")
def _q_comm_daily(sensors, devices):
    return kpis.communication_pct(devices, S, E, "day")


@register("communication_pct_monthly")
def _q_comm_monthly(sensors, devices):
    return kpis.communication_pct(devices, S, E, "month")


@register("vehicle_active_sensor_pct_daily")
def _q_vas_daily(sensors, devices):
    return kpis.vehicle_active_sensor_pct(sensors, S, E, "day")


@register("vehicle_active_sensor_pct_monthly")
def _q_vas_monthly(sensors, devices):
    return kpis.vehicle_active_sensor_pct(sensors, S, E, "month")


# ----------------------------- calendar and bitmaps -----------------------------

@register("communication_calendar_daily")
def _q_comm_calendar(sensors, devices):
    return calendar.communication_calendar(devices, S, E, "day")


@register("communication_calendar_monthly")
def _q_comm_calendar_monthly(sensors, devices):
    return calendar.communication_calendar(devices, S, E, "month")


@register("active_sensor_calendar")
def _q_active_calendar(sensors, devices):
    return calendar.active_sensor_calendar(sensors, S, E)


@register("sensor_coverage")
def _q_coverage(sensors, devices):
    return calendar.sensor_coverage(sensors, S, E)


def _presence(sensors, name):
    """The bitmap table of two deliveries, of which the second has rows of days that the first has too."""
    first = F.col("id") % 3 > 0
    table, path = stored(presence.merged(presence.presence(sensors.filter(first)), presence.presence(sensors.filter(~first))), name)
    discard_at_exit(sensors.sparkSession, path)
    return table


@register("bitmap_availability_daily")
def _q_bitmap_daily(sensors, devices):
    """Daily availability from the bitmaps alone."""
    return presence.availability_daily(_presence(sensors, "presence-daily"), S, E)


@register("bitmap_sensors_monthly")
def _q_bitmap_monthly(sensors, devices):
    """Distinct sensors of each month, rolled up from the bitmaps of its days."""
    return presence.sensors_monthly(_presence(sensors, "presence-monthly"), S, E)


# ----------------------------- report tables -----------------------------

@register("sensor_reports")
def _q_sensor_reports(sensors, devices):
    """The typed sensor report table (66 columns)."""
    return sensors


@register("device_reports")
def _q_device_reports(sensors, devices):
    """The typed hub report table (10 columns)."""
    return devices


# ----------------------------- mechanical failure report -----------------------------


# Output columns of the reports, by query.
KEYS = ["id", "sensor_id", "report_date"]
FEATURE_VIEWS = {
    "rolling_regression_sums": ["sum_y_cold", "sum_y_temp", "sum_x", "sum_xy_cold", "sum_xy_temp",
                                "sum_xx", "n"],
    "rolling_variation": ["std_temp", "std_cold"],
    "day_over_day": ["prev_cold", "prev_temp", "prev_hot", "prev_date", "delta_cold", "delta_temp",
                     "delta_hot"],
    "pressure_temperature_slopes": ["cold_pressure_slope", "temperature_slope"],
    "thermal_pressure_ratio": ["thermal_pressure_ratio"],
}


def _features(sensors):
    return feat.sensor_features(sensors, S, E)


@register("sensor_features")
def _q_sensor_features(sensors, devices):
    return _features(sensors)


for _name, _cols in FEATURE_VIEWS.items():
    register(_name)((lambda cols: lambda sensors, devices: _features(sensors).select(*KEYS, *cols))(_cols))


@register("duration_indices")
def _q_duration_indices(sensors, devices):
    return feat.duration_indices(sensors, S, E)


SENSOR_FLAGS = ["is_slow_leak", "is_puncture", "is_over_inflation", "is_thermal_stress",
                "is_sensor_malfunction"]


@register("sensor_issue_flags")
def _q_sensor_flags(sensors, devices):
    return rules.sensor_issue_flags(_features(sensors)).select(*KEYS, *SENSOR_FLAGS)


def _sensor_issues(sensors):
    return rules.classify_sensor_issues(_features(sensors))


@register("sensor_issues")
def _q_sensor_issues(sensors, devices):
    """Flagship: one row per sensor report with issue category and risk score."""
    return _sensor_issues(sensors).select("id", "report_date", "vehicle_id", "sensor_id", "wheel_position",
                                          "wheel_id", "issue_category", "risk_score")


@register("sensor_variables")
def _q_sensor_variables(sensors, devices):
    return feat.sensor_variables(sensors, S, E)


@register("sensor_statistics")
def _q_sensor_statistics(sensors, devices):
    return feat.sensor_statistics(sensors, S, E)


def _device_features(sensors, devices):
    return feat.device_features(devices, sensors, S, E)


@register("device_features")
def _q_device_features(sensors, devices):
    return _device_features(sensors, devices)


@register("device_issues")
def _q_device_issues(sensors, devices):
    return rules.classify_device_issues(_device_features(sensors, devices)).select(
        "id", "report_date", "vehicle_id", "device_id", "issue_category", "risk_score")


@register("device_statistics")
def _q_device_statistics(sensors, devices):
    return _device_features(sensors, devices).select(
        "id", "report_date", "transmitting_dur", "not_transmitting_dur", "connectivity_efficiency",
        "active_sensors")


# ----------------------------- anomaly report (statistical part) -----------------------------

ZKEYS = ["id", "report_date", "sensor_id"]

# Deterministic stand-in for the model's verdict, used only by the
# ``anomaly_reasons*`` queries so the text rules can be checked in SQL: a report
# counts as "model-flagged" when its level-3 cold-pressure time exceeds 16,500 s.
STAND_IN_COLUMN = "crit_cold_dur"
STAND_IN_LIMIT = 16_500
LOW_Z_THRESHOLD = 1.8


@register("critical_durations")
def _q_critical(sensors, devices):
    return feat.critical_durations(sensors, S, E)


@register("rolling_stats")
def _q_rolling_stats(sensors, devices):
    r = feat.rolling_stats(sensors, S, E)
    return r.select(*ZKEYS, *[c for c in r.columns if c[:3] in ("ma_", "sd_")])


@register("sensor_zscores")
def _q_zscores(sensors, devices):
    return feat.sensor_zscores(sensors, S, E).select(*ZKEYS, "z_temp", "z_cold", "z_hot", "z_dur_temp")


@register("zscore_flags")
def _q_zflags(sensors, devices):
    return rules.zscore_flags(feat.sensor_zscores(sensors, S, E)).select(
        *ZKEYS, "is_temp_anomaly", "is_cold_press_anomaly", "is_hot_press_anomaly")


def _reasons(sensors, z_threshold):
    z = rules.zscore_flags(feat.sensor_zscores(sensors, S, E), z_threshold)
    z = z.withColumn("is_ml_anomaly", (F.col(STAND_IN_COLUMN) > STAND_IN_LIMIT).cast("int"))
    return rules.explain_anomalies(z).select(
        *ZKEYS, "is_anomaly_global", "anomaly_category", "anomaly_detail_text")


@register("anomaly_reasons")
def _q_reasons(sensors, devices):
    return _reasons(sensors, rules.Z_THRESHOLD)


@register("anomaly_reasons_low_threshold")
def _q_reasons_low(sensors, devices):
    return _reasons(sensors, LOW_Z_THRESHOLD)


@register("feature_matrix")
def _q_feature_matrix(sensors, devices):
    return feat.feature_matrix(feat.sensor_zscores(sensors, S, E))


@register("scaled_features")
def _q_scaled(sensors, devices):
    return feat.scaled_features(feat.feature_matrix(feat.sensor_zscores(sensors, S, E)))


# ----------------------------- windows in runs -----------------------------

# The reports arrive in three runs; of the first run's reports, those whose id is
# divisible by 17 come a run late.
RUN_ENDS = ["2024-01-10", "2024-01-20", E]
LATE_EVERY = 17


def _in_runs(daily, spec, name):
    """Windows of ``daily`` computed run by run with the state of the runs before."""
    spark = daily.sparkSession
    folder = shared_folder(spark, name)
    discard_at_exit(spark, folder)
    first, second = (F.col("report_date") <= F.lit(d).cast("date") for d in RUN_ENDS[:2])
    late = F.col("id") % LATE_EVERY == 0
    run = F.when(first & ~late, 1).when(second, 2).otherwise(3)
    for k in range(1, len(RUN_ENDS) + 1):
        window_state.run_windows(daily.filter(run == k), daily.filter(run < k), folder, spec)
    return window_state.latest_results(spark, folder)


@register("incremental_rolling_stats")
def _q_incremental_stats(sensors, devices):
    """The moving means and deviations, computed in three runs, the second with late reports."""
    r = _in_runs(feat.critical_durations(sensors, S, E), feat.stats_spec(), "incremental-stats")
    return r.select(*ZKEYS, *[c for c in r.columns if c[:3] in ("ma_", "sd_")])


@register("incremental_sensor_features")
def _q_incremental_features(sensors, devices):
    """All trend features, computed in three runs, the second with late reports."""
    daily = feat.sensor_daily(sensors, S, E, feat.day_origin(sensors))
    return feat.trend_features(_in_runs(daily, feat.trend_spec(), "incremental-features"))


# ----------------------------- exploration -----------------------------


# Parameters of the single-vehicle transmission comparison (the source compares
# one vehicle's hub and sensor reports over one month).
COMPARE_VEHICLE = 1
MONTH_START, MONTH_END = "2024-01-01", "2024-02-01"


@register("device_sensor_join_counts")
def _q_join_counts(sensors, devices):
    return explore.device_sensor_join_counts(devices, sensors)


@register("transmission_comparison")
def _q_transmission(sensors, devices):
    return explore.transmission_comparison(devices, sensors, COMPARE_VEHICLE, MONTH_START, MONTH_END)


for _m in METRICS:
    register(f"level_profile_{_m}")(
        (lambda m: lambda sensors, devices: explore.level_profile(sensors, m, None, MONTH_START, MONTH_END))(_m))
    register(f"level_excursions_{_m}")(
        (lambda m: lambda sensors, devices: explore.level_excursions(sensors, m, None))(_m))


@register("silent_devices")
def _q_silent(sensors, devices):
    return explore.silent_devices(devices)


@register("data_quality")
def _q_quality(sensors, devices):
    return explore.data_quality(sensors, devices)


# ----------------------------- anomaly report (model part) -----------------------------

# A small literal forest: (tree, node, feature, threshold, left, right, size, depth).
FIXED_FEATURES = ["temperature_avg", "cold_pressure_avg", "crit_cold_dur"]
FIXED_NODES = [
    (0, 0, 0, 30.0, 1, 2, 256, 0), (0, 1, -1, 0.0, -1, -1, 200, 1), (0, 2, 1, 110.0, 3, 4, 56, 1),
    (0, 3, -1, 0.0, -1, -1, 50, 2), (0, 4, -1, 0.0, -1, -1, 6, 2),
    (1, 0, 2, 10_000.0, 1, 2, 256, 0), (1, 1, -1, 0.0, -1, -1, 250, 1), (1, 2, -1, 0.0, -1, -1, 6, 1),
]


@register("forest_fixed_model")
def _q_fixed_model(sensors, devices):
    """Scores, threshold and verdict of a fixed node table, through the forest's own code."""
    z = feat.sensor_zscores(sensors, S, E).select("id", *FIXED_FEATURES)
    nodes = pd.DataFrame(FIXED_NODES, columns=["t", "node", "feature", "threshold", "left", "right", "size", "depth"])
    scored, path = stored(forest.score_frame(z, FIXED_FEATURES, nodes, 256, 2).select("id", "ml_raw_score"), "fixed-model")
    discard_at_exit(z.sparkSession, path)
    offset = forest.quantile_exact(scored, "ml_raw_score", reports.FOREST_CONTAMINATION, scored.count(),
                                   bounds=forest.SCORE_BOUNDS)
    return forest.verdicts(scored, offset, ["id"])


@register("forest_sample")
def _q_forest_sample(sensors, devices):
    """The rows that the report's 100 trees of 256 rows are grown from."""
    rows = feat.critical_durations(sensors, S, E).select("id")
    return forest.draw_samples(rows, "id", forest.require_unique(rows, "id"), reports.FOREST_TREES,
                               reports.FOREST_SAMPLE, reports.FOREST_SEED).select("t", "id")


# Reports up to this day train the stored forest, later ones are scored with it.
TRAINED_UNTIL, SCORED_FROM = "2024-01-15", "2024-01-16"


@register("stored_model_scores")
def _q_stored_model(sensors, devices):
    """A forest fitted on the first half of the range, stored, read again and applied to the second half."""
    spark = sensors.sparkSession
    path = shared_folder(spark, "anomaly-model")
    reports.fit_anomaly_model(sensors, S, TRAINED_UNTIL, path)
    scores = reports.stored_model_scores(sensors, SCORED_FROM, E, path)
    discard(spark, path)
    return scores.select("id", "ml_anomaly_score", "ml_anomaly_pred")


# Values of the raw file by id: missing-value tokens, "1.0" for an integer, spaces, and text that doesn't fit.
NO_SENSOR, NO_DURATION, NO_READING, BAD_WHEEL, BAD_DAY = 5, 7, 3, 13, 29


@register("ingest_typed")
def _q_ingest_typed(sensors, devices):
    """All report columns written as a raw CSV file with a description, and loaded again, with each row's malformed columns."""
    spark = sensors.sparkSession
    folder = shared_folder(spark, "raw-reports")
    discard_at_exit(spark, folder)
    every = lambda n: F.col("id") % n == 0
    text = {c: F.col(c).cast("string") for c in sensors.columns}
    text["sensor_id"] = F.when(every(NO_SENSOR), "None").otherwise(F.concat(text["sensor_id"], F.lit(".0")))
    text["transmitting_dur"] = F.when(every(NO_DURATION), "N/A").otherwise(F.concat(F.lit(" "), text["transmitting_dur"]))
    text["temperature_avg"] = F.when(every(NO_READING), "NaN").otherwise(text["temperature_avg"])
    text["wheel_id"] = F.when(every(BAD_WHEEL), F.lit('left, "rear"')).otherwise(text["wheel_id"])
    text["updated_at"] = F.when(every(BAD_DAY), F.lit("yesterday")).otherwise(text["updated_at"])
    names = spark.createDataFrame([(c,) for c in sensors.columns], "column_name string")
    names.coalesce(1).write.option("sep", "|").option("header", True).csv(f"{folder}/desc")
    # the file's own header is ignored
    raw = sensors.select(*[c.alias(f"c{k}") for k, c in enumerate(text.values())])
    raw.write.option("header", True).option("escape", '"').csv(f"{folder}/data")
    loaded = ingest.raw_reports(spark, f"{folder}/desc", f"{folder}/data")
    return (loaded.withColumn("bad_columns", F.array_join(ingest.malformed(loaded, SENSOR_SCHEMA), ","))
            .select(*ingest.typed(loaded, SENSOR_SCHEMA).columns, "bad_columns")
            .transform(lambda df: ingest.typed(df, SENSOR_SCHEMA)))


# Deliveries after the first one, by id: corrections (a later update), stale versions
# (an earlier one), reports moved to the next month, and reports sent again as they were.
CORRECTED, STALE, MOVED, AGAIN = (10, 3), (10, 4), (50, 7), (10, 6)


@register("upserted_reports")
def _q_upserted(sensors, devices):
    """The stored report table after a delivery, a delivery of corrections, and that one once more."""
    spark = sensors.sparkSession
    path = shared_folder(spark, "upserted-reports")
    discard_at_exit(spark, path)
    of = lambda rule: F.col("id") % rule[0] == rule[1]
    later, earlier = F.expr("updated_at + INTERVAL 1 DAY"), F.expr("updated_at - INTERVAL 1 DAY")
    second = sensors.filter(of(CORRECTED) | of(STALE) | of(MOVED) | of(AGAIN)).withColumns({
        "temperature_avg": F.when(of(CORRECTED) | of(STALE), F.col("temperature_avg") + F.lit(5.0).cast("float")).otherwise(F.col("temperature_avg")),
        "report_start_at": F.when(of(MOVED), F.expr("report_start_at + INTERVAL 31 DAYS")).otherwise(F.col("report_start_at")),
        "updated_at": F.when(of(STALE), earlier).when(of(CORRECTED) | of(MOVED), later).otherwise(F.col("updated_at"))})
    upsert.merge_reports(spark, sensors, path)
    upsert.merge_reports(spark, second, path)
    again = upsert.merge_reports(spark, second, path)
    if again.changed:
        raise RuntimeError("a delivery that was merged before has changed the table")
    return spark.read.parquet(path).select("id", "sensor_id", "vehicle_id", "temperature_avg", "report_start_at", "updated_at", "report_month")


BUCKETS = 8


def _bucketed(df, name, key):
    """The reports as a bucketed table below the shared folder, under a name of its own."""
    path = shared_folder(df.sparkSession, name)
    discard_at_exit(df.sparkSession, path)
    return layout.write_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, key, BUCKETS)


@register("bucketed_rolling_stats")
def _q_bucketed_stats(sensors, devices):
    """The moving means and deviations over a table bucketed by sensor: no shuffle below the windows."""
    r = feat.rolling_stats(_bucketed(sensors, "wheels-by-sensor", "sensor_id"), S, E)
    return r.select(*ZKEYS, *[c for c in r.columns if c[:3] in ("ma_", "sd_")])


@register("bucketed_device_features")
def _q_bucketed_hubs(sensors, devices):
    """The hub join over tables bucketed by vehicle: the grouped counts need no shuffle."""
    return feat.device_features(_bucketed(devices, "hubs-by-vehicle", "vehicle_id"), _bucketed(sensors, "wheels-by-vehicle", "vehicle_id"), S, E)


@register("isolation_scores")
def _q_isolation(sensors, devices):
    """Isolation-forest score and -1/1 verdict per report."""
    return reports.anomaly_scores(sensors, S, E).select("id", "ml_anomaly_score", "ml_anomaly_pred")


@register("sensor_anomalies")
def _q_sensor_anomalies(sensors, devices):
    """The full anomaly report (z-score flags + forest + reasons)."""
    return reports.sensor_anomaly_detection(sensors, S, E)


@register("anomaly_total")
def _q_anomaly_total(sensors, devices):
    return reports.anomaly_total(reports.sensor_anomaly_detection(sensors, S, E))
