"""Feature extraction: sensor trend features, hub features, anomaly features.

Order of operations follows the source reports: deltas and the
thermal/pressure ratio are computed on unfilled values, then NULLs introduced
by lags, divisions and one-row stddevs are replaced by 0; rules run after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.functions.expr import fill0, not_nan, ratio
from tirepulse.operators.common import TS, report_date, report_window
from tirepulse.operators.kpis import active_sensors_per_vehicle
from tirepulse.operators.windows import (
    DEFAULT_BLOCK_ROWS, DEFAULT_HOT_KEY_ROWS, RollingSpec, rolling,
)


def _float0() -> Column:
    return F.lit(0.0).cast("float")


def _readings() -> list[Column]:
    """The three mean readings; NaN counts as missing, whatever the source of the rows."""
    return [not_nan(c).alias(c) for c in ("temperature_avg", "cold_pressure_avg", "hot_pressure_avg")]


def _slope(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column) -> Column:
    """Least-squares slope from window sums; 0 when all x are equal.

    ``n`` counts every row while the y sums skip NULL readings, exactly as the
    source does (so missing readings bias the slope; ``regr_slope`` differs).
    """
    denom = n * sxx - sx * sx
    return F.when(denom == 0, F.lit(0.0)).otherwise((n * sxy - sx * sy) / denom)


def day_origin(sensors: DataFrame) -> Column:
    """The earliest report date of the whole table (not the filtered range), as a scalar subquery."""
    return sensors.agg(F.to_date(F.min(TS))).scalar()


def sensor_daily(sensors: DataFrame, start: str, end: str, origin: Column) -> DataFrame:
    """The reports of a range in the columns that the trend windows and rules read."""
    daily = report_window(sensors, start, end).select(
        "id", "wheel_position", "wheel_id", "sensor_id", "vehicle_id",
        report_date().alias("report_date"),
        *_readings(), "transmitting_dur",
        "level_1_high_cold_pressure_dur", "level_2_high_hot_pressure_dur",
        "level_2_high_temperature_dur", "level_3_high_temperature_dur",
        "level_3_low_cold_pressure_dur", "level_3_low_cold_pressure_cnt",
        F.datediff(report_date(), origin).cast("bigint").alias("day_num"))
    x = F.col("day_num")
    return daily.withColumns({
        # float x float stays float, as in the source engine (bigint x float = float)
        "_xy_cold": x.cast("float") * F.col("cold_pressure_avg"),
        "_xy_temp": x.cast("float") * F.col("temperature_avg"),
        "_xx": x * x,
    })


def trend_spec(rows: int = 7) -> RollingSpec:
    """Frames and lags of the trend features. The names are columns of the report's output."""
    return RollingSpec(
        aggs={
            "sum_y_cold": ("sum", "cold_pressure_avg"),
            "sum_y_temp": ("sum", "temperature_avg"),
            "sum_x": ("sum", "day_num"),
            "sum_xy_cold": ("sum", "_xy_cold"),
            "sum_xy_temp": ("sum", "_xy_temp"),
            "sum_xx": ("sum", "_xx"),
            "n": ("count", None),
            "std_temp": ("stddev", "temperature_avg"),
            "std_cold": ("stddev", "cold_pressure_avg"),
        },
        lags={"prev_cold": "cold_pressure_avg", "prev_temp": "temperature_avg",
              "prev_hot": "hot_pressure_avg", "prev_date": "report_date"},
        rows=rows)


def sensor_features(sensors: DataFrame, start: str, end: str, rows: int = 7,
                    block_rows: int = DEFAULT_BLOCK_ROWS,
                    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS) -> DataFrame:
    """Per sensor report: 7-report slopes, variation, day-over-day deltas, duration indices.

    ``day_num`` counts days from the earliest report date of the whole table
    (not the filtered range); it is a scalar subquery.
    """
    daily = sensor_daily(sensors, start, end, day_origin(sensors))
    return trend_features(rolling(daily, trend_spec(rows), hot_key_rows=hot_key_rows, block_rows=block_rows))


def trend_features(r: DataFrame) -> DataFrame:
    """Slopes, deltas and ratios from the windows of ``trend_spec``."""
    # One projection for everything derived from the window (fewer plan nodes
    # to analyse; Catalyst collapses and deduplicates the expressions anyway).
    c = F.col
    n, sx, sxx = c("n"), c("sum_x"), c("sum_xx")
    consecutive = c("prev_date") == F.date_sub(c("report_date"), 1)
    d_cold = F.when(consecutive, c("cold_pressure_avg") - c("prev_cold"))
    d_temp = F.when(consecutive, c("temperature_avg") - c("prev_temp"))
    d_hot = F.when(consecutive, c("hot_pressure_avg") - c("prev_hot"))
    # ratio on the unfilled deltas (float / float = float in the source engine)
    thermal = F.when(d_hot != 0, (d_temp / d_hot).cast("float"))
    fills = {"std_temp": F.coalesce(c("std_temp"), F.lit(0.0)),
             "std_cold": F.coalesce(c("std_cold"), F.lit(0.0))}
    kept = [fills.get(name, c(name)).alias(name) for name in r.columns
            if name not in ("_xy_cold", "_xy_temp", "_xx")]
    return r.select(
        *kept,
        _slope(n, sx, c("sum_y_cold"), c("sum_xy_cold"), sxx).alias("cold_pressure_slope"),
        _slope(n, sx, c("sum_y_temp"), c("sum_xy_temp"), sxx).alias("temperature_slope"),
        F.coalesce(d_cold, _float0()).alias("delta_cold"),
        F.coalesce(d_temp, _float0()).alias("delta_temp"),
        F.coalesce(d_hot, _float0()).alias("delta_hot"),
        *_duration_ratios(),
        F.coalesce(thermal, _float0()).alias("thermal_pressure_ratio"))


def _duration_ratios() -> list[Column]:
    c = F.col
    return [F.coalesce(ratio(c("level_1_high_cold_pressure_dur") + c("level_2_high_hot_pressure_dur"),
                             "transmitting_dur"), F.lit(0.0)).alias("over_inflation_index"),
            F.coalesce(ratio(c("level_2_high_temperature_dur") + c("level_3_high_temperature_dur"),
                             "transmitting_dur"), F.lit(0.0)).alias("high_temp_dur_ratio")]


def duration_indices(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """The two duration indices of each report; a plain projection, no window."""
    return report_window(sensors, start, end).select(
        "id", "sensor_id", report_date().alias("report_date"), *_duration_ratios())


def sensor_variables(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """The three mean readings of each report; a plain projection, no window."""
    return report_window(sensors, start, end).select("id", report_date().alias("report_date"), *_readings())


def sensor_statistics(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Transmitting seconds of each report; a plain projection, no window."""
    return report_window(sensors, start, end).select("id", report_date().alias("report_date"), "transmitting_dur")


def device_features(devices: DataFrame, sensors: DataFrame, start: str, end: str,
                    counts: DataFrame | None = None) -> DataFrame:
    """Per hub report: uptime fraction and the vehicle's active sensors that day
    (``counts``: these per vehicle and day, if they are known already).

    Sensors are pre-aggregated to one row per (vehicle, day) before the left
    join, so the join never multiplies hub rows and both sides shuffle on the
    same (vehicle_id, report_date) key. NULL keys stay unmatched (0 sensors).
    """
    t, s = F.col("transmitting_dur"), F.col("not_transmitting_dur")
    d = report_window(devices, start, end).select(
        "id", "vehicle_id", "device_id", report_date().alias("report_date"),
        "transmitting_dur", "not_transmitting_dur",
        ratio(t, t + s).alias("connectivity_efficiency"),
        "vehicle_maintenance", "vehicle_out_of_service")
    if counts is None:
        counts = active_sensors_per_vehicle(sensors, start, end)
    dd, cc = d.alias("d"), counts.alias("s")
    joined = dd.join(cc, (F.col("d.vehicle_id") == F.col("s.vehicle_id"))
                     & (F.col("d.report_date") == F.col("s.report_date")), "left")
    return joined.select(
        *[F.col(f"d.{c}") for c in d.columns if c != "connectivity_efficiency"],
        F.coalesce(F.col("d.connectivity_efficiency"), F.lit(0.0)).alias("connectivity_efficiency"),
        F.coalesce(F.col("s.active_sensors"), F.lit(0).cast("bigint")).alias("active_sensors"))


# --------------------------------------------------------------------------
# Anomaly-detection features (statistical step of the anomaly report)
# --------------------------------------------------------------------------

CRITICAL = {"crit_temp_dur": "temperature", "crit_cold_dur": "cold_pressure", "crit_hot_dur": "hot_pressure"}
READINGS = {"temp": "temperature_avg", "cold": "cold_pressure_avg", "hot": "hot_pressure_avg",
            "dur_temp": "crit_temp_dur"}


def critical_durations(sensors: DataFrame, start: str, end: str) -> DataFrame:
    """Per report: readings plus level-3 (high + low) seconds per metric, NULL as 0."""
    return report_window(sensors, start, end).select(
        "id", report_date().alias("report_date"), "sensor_id", "vehicle_id", "wheel_position",
        *_readings(),
        *[(fill0(f"level_3_high_{m}_dur") + fill0(f"level_3_low_{m}_dur")).alias(name)
          for name, m in CRITICAL.items()])


def stats_spec(rows: int = 7) -> RollingSpec:
    """Moving mean and sample stddev of the three readings and the critical temperature time."""
    aggs = {}
    for short, c in READINGS.items():
        aggs[f"ma_{short}"] = ("avg", c)
        aggs[f"sd_{short}"] = ("stddev", c)
    return RollingSpec(aggs=aggs, rows=rows)


def rolling_stats(sensors: DataFrame, start: str, end: str, rows: int = 7,
                  block_rows: int = DEFAULT_BLOCK_ROWS,
                  hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS) -> DataFrame:
    """Moving mean and sample stddev over the last ``rows`` reports of each sensor."""
    return rolling(critical_durations(sensors, start, end), stats_spec(rows),
                   hot_key_rows=hot_key_rows, block_rows=block_rows)


def sensor_zscores(sensors: DataFrame, start: str, end: str, rows: int = 7,
                   block_rows: int = DEFAULT_BLOCK_ROWS,
                   hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS) -> DataFrame:
    """Rolling stats plus z-scores (0 when the stddev is 0 or NULL).

    Every NULL in the numeric columns is then replaced by 0, as the source
    fills its whole frame before the model step (this also zeroes missing
    readings and identifiers).
    """
    r = rolling_stats(sensors, start, end, rows, block_rows, hot_key_rows)
    zs = {}
    for short, c in READINGS.items():
        sd = F.col(f"sd_{short}")
        zs[f"z_{short}"] = F.when((sd == 0) | sd.isNull(), F.lit(0.0)) \
                            .otherwise((F.col(c) - F.col(f"ma_{short}")) / sd)
    r = r.withColumns(zs)
    return fill_numeric(r)


def fill_numeric(df: DataFrame) -> DataFrame:
    """``fillna(0)`` over every numeric column, keeping each column's type."""
    numeric = ("int", "bigint", "smallint", "tinyint", "float", "double")
    return df.select(*[F.coalesce(F.col(n), F.lit(0).cast(t)).alias(n) if t in numeric else F.col(n)
                       for n, t in df.dtypes])


MODEL_FEATURES = ["temperature_avg", "cold_pressure_avg", "hot_pressure_avg",
                  "crit_temp_dur", "crit_cold_dur", "crit_hot_dur",
                  "z_temp", "z_cold", "z_hot"]


#: Model inputs are rounded, so that rows equal but for the order of a summation stay equal.
MODEL_DECIMALS = 6


def model_inputs(df: DataFrame, prefix: str = "in_") -> DataFrame:
    """Append the nine model inputs as doubles rounded to ``MODEL_DECIMALS``, under ``prefix``."""
    return df.withColumns({f"{prefix}{c}": F.round(F.col(c).cast("double"), MODEL_DECIMALS) for c in MODEL_FEATURES})


def feature_matrix(zscored: DataFrame) -> DataFrame:
    """The nine model inputs per report (readings, critical durations, z-scores) as doubles."""
    return zscored.select("id", *[F.col(c).cast("double").alias(c) for c in MODEL_FEATURES])


def with_scaled(df: DataFrame, features: list[str] = MODEL_FEATURES, prefix: str = "") -> DataFrame:
    """Append (or replace, with ``prefix=""``) standardised copies of ``features``:
    (x - mean) / population stddev, a zero stddev scaling by 1.

    The fit is a scalar subquery of one row in the same plan; nothing runs
    before the result is asked for.
    """
    fit = df.agg(F.struct(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in features],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in features])).scalar()
    scale = {c: F.when(fit[f"s_{c}"] != 0, fit[f"s_{c}"]).otherwise(F.lit(1.0)) for c in features}
    return df.withColumns({f"{prefix}{c}": (F.col(c).cast("double") - fit[f"m_{c}"]) / scale[c] for c in features})


def scaled_features(matrix: DataFrame, features: list[str] = MODEL_FEATURES) -> DataFrame:
    """The feature matrix standardised column by column (see ``with_scaled``)."""
    return with_scaled(matrix, features).select("id", *features)
