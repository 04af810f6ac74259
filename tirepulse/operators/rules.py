"""Rule engines as column expressions: issue classification, risk scores, reasons.

All rules are built-in expressions (no Python UDF), so they run inside
whole-stage codegen right after the window/aggregate that feeds them.
A NULL comparison counts as false everywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tirepulse.functions.expr import truthy


# Thresholds of the mechanical-failure report (must equal the source).
@dataclass(frozen=True)
class IssueThresholds:
    slope_window_days: int = 7
    over_inflation: float = 0.3          # fraction of transmitting time
    slow_leak_slope: float = -0.5        # pressure units per day
    temp_slope: float = 0.5              # degrees per day
    puncture_drop: float = 10            # pressure drop in one day
    puncture_level3_share: float = 0.1   # fraction of transmitting time
    thermal_ratio: float = 2.0
    frozen_std: float = 0.001            # effectively no variation
    hub_efficiency: float = 0.3          # hub uptime fraction
    # rule constants written inline in the source
    high_temp_share: float = 0.1
    thermal_hot_rise: float = 1
    temp_min: float = -50
    temp_max: float = 150
    cold_min: float = 0
    cold_max: float = 200
    puncture_count_weight: float = 5
    frozen_risk: int = 80
    impossible_risk: int = 100


DEFAULT = IssueThresholds()

# Category labels (must equal the source outputs).
PUNCTURE, OVER_INFLATION, SLOW_LEAK = "Puncture", "Over-Inflation", "Slow Leak"
THERMAL_STRESS, HARDWARE_FAIL, NORMAL, NO_HARDWARE = "Thermal Stress", "Hardware Fail", "Normal", "No Hardware"


def _capped(x: Column) -> Column:
    """``min(100, x)`` where a NULL/NaN input yields 0 (numpy min then fillna(0))."""
    return F.when(x.isNull() | F.isnan(x), F.lit(0.0)).otherwise(F.least(F.lit(100.0), x))


def sensor_masks(th: IssueThresholds = DEFAULT) -> dict[str, Column]:
    """The rule masks as expressions (NULL treated as false)."""
    c = F.col
    frozen = (c("std_temp") < th.frozen_std) | (c("std_cold") < th.frozen_std)
    impossible = ((c("temperature_avg") < th.temp_min) | (c("temperature_avg") > th.temp_max)
                  | (c("cold_pressure_avg") < th.cold_min) | (c("cold_pressure_avg") > th.cold_max))
    level3_share = c("level_3_low_cold_pressure_dur") / F.nullif(c("transmitting_dur"), F.lit(0))
    return {
        "is_slow_leak": truthy((c("cold_pressure_slope") < th.slow_leak_slope)
                               & (F.abs(c("temperature_slope")) < th.temp_slope)),
        "is_puncture": truthy((c("delta_cold") < -th.puncture_drop)
                              & (level3_share > th.puncture_level3_share)
                              & (c("transmitting_dur") > 0)),
        "is_over_inflation": truthy((c("over_inflation_index") > th.over_inflation)
                                    & (c("high_temp_dur_ratio") < th.high_temp_share)),
        "is_thermal_stress": truthy((c("thermal_pressure_ratio") > th.thermal_ratio)
                                    & (c("delta_temp") > 0) & (c("delta_hot") < th.thermal_hot_rise)),
        "is_sensor_malfunction": truthy((c("transmitting_dur") > 0) & (frozen | impossible)),
        "frozen": truthy(frozen),
        "impossible": truthy(impossible),
    }


FLAG_NAMES = ["is_slow_leak", "is_puncture", "is_over_inflation", "is_thermal_stress", "is_sensor_malfunction"]


def sensor_issue_flags(features: DataFrame, th: IssueThresholds = DEFAULT) -> DataFrame:
    """Adds the five boolean masks (NULL treated as false)."""
    m = sensor_masks(th)
    return features.withColumns({k: m[k] for k in FLAG_NAMES})


def classify_sensor_issues(features: DataFrame, th: IssueThresholds = DEFAULT) -> DataFrame:
    """Flags, ``issue_category`` and integer ``risk_score`` (0-100) per sensor report.

    Category precedence: Puncture > Over-Inflation > Slow Leak > Thermal Stress >
    Hardware Fail > Normal. Risk follows the source's *assignment* order
    (leak, puncture, over-inflation, thermal, frozen, impossible) where the last
    matching assignment wins, so it is a ``when`` chain in reverse order; the
    two precedences differ on purpose (a frozen puncture is "Puncture", risk 80).
    """
    c = F.col
    m = sensor_masks(th)
    category = (F.when(m["is_puncture"], PUNCTURE)
                .when(m["is_over_inflation"], OVER_INFLATION)
                .when(m["is_slow_leak"], SLOW_LEAK)
                .when(m["is_thermal_stress"], THERMAL_STRESS)
                .when(m["is_sensor_malfunction"], HARDWARE_FAIL)
                .otherwise(NORMAL))
    malfunction = m["is_sensor_malfunction"]
    risk = (F.when(malfunction & m["impossible"], F.lit(float(th.impossible_risk)))
            .when(malfunction & m["frozen"], F.lit(float(th.frozen_risk)))
            .when(m["is_thermal_stress"],
                  _capped(c("thermal_pressure_ratio") / th.thermal_ratio * 100))
            .when(m["is_over_inflation"], _capped(c("over_inflation_index") * 100))
            .when(m["is_puncture"],
                  _capped(c("level_3_low_cold_pressure_dur") / c("transmitting_dur") * 100
                          + c("level_3_low_cold_pressure_cnt") * th.puncture_count_weight))
            .when(m["is_slow_leak"],
                  _capped(F.abs(c("cold_pressure_slope")) / abs(th.slow_leak_slope) * 100))
            .otherwise(F.lit(0.0)))
    return features.withColumns({**{k: m[k] for k in FLAG_NAMES},
                                 "issue_category": category, "risk_score": risk.cast("int")})


def classify_device_issues(features: DataFrame, th: IssueThresholds = DEFAULT) -> DataFrame:
    """Hub rules: no hub installed, hub failure (low uptime or no active sensor), risk.

    A hub in maintenance or out of service (or with a NULL flag) is never a
    failure. Risk is 100 with no active sensor, else trunc(100 - uptime*100).
    """
    c = F.col
    has_hub = c("device_id").isNotNull()
    malfunction = truthy(has_hub
                         & ((c("connectivity_efficiency") < th.hub_efficiency) | (c("active_sensors") == 0))
                         & (c("vehicle_maintenance") == 0) & (c("vehicle_out_of_service") == 0))
    out = features.withColumns({"has_hub": has_hub, "is_hub_malfunction": malfunction})
    category = (F.when(~c("has_hub"), NO_HARDWARE)
                .when(c("is_hub_malfunction"), HARDWARE_FAIL)
                .otherwise(NORMAL))
    risk = (F.when(c("is_hub_malfunction") & (c("active_sensors") == 0), F.lit(100.0))
            .when(c("is_hub_malfunction"), F.lit(100.0) - c("connectivity_efficiency") * 100)
            .otherwise(F.lit(0.0)))
    risk = F.when(risk.isNull(), F.lit(0.0)).otherwise(risk)
    return out.withColumns({"issue_category": category, "risk_score": risk.cast("int")})


# --------------------------------------------------------------------------
# Anomaly flags and explanations
# --------------------------------------------------------------------------

# Reason texts, categories and near-miss limits of the anomaly report.
Z_THRESHOLD = 3.0
NEAR_MISS_Z = 2.0
MISMATCH_Z = 1.5
EXTREME_TEMP, EXTREME_COLD, EXTREME_HOT = "Extreme Temp", "Extreme Cold Press", "Extreme Hot Press"
UNUSUAL_TEMP, UNUSUAL_PRESSURE = "Unusual Temp Trend", "Unusual Pressure Trend"
RISK_STATE_TIME = "Abnormal Time in Risk State"
PHYSICS_MISMATCH = "Physics Mismatch (High T / Low P)"
COMPLEX_PATTERN = "Complex Multivariate Pattern"
CONFIRMED = "(Confirmed by AI)"
THERMAL_FAILURE, PRESSURE_FAILURE, BEHAVIORAL = "Thermal Failure", "Pressure Failure", "Behavioral Anomaly (AI)"


def zscore_flags(zscored: DataFrame, z_threshold: float = Z_THRESHOLD) -> DataFrame:
    """0/1 flags ``|z| > z_threshold`` for temperature, cold and hot pressure.

    With the default 7-report window (current row included) and the sample
    stddev, ``|z| <= 6/sqrt(7) ~ 2.268``, so the default threshold 3 never
    fires; the parameter exists to use other thresholds.
    """
    c = F.col
    return zscored.withColumns({
        "is_temp_anomaly": (F.abs(c("z_temp")) > z_threshold).cast("int"),
        "is_cold_press_anomaly": (F.abs(c("z_cold")) > z_threshold).cast("int"),
        "is_hot_press_anomaly": (F.abs(c("z_hot")) > z_threshold).cast("int"),
    })


def explain_anomalies(flagged: DataFrame, ml_flag: str = "is_ml_anomaly") -> DataFrame:
    """Global flag, readable reason text and chart category per report.

    Needs the z flags, ``z_temp``/``z_cold``/``z_dur_temp`` and a 0/1 model
    flag column. Built from ``concat_ws`` (which skips NULL parts) and ``when``.
    """
    c = F.col
    t, cp, hp, ml = (c("is_temp_anomaly") == 1, c("is_cold_press_anomaly") == 1,
                     c("is_hot_press_anomaly") == 1, c(ml_flag) == 1)
    stat = t | cp | hp
    stat_text = F.concat_ws(", ", F.when(t, F.lit(EXTREME_TEMP)), F.when(cp, F.lit(EXTREME_COLD)),
                            F.when(hp, F.lit(EXTREME_HOT)))
    near = F.concat_ws(" & ",
                       F.when(F.abs(c("z_temp")) > NEAR_MISS_Z, F.lit(UNUSUAL_TEMP)),
                       F.when(F.abs(c("z_cold")) > NEAR_MISS_Z, F.lit(UNUSUAL_PRESSURE)),
                       F.when(F.abs(c("z_dur_temp")) > NEAR_MISS_Z, F.lit(RISK_STATE_TIME)),
                       F.when((c("z_temp") > MISMATCH_Z) & (c("z_cold") < -MISMATCH_Z),
                              F.lit(PHYSICS_MISMATCH)))
    detail = (F.when(ml & ~stat, F.when(near != "", F.concat(F.lit("Pattern: "), near))
                     .otherwise(F.lit(COMPLEX_PATTERN)))
              .when(ml & stat, F.concat_ws(", ", stat_text, F.lit(CONFIRMED)))
              .when(stat, stat_text)
              .otherwise(F.lit(NORMAL)))
    category = (F.when(t, THERMAL_FAILURE).when(cp | hp, PRESSURE_FAILURE)
                .when(ml, BEHAVIORAL).otherwise(NORMAL))
    return flagged.withColumns({
        "is_anomaly_global": F.greatest(c("is_temp_anomaly"), c("is_cold_press_anomaly"),
                                        c("is_hot_press_anomaly"), c(ml_flag).cast("int")),
        "anomaly_detail_text": detail,
        "anomaly_category": category,
    })
