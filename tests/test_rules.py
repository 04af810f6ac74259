"""Issue rules at both sides of their thresholds (FIXTURES.md §5)."""

import pytest

from tests.helpers import by_id, day, device_df, sensor_df
from tirepulse.operators import features, rules

S, E = "2024-01-01", "2024-01-31"


def classify(spark, rows):
    return rules.classify_sensor_issues(features.sensor_features(sensor_df(spark, rows), S, E))


def test_single_transmitting_report_is_frozen_hardware_fail(spark):
    out = by_id(classify(spark, [dict(report_start_at=day(0))]), "issue_category", "risk_score")
    assert out[1] == ("Hardware Fail", 80)


def test_not_transmitting_single_report_is_normal(spark):
    out = by_id(classify(spark, [dict(report_start_at=day(0), transmitting_dur=0)]), "issue_category")
    assert out[1] == "Normal"


def test_slow_leak_falling_cold_pressure(spark):
    rows = [dict(id=i + 1, report_start_at=day(i), cold_pressure_avg=100.0 - i,
                 temperature_avg=30.0 + (0.2 if i % 2 else -0.2)) for i in range(7)]
    out = by_id(classify(spark, rows), "issue_category", "risk_score", "cold_pressure_slope")
    assert out[7][0] == "Slow Leak" and out[7][1] == 100
    assert out[7][2] == pytest.approx(-1.0)


@pytest.mark.parametrize("drop,expected", [(10.0, "Normal"), (10.5, "Puncture")])
def test_puncture_drop_threshold(spark, drop, expected):
    # two days; level-3-low share 0.2 > 0.1; a drop of exactly 10 is not "more than 10"
    rows = [dict(id=1, report_start_at=day(0), cold_pressure_avg=100.0, temperature_avg=30.0),
            dict(id=2, report_start_at=day(1), cold_pressure_avg=100.0 - drop, temperature_avg=31.0,
                 level_3_low_cold_pressure_dur=10_000, level_3_low_cold_pressure_cnt=2)]
    out = by_id(classify(spark, rows), "issue_category", "risk_score")
    assert out[2][0] == expected
    if expected == "Puncture":
        assert out[2][1] == 30  # min(100, 0.2*100 + 2*5); not frozen (two distinct readings)


def test_frozen_puncture_keeps_category_takes_frozen_risk(spark):
    rows = [dict(id=1, report_start_at=day(0), cold_pressure_avg=100.0, temperature_avg=30.0),
            dict(id=2, report_start_at=day(1), cold_pressure_avg=80.0, temperature_avg=30.0,
                 level_3_low_cold_pressure_dur=10_000, level_3_low_cold_pressure_cnt=1)]
    out = by_id(classify(spark, rows), "issue_category", "risk_score")
    assert out[2] == ("Puncture", 80)


def test_gap_between_reports_gives_zero_deltas(spark):
    rows = [dict(id=1, report_start_at=day(0), cold_pressure_avg=100.0),
            dict(id=2, report_start_at=day(2), cold_pressure_avg=50.0)]
    out = by_id(features.sensor_features(sensor_df(spark, rows), S, E), "delta_cold", "prev_cold")
    assert out[2] == (0.0, 100.0)


def test_last_day_closed_range_keeps_midnight_only(spark):
    import datetime as dt
    rows = [dict(id=1, report_start_at=dt.datetime(2024, 1, 31, 0, 0)),
            dict(id=2, report_start_at=dt.datetime(2024, 1, 31, 5, 0), sensor_id=2)]
    assert sorted(by_id(features.sensor_features(sensor_df(spark, rows), S, E), "sensor_id")) == [1]


def test_impossible_value_risk_100(spark):
    rows = [dict(id=1, report_start_at=day(0), temperature_avg=200.0)]
    assert by_id(classify(spark, rows), "risk_score")[1] == 100


def test_thermal_stress(spark):
    rows = [dict(id=1, report_start_at=day(0), temperature_avg=30.0, hot_pressure_avg=110.0,
                 cold_pressure_avg=100.0),
            dict(id=2, report_start_at=day(1), temperature_avg=33.0, hot_pressure_avg=110.5,
                 cold_pressure_avg=101.0)]
    out = by_id(classify(spark, rows), "issue_category", "risk_score", "thermal_pressure_ratio")
    assert out[2][0] == "Thermal Stress" and out[2][1] == 100 and out[2][2] == pytest.approx(6.0)


def test_over_inflation(spark):
    rows = [dict(id=1, report_start_at=day(0), level_1_high_cold_pressure_dur=20_000,
                 level_2_high_hot_pressure_dur=0, transmitting_dur=50_000, cold_pressure_avg=100.0),
            dict(id=2, report_start_at=day(1), level_1_high_cold_pressure_dur=20_000,
                 transmitting_dur=50_000, cold_pressure_avg=100.5, temperature_avg=31.0)]
    out = by_id(classify(spark, rows), "issue_category", "risk_score")
    assert out[2] == ("Over-Inflation", 40)


def device_issues(spark, rows, sensor_rows):
    feats = features.device_features(device_df(spark, rows), sensor_df(spark, sensor_rows), S, E)
    return by_id(rules.classify_device_issues(feats), "issue_category", "risk_score")


def test_hub_rules(spark):
    d0 = day(0)
    rows = [dict(id=1, report_start_at=d0, transmitting_dur=30, not_transmitting_dur=70),      # eff 0.3
            dict(id=2, report_start_at=d0, transmitting_dur=29, not_transmitting_dur=71),      # eff 0.29
            dict(id=3, report_start_at=d0, transmitting_dur=29, not_transmitting_dur=71,
                 vehicle_maintenance=None),                                                    # NULL flag
            dict(id=4, report_start_at=d0, device_id=None),                                    # no hub
            dict(id=5, report_start_at=d0, vehicle_id=2)]                                      # no sensors
    sensor_rows = [dict(id=1, report_start_at=d0, vehicle_id=1)]
    out = device_issues(spark, rows, sensor_rows)
    assert out[1] == ("Normal", 0)
    assert out[2] == ("Hardware Fail", 71)
    assert out[3] == ("Normal", 0)
    assert out[4] == ("No Hardware", 0)
    assert out[5] == ("Hardware Fail", 100)


def test_risk_is_bounded_and_normal_iff_no_flag(spark):
    from tirepulse.sources.fixtures import load_reports
    sensors, _ = load_reports(spark, "/root/testdata/sf0.01")
    out = rules.classify_sensor_issues(features.sensor_features(sensors, S, E))
    any_flag = " OR ".join(["is_slow_leak", "is_puncture", "is_over_inflation", "is_thermal_stress",
                            "is_sensor_malfunction"])
    assert out.filter("risk_score < 0 OR risk_score > 100").count() == 0
    assert out.filter(f"(issue_category = 'Normal') = ({any_flag})").count() == 0


def test_reason_texts(spark):
    from pyspark.sql import functions as F
    rows = [(1, 1, 0, 0, 0, 0.0, 0.0, 0.0), (2, 0, 0, 0, 1, 2.5, 0.0, 0.0), (3, 0, 0, 0, 1, 1.0, 1.0, 0.0),
            (4, 1, 1, 0, 1, 3.5, -3.2, 0.0), (5, 0, 0, 0, 0, 2.5, -2.5, 2.1), (6, 0, 0, 0, 1, 1.6, -1.6, 2.5)]
    df = spark.createDataFrame(rows, "id int, is_temp_anomaly int, is_cold_press_anomaly int, "
                                     "is_hot_press_anomaly int, is_ml_anomaly int, z_temp double, "
                                     "z_cold double, z_dur_temp double")
    out = by_id(rules.explain_anomalies(df), "anomaly_detail_text", "anomaly_category", "is_anomaly_global")
    assert out[1] == ("Extreme Temp", "Thermal Failure", 1)
    assert out[2] == ("Pattern: Unusual Temp Trend", "Behavioral Anomaly (AI)", 1)
    assert out[3] == ("Complex Multivariate Pattern", "Behavioral Anomaly (AI)", 1)
    assert out[4] == ("Extreme Temp, Extreme Cold Press, (Confirmed by AI)", "Thermal Failure", 1)
    assert out[5] == ("Normal", "Normal", 0)
    assert out[6] == ("Pattern: Abnormal Time in Risk State & Physics Mismatch (High T / Low P)",
                      "Behavioral Anomaly (AI)", 1)
    assert F is not None


def test_missing_reading_biases_slope_like_the_source(spark):
    """n counts every row while the y sums skip NULLs (D5): slope -15/14, not 0."""
    rows = [dict(id=i + 1, report_start_at=day(i), cold_pressure_avg=10.0) for i in range(6)]
    rows.append(dict(id=7, report_start_at=day(6), cold_pressure_avg=None))
    out = by_id(classify(spark, rows), "cold_pressure_slope", "issue_category", "risk_score")
    assert out[7][0] == pytest.approx(-15 / 14)
    # leak by category precedence, frozen (stddev 0) by the risk's last-write order
    assert out[7][1:] == ("Slow Leak", 80)


def test_export_rounding_folds_negative_zero(spark):
    import math
    from tirepulse.plans.catalog import present
    r = present(spark.createDataFrame([(-0.0, -1e-9, 1.23456789)], "a double, b double, c double")).first()
    assert math.copysign(1, r.a) == 1 and math.copysign(1, r.b) == 1
    assert r.c == 1.234568


def test_issue_mix_matches_fixture_description(spark):
    """Category counts on the sf0.01 fixture, as stated in FIXTURES.md §4."""
    import __spark_entry__ as se
    q = se.queries()
    sensor = dict(q["sensor_issues"](spark, "/root/testdata/sf0.01").groupBy("issue_category").count().collect())
    assert sensor == {"Normal": 1994, "Slow Leak": 807, "Hardware Fail": 506, "Over-Inflation": 341,
                      "Puncture": 222, "Thermal Stress": 136}
    device = dict(q["device_issues"](spark, "/root/testdata/sf0.01").groupBy("issue_category").count().collect())
    assert device == {"Normal": 514, "Hardware Fail": 236, "No Hardware": 120}
