"""Indicator semantics carried over from the source reports."""

import datetime as dt

import pytest

from tests.helpers import by_id, day, device_df, sensor_df
from tirepulse.operators import features, kpis

S, E = "2024-01-01", "2024-01-31"


def test_fleet_status_counts_rows_and_null_flags(spark):
    rows = [dict(id=1, report_start_at=day(0), vehicle_id=1, device_id=2),
            dict(id=2, report_start_at=day(0), vehicle_id=1, device_id=3),            # 2nd hub, same vehicle
            dict(id=3, report_start_at=day(0), vehicle_id=2, device_id=4,
                 vehicle_out_of_service=1, vehicle_maintenance=1),                      # in both buckets
            dict(id=4, report_start_at=day(0), vehicle_id=3, device_id=None,
                 vehicle_maintenance=None)]                                             # NULL flag: no bucket
    r = kpis.fleet_status(device_df(spark, rows), S, E).first()
    assert r.total_devices == 3
    assert (r.vehicles_out_of_service, r.vehicles_in_maintenance, r.operational_fleet) == (1, 1, 2)


def test_availability_fraction_and_baseline(spark):
    # 7 sensors ever seen (one only in December); 3 transmit on day 0; nobody on day 1
    rows = [dict(id=i + 1, sensor_id=i + 1, report_start_at=day(0), transmitting_dur=100 if i < 3 else 0)
            for i in range(6)]
    rows.append(dict(id=7, sensor_id=7, report_start_at=dt.datetime(2023, 12, 1)))
    rows.append(dict(id=8, sensor_id=1, report_start_at=day(1), transmitting_dur=0))
    daily = kpis.sensor_availability_daily(sensor_df(spark, rows), S, E).collect()
    assert len(daily) == 1                       # a day without transmission has no row
    r = daily[0]
    assert (r.active_sensors, r.total_sensors) == (3, 7)
    assert r.availability_pct == pytest.approx(0.4286)   # round(3/7*100, 2) / 100
    assert r.month_year == "2024-01"
    overall = kpis.sensor_availability_overall(kpis.sensor_availability_daily(
        sensor_df(spark, rows[:1]).filter("id < 0"), S, E)).first()[0]
    assert overall == 0.0


def test_zscore_frame_fills_missing_readings_with_zero(spark):
    rows = [dict(id=1, report_start_at=day(0), temperature_avg=None, sensor_id=5)]
    r = features.sensor_zscores(sensor_df(spark, rows), S, E).first()
    assert r.temperature_avg == 0.0 and r.z_temp == 0.0 and r.sd_temp == 0.0


def test_device_features_do_not_multiply_rows(spark):
    from tirepulse.sources.fixtures import load_reports
    from tirepulse.operators.common import report_window
    sensors, devices = load_reports(spark, "/root/testdata/sf0.01")
    assert features.device_features(devices, sensors, S, E).count() == report_window(devices, S, E).count()


def test_connectivity_null_when_no_time(spark):
    rows = [dict(id=1, report_start_at=day(0), transmitting_dur=0, not_transmitting_dur=0),
            dict(id=2, report_start_at=day(0), device_id=9, transmitting_dur=43_200, not_transmitting_dur=43_200)]
    out = {r.device_id: r.connectivity_efficiency_pct
           for r in kpis.device_connectivity(device_df(spark, rows), S, E).collect()}
    assert out[2] is None and out[9] == 0.5
    worst = kpis.worst_device(kpis.device_connectivity(device_df(spark, rows), S, E)).first()
    assert worst.worst_device_id == 9   # NULL efficiency sorts last


def test_level_distribution_shares_sum_to_one(spark):
    from tirepulse.sources.fixtures import load_reports
    sensors, _ = load_reports(spark, "/root/testdata/sf0.01")
    out = kpis.level_distribution(sensors, S, E)
    cols = [c for c in out.columns if c.startswith("pct_") and c != "pct_no_data"]
    for r in out.collect():
        assert sum(r[c] for c in cols) == pytest.approx(1.0)
    assert by_id is not None


def test_worst_device_is_a_hub(spark):
    rows = [dict(id=1, vehicle_id=1, device_id=None, transmitting_dur=0, not_transmitting_dur=86_400, report_start_at=day(0)),
            dict(id=2, vehicle_id=2, device_id=9, transmitting_dur=50, not_transmitting_dur=50, report_start_at=day(0))]
    worst = kpis.worst_device(kpis.device_connectivity(device_df(spark, rows), S, E)).first()
    assert worst.worst_device_id == 9


def test_silent_vehicles_and_null_vehicles_have_an_activity_row(spark):
    rows = [dict(id=1, vehicle_id=1, sensor_id=1, transmitting_dur=0, report_start_at=day(0)),
            dict(id=2, vehicle_id=None, sensor_id=2, transmitting_dur=5, report_start_at=day(0)),
            dict(id=3, vehicle_id=2, sensor_id=None, transmitting_dur=5, report_start_at=day(0))]
    got = {r.vehicle_id: r.active_sensor_pct for r in kpis.vehicle_active_sensor_pct(sensor_df(spark, rows), S, E).collect()}
    assert got == {1: 0.0, None: 100.0, 2: None}


def test_day_of_unnamed_sensors_has_an_extreme_level_row(spark):
    rows = [dict(id=1, sensor_id=None, level_3_high_temperature_dur=9, report_start_at=day(0)),
            dict(id=2, sensor_id=4, level_3_high_temperature_dur=9, report_start_at=day(1))]
    got = sorted(tuple(r)[1:] for r in kpis.extreme_level_sensors(sensor_df(spark, rows), S, E).collect())
    assert got == [(0, 0, 0, 0), (1, 0, 0, 1)]


def test_nan_readings_count_as_missing(spark):
    from tirepulse.operators.rules import classify_sensor_issues
    rows = [dict(id=k + 1, report_start_at=day(k), temperature_avg=float("nan") if k == 2 else 30.0 + k,
                 cold_pressure_avg=100.0 + k % 2) for k in range(4)]
    out = {r.id: r for r in classify_sensor_issues(features.sensor_features(sensor_df(spark, rows), S, E)).collect()}
    assert out[3].temperature_avg is None and out[3].risk_score == 0 and out[3].issue_category == "Normal"
