"""Exploration queries: left-join semantics of the transmission comparison."""

import datetime as dt

import pytest

from tests.helpers import device_df, sensor_df
from tirepulse.operators import explore


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _inputs(spark):
    devices = device_df(spark, [dict(id=1, vehicle_id=1, device_id=2, report_start_at=dt.datetime(2024, 1, 3)),
                                dict(id=2, vehicle_id=1, device_id=3, report_start_at=dt.datetime(2024, 1, 4)),
                                dict(id=3, vehicle_id=2, device_id=4, report_start_at=dt.datetime(2024, 1, 4))])
    sensors = sensor_df(spark, [dict(id=10, vehicle_id=1, sensor_id=7, report_start_at=dt.datetime(2024, 1, 5)),
                                dict(id=11, vehicle_id=1, sensor_id=8, report_start_at=dt.datetime(2024, 2, 5)),
                                dict(id=12, vehicle_id=2, sensor_id=9, report_start_at=dt.datetime(2024, 1, 5))])
    return devices, sensors


def test_transmission_comparison_pairs_and_unmatched(spark, monkeypatch):
    devices, sensors = _inputs(spark)
    out = explore.transmission_comparison(devices, sensors, 1, "2024-01-01", "2024-02-01")
    got = {(r.d_id, r.id) for r in out.collect()}
    assert got == {(1, 10), (2, 10)}            # the February sensor report is outside the range
    # a vehicle whose sensors report nothing in the month keeps its hub rows (NULL sensor side)
    none = explore.transmission_comparison(devices, sensors.filter("id <> 12"), 2, "2024-01-01", "2024-02-01")
    assert [(r.d_id, r.id, r.s_tdur) for r in none.collect()] == [(3, None, None)]
    # the number of parts doesn't matter
    monkeypatch.setattr(explore, "COMPARE_PARTS", 1)
    assert _rows(explore.transmission_comparison(devices, sensors, 1, "2024-01-01", "2024-02-01")) == _rows(out)
    assert _rows(explore.transmission_comparison(devices, sensors.filter("id <> 12"), 2, "2024-01-01",
                                                 "2024-02-01")) == _rows(none)
    with pytest.raises(ValueError):
        explore.transmission_comparison(devices, sensors, None, "2024-01-01", "2024-02-01")
