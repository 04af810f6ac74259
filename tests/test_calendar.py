"""Days without a report, and distinct sensors from bitmaps."""

import datetime as dt

from tests.helpers import day, device_df, sensor_df
from tirepulse.operators import calendar, kpis, presence

S, E = "2024-01-01", "2024-01-31"
D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)


def _hubs(spark):
    rows = [dict(vehicle_id=1, device_id=10, report_start_at=day(k), transmitting_dur=86_400) for k in range(6)]
    rows += [dict(vehicle_id=1, device_id=11, report_start_at=day(k), transmitting_dur=43_200) for k in (1, 2)]      # stops
    rows += [dict(vehicle_id=2, device_id=None, report_start_at=day(k), transmitting_dur=0) for k in (3, 5)]         # a gap, no hub id
    rows += [dict(vehicle_id=None, device_id=12, report_start_at=day(4), transmitting_dur=86_400),
             dict(vehicle_id=1, device_id=10, report_start_at=None, transmitting_dur=9)]
    return device_df(spark, [dict(r, id=k) for k, r in enumerate(rows)])


def test_a_hub_that_stops_counts_as_silent(spark):
    got = {(r.vehicle_id, r.report_date): (r.expected_days, r.reports, round(r.communication_pct, 6))
           for r in calendar.communication_calendar(_hubs(spark), S, E).collect()}
    assert got == {(1, D(0)): (1, 1, 100.0), (1, D(1)): (2, 2, 75.0), (1, D(2)): (2, 2, 75.0), (1, D(3)): (2, 1, 50.0),
                   (1, D(4)): (2, 1, 50.0), (1, D(5)): (2, 1, 50.0), (2, D(3)): (1, 1, 0.0), (2, D(4)): (1, 0, 0.0), (2, D(5)): (1, 1, 0.0),
                   (None, D(4)): (1, 1, 100.0), (None, D(5)): (1, 0, 0.0)}
    monthly = {r.vehicle_id: (r.expected_days, r.reports, round(r.communication_pct, 4))
               for r in calendar.communication_calendar(_hubs(spark), S, E, "month").collect()}
    assert monthly == {1: (11, 8, 63.6364), 2: (3, 2, 0.0), None: (2, 1, 50.0)}
    plain = kpis.communication_pct(_hubs(spark), S, E, "month").filter("vehicle_id = 1").first().communication_pct
    assert plain == 87.5                              # the variant of the days with a report is kept


def _wheels(spark):
    rows = [dict(sensor_id=1, report_start_at=day(k), transmitting_dur=5) for k in (0, 1, 4)]
    rows += [dict(sensor_id=2, report_start_at=day(1), transmitting_dur=0), dict(sensor_id=3, vehicle_id=2, report_start_at=day(0), transmitting_dur=7),
             dict(sensor_id=None, report_start_at=day(2), transmitting_dur=7), dict(sensor_id=1, report_start_at=day(1), transmitting_dur=0)]
    return sensor_df(spark, [dict(r, id=k) for k, r in enumerate(rows)])


def test_days_without_any_report_have_a_row(spark):
    got = [tuple(r) for r in calendar.sensor_coverage(_wheels(spark), S, E).orderBy("report_date").collect()]
    assert [r[:4] for r in got] == [(D(0), 2, 2, 2), (D(1), 3, 2, 1), (D(2), 3, 0, 0), (D(3), 3, 0, 0), (D(4), 3, 1, 1)]
    assert [round(r[4], 4) for r in got] == [0.0, 0.6667, 1.0, 1.0, 0.6667]
    vehicles = {(r.vehicle_id, r.report_date): (r.active_sensors, r.known_sensors, r.active_sensor_pct)
                for r in calendar.active_sensor_calendar(_wheels(spark), S, E).collect()}
    assert len(vehicles) == 10 and vehicles[1, D(0)] == (1, 2, 50.0) and vehicles[1, D(3)] == (0, 2, 0.0) and vehicles[2, D(4)] == (0, 1, 0.0)


def test_calendars_of_no_reports(spark):
    none, wheels = device_df(spark, []), sensor_df(spark, [])
    assert calendar.communication_calendar(none, S, E).count() == 0
    assert calendar.sensor_coverage(wheels, S, E).count() == 0 and calendar.active_sensor_calendar(wheels, S, E).count() == 0


def test_calendars_have_no_cross_join(spark):
    for df in (calendar.communication_calendar(_hubs(spark), S, E), calendar.sensor_coverage(_wheels(spark), S, E),
               calendar.active_sensor_calendar(_wheels(spark), S, E)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bitmaps_give_the_exact_counts(spark):
    """Ids over several buckets, negative ones, reports after midnight of the last day, NULL ids, two deliveries of a day."""
    rows = [dict(id=k, sensor_id=(None if k % 19 == 0 else (k * 7919) % 200_000 - 100), report_start_at=day(k % 31) + dt.timedelta(hours=5 * (k % 2)),
                 transmitting_dur=[0, 5, None][k % 3]) for k in range(600)]
    sensors = sensor_df(spark, rows + rows[:50])
    parts = [presence.presence(sensors.filter(c)) for c in ("id % 3 = 0", "id % 3 > 0", "id < 100")]
    table = presence.merged(*parts)
    assert table.groupBy(*presence.KEYS).count().filter("count > 1").count() == 0
    as_rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()))
    assert as_rows(presence.availability_daily(table, S, E)) == as_rows(kpis.sensor_availability_daily(sensors, S, E))
    assert presence.fleet_total(table).first() == kpis.fleet_sensor_total(sensors).first()
    month = presence.sensors_monthly(table, S, "2024-01-20").first()
    inside = [r for r in rows if r["sensor_id"] is not None and r["report_start_at"] <= dt.datetime(2024, 1, 20)]
    assert month.seen_sensors == len({r["sensor_id"] for r in inside})
    assert month.active_sensors == len({r["sensor_id"] for r in inside if (r["transmitting_dur"] or 0) > 0})


def test_availability_reads_the_bitmaps_alone(spark, tmp_path):
    path = str(tmp_path / "presence")
    presence.presence(_wheels(spark)).write.parquet(path)
    daily = presence.availability_daily(spark.read.parquet(path), S, E)
    assert [tuple(r)[:3] for r in daily.orderBy("report_date").collect()] == [(D(0), 2, 3), (D(1), 1, 3), (D(4), 1, 3)]
    assert {f.removeprefix("file://").removeprefix("file:").startswith(path) for f in daily.inputFiles()} == {True}
    assert presence.availability_daily(presence.presence(sensor_df(spark, [])), S, E).count() == 0
