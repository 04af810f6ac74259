"""Hand-made report rows for rule tests (FIXTURES.md §5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tirepulse.sources.schema import DEVICE_SCHEMA, SENSOR_SCHEMA


def _rows(schema, rows, defaults):
    out = []
    for i, r in enumerate(rows):
        full = {f.name: None for f in schema.fields}
        full.update(defaults)
        full["id"] = r.get("id", i + 1)
        full.update(r)
        for k in ("report_start_at", "updated_at"):
            if isinstance(full[k], dt.date) and not isinstance(full[k], dt.datetime):
                full[k] = dt.datetime.combine(full[k], dt.time())
        out.append(tuple(full[f.name] for f in schema.fields))
    return out


SENSOR_DEFAULTS = dict(sensor_id=1, vehicle_id=1, wheel_position=1, wheel_id=1001, transmitting_dur=50_000,
                       not_transmitting_dur=36_400, temperature_avg=30.0, cold_pressure_avg=100.0,
                       hot_pressure_avg=110.0, level_1_high_cold_pressure_dur=0,
                       level_2_high_hot_pressure_dur=0, level_2_high_temperature_dur=0,
                       level_3_high_temperature_dur=0, level_3_low_cold_pressure_dur=0,
                       level_3_low_cold_pressure_cnt=0)
DEVICE_DEFAULTS = dict(vehicle_id=1, device_id=2, vehicle_out_of_service=0, vehicle_maintenance=0,
                       transmitting_dur=60_000, not_transmitting_dur=26_400, transmission_level=1)


def sensor_df(spark, rows):
    return spark.createDataFrame(_rows(SENSOR_SCHEMA, rows, SENSOR_DEFAULTS), SENSOR_SCHEMA)


def device_df(spark, rows):
    return spark.createDataFrame(_rows(DEVICE_SCHEMA, rows, DEVICE_DEFAULTS), DEVICE_SCHEMA)


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def by_id(df, *cols):
    return {r["id"]: (r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols))
            for r in df.select("id", *cols).collect()}


def col_list(df, c):
    return [r[0] for r in df.orderBy("id").select(F.col(c)).collect()]
