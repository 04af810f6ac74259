"""Typed schemas of the two daily report tables.

One row per hub and day (device report) and one row per wheel sensor and day
(sensor report). The sensor level columns form a regular cube
metric x level x side x {dur, cnt}, so their names are generated.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed vocabulary of the report tables (must equal the source column names).
METRICS = ("temperature", "cold_pressure", "hot_pressure")
SIDES = ("high", "low")
LEVELS = (1, 2, 3)
STATS = ("min", "max", "sd", "avg")
DATE_COLUMNS = ("report_start_at", "updated_at")
SECONDS_PER_DAY = 86_400


def level_col(level: int, side: str, metric: str, kind: str = "dur") -> str:
    return f"level_{level}_{side}_{metric}_{kind}"


def level_dur_cols(metric: str) -> list[str]:
    """The six non-optimal duration columns of a metric, high 1-3 then low 1-3."""
    return [level_col(lv, sd, metric) for sd in SIDES for lv in LEVELS]


def level_cnt_cols(metric: str) -> list[str]:
    return [level_col(lv, sd, metric, "cnt") for sd in SIDES for lv in LEVELS]


def optimal_col(metric: str) -> str:
    return f"optimal_{metric}_dur"


def _fields(pairs):
    return [T.StructField(name, dtype, True) for name, dtype in pairs]


_TS = T.TimestampNTZType()

DEVICE_COLUMNS = [
    ("id", T.LongType()),
    ("vehicle_id", T.IntegerType()),
    ("device_id", T.IntegerType()),
    ("vehicle_out_of_service", T.ShortType()),
    ("vehicle_maintenance", T.ShortType()),
    ("transmitting_dur", T.IntegerType()),
    ("not_transmitting_dur", T.IntegerType()),
    ("transmission_level", T.ShortType()),
    ("report_start_at", _TS),
    ("updated_at", _TS),
]


def _sensor_columns():
    cols = [
        ("id", T.LongType()),
        ("sensor_id", T.IntegerType()),
        ("wheel_position", T.IntegerType()),
        ("wheel_id", T.IntegerType()),
        ("vehicle_id", T.IntegerType()),
        ("vehicle_out_of_service", T.ShortType()),
        ("vehicle_maintenance", T.ShortType()),
        ("sensor_priority", T.ShortType()),
        ("sensor_type_id", T.ShortType()),
        ("priority_order", T.IntegerType()),
    ]
    for metric in METRICS:
        cols += [(c, T.IntegerType()) for c in level_dur_cols(metric)]
        cols.append((optimal_col(metric), T.IntegerType()))
        cols += [(c, T.IntegerType()) for c in level_cnt_cols(metric)]
    for metric in METRICS:
        cols += [(f"{metric}_{s}", T.FloatType()) for s in STATS]
    cols += [
        ("transmitting_dur", T.IntegerType()),
        ("not_transmitting_dur", T.IntegerType()),
        ("transmission_level", T.IntegerType()),
        ("report_start_at", _TS),
        ("updated_at", _TS),
    ]
    return cols


SENSOR_COLUMNS = _sensor_columns()

DEVICE_SCHEMA = T.StructType(_fields(DEVICE_COLUMNS))
SENSOR_SCHEMA = T.StructType(_fields(SENSOR_COLUMNS))

SENSOR_TABLE = "time_in_level_sensor"
DEVICE_TABLE = "time_in_level_device"
