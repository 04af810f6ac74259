"""Daily report tables derived from the driver's ``events`` table.

No real telemetry ships with the task, so the two report tables are a fixed,
deterministic mapping of ``events`` (see FIXTURES.md §4): one sensor report per
(user, day) of events and one or two hub reports per (vehicle, day), where a
vehicle is a block of six users. The same expression table renders the
DataFrame (Spark) and the CTE text used by the DuckDB oracle, so both engines
see identical inputs.

Scale: both views are one partial (map-side combined) aggregation of
``events`` on its group keys; nothing else is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tirepulse.sources.schema import DEVICE_COLUMNS, SENSOR_COLUMNS

# Report window used by every registered query (events cover 2024-01-01..30).
REPORT_START = "2024-01-01"
REPORT_END = "2024-01-31"

# ---------------------------------------------------------------------------
# The fixture mapping of FIXTURES.md §4.1 (sensor report).
# Base columns: u = user_id, d = event date, id = first event id of the day,
# c = sum of round(value*100), k = day of month.
# ---------------------------------------------------------------------------
SENSOR_READINGS = [
    ("tx", "CASE WHEN c % 23 = 0 THEN NULL WHEN u % 10 = 3 THEN 300 WHEN u % 50 = 7 THEN 1700 "
           "WHEN u % 10 = 4 THEN 300 + c % 3 ELSE 250 + c % 100 END"),
    ("cx", "CASE WHEN c % 29 = 0 THEN NULL WHEN u % 10 = 3 THEN 1000 WHEN u % 10 = 4 THEN 1300 - 20*k "
           "ELSE 1000 + c % 400 END"),
    ("hx", "CASE WHEN u % 10 = 3 THEN 1100 ELSE 1100 + c % 37 END"),
]

_VEH = "(u - u % 6)/6"
SENSOR_EXPRS = {
    "id": "id",
    "sensor_id": "CAST(u AS INT)",
    "wheel_position": "CAST(u % 6 + 1 AS INT)",
    "wheel_id": "CAST(u + 1000 AS INT)",
    "vehicle_id": f"CAST({_VEH} AS INT)",
    "vehicle_out_of_service": f"CAST(CASE WHEN ({_VEH} + k) % 13 = 0 THEN 1 ELSE 0 END AS SMALLINT)",
    "vehicle_maintenance": f"CAST(CASE WHEN ({_VEH} + k) % 17 = 0 THEN 1 ELSE 0 END AS SMALLINT)",
    "sensor_priority": "CAST(u % 3 AS SMALLINT)",
    "sensor_type_id": "CAST(u % 2 AS SMALLINT)",
    "priority_order": "CAST(u % 5 AS INT)",
    "level_1_high_temperature_dur": "CASE WHEN c % 4 = 0 THEN c % 1000 ELSE 0 END",
    "level_2_high_temperature_dur": "c % 1500",
    "level_3_high_temperature_dur": "CASE WHEN c % 7 = 0 THEN NULL ELSE c % 700 END",
    "level_1_low_temperature_dur": "CASE WHEN c % 4 = 0 THEN c % 1000 ELSE 0 END",
    "level_2_low_temperature_dur": "CASE WHEN c % 5 = 0 THEN c % 1000 ELSE 0 END",
    "level_3_low_temperature_dur": "CASE WHEN c % 6 = 0 THEN c % 300 ELSE 0 END",
    "optimal_temperature_dur": "c % 40000",
    "level_1_high_temperature_cnt": "c % 5",
    "level_2_high_temperature_cnt": "c % 6",
    "level_3_high_temperature_cnt": "c % 7",
    "level_1_low_temperature_cnt": "c % 5",
    "level_2_low_temperature_cnt": "c % 6",
    "level_3_low_temperature_cnt": "c % 7",
    "level_1_high_cold_pressure_dur": "CASE WHEN u % 10 = 5 THEN 9000 + c % 9000 ELSE c % 3000 END",
    "level_2_high_cold_pressure_dur": "CASE WHEN c % 5 = 0 THEN c % 1000 ELSE 0 END",
    "level_3_high_cold_pressure_dur": "CASE WHEN c % 5 = 0 THEN c % 500 ELSE 0 END",
    "level_1_low_cold_pressure_dur": "CASE WHEN c % 4 = 0 THEN c % 1000 ELSE 0 END",
    "level_2_low_cold_pressure_dur": "CASE WHEN c % 5 = 0 THEN c % 1000 ELSE 0 END",
    "level_3_low_cold_pressure_dur": "CASE WHEN c % 3 = 0 THEN 12000 + c % 5000 ELSE 0 END",
    "optimal_cold_pressure_dur": "c % 40000",
    "level_1_high_cold_pressure_cnt": "c % 5",
    "level_2_high_cold_pressure_cnt": "c % 6",
    "level_3_high_cold_pressure_cnt": "c % 7",
    "level_1_low_cold_pressure_cnt": "c % 5",
    "level_2_low_cold_pressure_cnt": "c % 6",
    "level_3_low_cold_pressure_cnt": "c % 9",
    "level_1_high_hot_pressure_dur": "CASE WHEN c % 4 = 0 THEN c % 1000 ELSE 0 END",
    "level_2_high_hot_pressure_dur": "CASE WHEN u % 10 = 5 THEN 9000 + c % 7000 ELSE c % 2000 END",
    "level_3_high_hot_pressure_dur": "CASE WHEN c % 8 = 0 THEN c % 400 ELSE 0 END",
    "level_1_low_hot_pressure_dur": "CASE WHEN c % 4 = 0 THEN c % 1000 ELSE 0 END",
    "level_2_low_hot_pressure_dur": "CASE WHEN c % 5 = 0 THEN c % 1000 ELSE 0 END",
    "level_3_low_hot_pressure_dur": "CASE WHEN c % 9 = 0 THEN c % 350 ELSE 0 END",
    "optimal_hot_pressure_dur": "c % 40000",
    "level_1_high_hot_pressure_cnt": "c % 5",
    "level_2_high_hot_pressure_cnt": "c % 6",
    "level_3_high_hot_pressure_cnt": "c % 7",
    "level_1_low_hot_pressure_cnt": "c % 5",
    "level_2_low_hot_pressure_cnt": "c % 6",
    "level_3_low_hot_pressure_cnt": "c % 7",
    "temperature_min": "CAST(tx - 10 AS FLOAT)/CAST(10 AS FLOAT)",
    "temperature_max": "CAST(tx + 10 AS FLOAT)/CAST(10 AS FLOAT)",
    "temperature_sd": "CAST(c % 50 AS FLOAT)/CAST(10 AS FLOAT)",
    "temperature_avg": "CAST(tx AS FLOAT)/CAST(10 AS FLOAT)",
    "cold_pressure_min": "CAST(cx - 10 AS FLOAT)/CAST(10 AS FLOAT)",
    "cold_pressure_max": "CAST(cx + 10 AS FLOAT)/CAST(10 AS FLOAT)",
    "cold_pressure_sd": "CAST(c % 50 AS FLOAT)/CAST(10 AS FLOAT)",
    "cold_pressure_avg": "CAST(cx AS FLOAT)/CAST(10 AS FLOAT)",
    "hot_pressure_min": "CAST(hx - 10 AS FLOAT)/CAST(10 AS FLOAT)",
    "hot_pressure_max": "CAST(hx + 10 AS FLOAT)/CAST(10 AS FLOAT)",
    "hot_pressure_sd": "CAST(c % 50 AS FLOAT)/CAST(10 AS FLOAT)",
    "hot_pressure_avg": "CAST(hx AS FLOAT)/CAST(10 AS FLOAT)",
    "transmitting_dur": "CASE WHEN c % 11 = 0 THEN 0 ELSE 20000 + c % 66401 END",
    "not_transmitting_dur": "CASE WHEN c % 11 = 0 THEN 86400 ELSE 66400 - c % 66401 END",
    "transmission_level": "c % 4",
    "report_start_at": "d",
    "updated_at": "d",
}

# ---------------------------------------------------------------------------
# The fixture mapping of FIXTURES.md §4.2 (hub report).
# Base columns: v = vehicle, d = date, id0 = first event id of the vehicle-day,
# c0 = sum of round(value*100). A vehicle with v % 5 = 1 (and v % 7 <> 0) has a
# second hub; v % 7 = 0 has no hub (NULL device_id).
# ---------------------------------------------------------------------------
DEVICE_EXPRS = {
    "id": "id",
    "vehicle_id": "CAST(v AS INT)",
    "device_id": "CAST(dev AS INT)",
    "vehicle_out_of_service": "CAST(CASE WHEN (v + k) % 13 = 0 THEN 1 ELSE 0 END AS SMALLINT)",
    "vehicle_maintenance": "CAST(CASE WHEN c % 31 = 0 THEN NULL WHEN (v + k) % 17 = 0 THEN 1 ELSE 0 END AS SMALLINT)",
    "transmitting_dur": "CASE WHEN c % 19 = 0 THEN 0 WHEN c % 5 = 0 THEN c % 300 ELSE c % 86401 END",
    "not_transmitting_dur": "CASE WHEN c % 19 = 0 THEN 0 WHEN c % 5 = 0 THEN 86400 - c % 300 ELSE 86400 - c % 86401 END",
    "transmission_level": "c % 4",
    "report_start_at": "d",
    "updated_at": "d",
}


def _typed(exprs: dict[str, str], columns) -> list[tuple[str, str]]:
    """(name, expression cast to its declared type) in declared column order."""
    out = []
    for name, dtype in columns:
        sql_type = "TIMESTAMP" if name in ("report_start_at", "updated_at") else dtype.simpleString().upper()
        out.append((name, f"CAST({exprs[name]} AS {sql_type})"))
    return out


def _spark_typed(exprs: dict[str, str], columns) -> list[str]:
    """The typed projection as SQL expressions, applied with one ``selectExpr``
    (one JVM call instead of several per column)."""
    out = []
    for name, dtype in columns:
        sql_type = "TIMESTAMP_NTZ" if name in ("report_start_at", "updated_at") else dtype.simpleString()
        out.append(f"CAST({exprs[name]} AS {sql_type}) AS {name}")
    return out


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def sensor_reports_from_events(events: DataFrame) -> DataFrame:
    """Sensor report (one row per user and day of events), typed as SENSOR_SCHEMA."""
    base = (events
            .groupBy(F.col("user_id").alias("u"), F.to_date("ts").alias("d"))
            .agg(F.min("event_id").alias("id"),
                 F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("c"))
            .withColumn("k", F.dayofmonth("d").cast("bigint")))
    base = base.selectExpr("*", *[f"{e} AS {n}" for n, e in SENSOR_READINGS])
    return base.selectExpr(*_spark_typed(SENSOR_EXPRS, SENSOR_COLUMNS))


def device_reports_from_events(events: DataFrame) -> DataFrame:
    """Hub report (one or two rows per vehicle and day), typed as DEVICE_SCHEMA.

    The optional second hub is produced with ``explode`` over a one- or
    two-element array, so the vehicle-day aggregate is computed once.
    """
    veh = ((F.col("user_id") - F.col("user_id") % 6) / 6).cast("bigint")
    base = (events
            .groupBy(veh.alias("v"), F.to_date("ts").alias("d"))
            .agg(F.min("event_id").alias("id0"),
                 F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("c0")))
    two_hubs = (F.col("v") % 5 == 1) & (F.col("v") % 7 != 0)
    hubs = base.withColumn(
        "hub", F.explode(F.when(two_hubs, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    hubs = hubs.select(
        "v", "d",
        (2 * F.col("id0") + F.col("hub")).alias("id"),
        F.when(F.col("hub") == 1, 2 * F.col("v") + 1)
         .when(F.col("v") % 7 == 0, F.lit(None))
         .otherwise(2 * F.col("v")).alias("dev"),
        (F.col("c0") + 7 * F.col("hub")).alias("c"),
        F.dayofmonth("d").cast("bigint").alias("k"))
    return hubs.selectExpr(*_spark_typed(DEVICE_EXPRS, DEVICE_COLUMNS))


_VIEWS: dict[tuple[int, str], tuple[SparkSession, DataFrame, DataFrame]] = {}


def load_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(sensor_reports, device_reports) derived from ``{sf_dir}/events.parquet``.

    The lazy view plans are built once per session and folder and reused
    (DataFrames are immutable plans; no data is cached).
    """
    key = (id(spark), sf_dir)
    hit = _VIEWS.get(key)
    if hit is None or hit[0] is not spark:
        events = events_table(spark, sf_dir)
        hit = (spark, sensor_reports_from_events(events), device_reports_from_events(events))
        _VIEWS[key] = hit
    return hit[1], hit[2]


# ---------------------------------------------------------------------------
# The same views as SQL text, for the DuckDB oracle (only driver tables exist
# there). Built from the expression tables above.
# ---------------------------------------------------------------------------

def sensor_view_sql(events: str = "events") -> str:
    readings = ",\n    ".join(f"{e} AS {n}" for n, e in SENSOR_READINGS)
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in _typed(SENSOR_EXPRS, SENSOR_COLUMNS))
    return f"""SELECT
  {cols}
FROM (
  SELECT *,
    {readings}
  FROM (
    SELECT user_id AS u, CAST(ts AS DATE) AS d, MIN(event_id) AS id,
      CAST(SUM(CAST(ROUND(value*100) AS BIGINT)) AS BIGINT) AS c,
      CAST(EXTRACT(DAY FROM CAST(MIN(ts) AS DATE)) AS BIGINT) AS k
    FROM {events} GROUP BY user_id, CAST(ts AS DATE)) b) t"""


def device_view_sql(events: str = "events") -> str:
    cols = ",\n  ".join(f"{e} AS {n}" for n, e in _typed(DEVICE_EXPRS, DEVICE_COLUMNS))
    return f"""SELECT
  {cols}
FROM (
  SELECT v, d, 2*id0 AS id, CASE WHEN v % 7 = 0 THEN NULL ELSE 2*v END AS dev,
    CAST(c0 AS BIGINT) AS c, CAST(EXTRACT(DAY FROM d) AS BIGINT) AS k FROM vb
  UNION ALL
  SELECT v, d, 2*id0 + 1, 2*v + 1, CAST(c0 AS BIGINT) + 7, CAST(EXTRACT(DAY FROM d) AS BIGINT)
  FROM vb WHERE v % 5 = 1 AND v % 7 <> 0) e"""


def device_base_sql(events: str = "events") -> str:
    return f"""SELECT CAST((user_id - user_id % 6)/6 AS BIGINT) AS v, CAST(ts AS DATE) AS d,
    MIN(event_id) AS id0, SUM(CAST(ROUND(value*100) AS BIGINT)) AS c0
  FROM {events} GROUP BY CAST((user_id - user_id % 6)/6 AS BIGINT), CAST(ts AS DATE)"""


def fixture_ctes() -> str:
    """``WITH`` prefix defining both report tables for oracle SQL."""
    return (f"WITH time_in_level_sensor AS (\n{sensor_view_sql()}\n),\n"
            f"vb AS (\n{device_base_sql()}\n),\n"
            f"time_in_level_device AS (\n{device_view_sql()}\n)")
