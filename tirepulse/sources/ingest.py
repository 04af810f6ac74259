"""Typed ingestion of raw report files (description file + data file).

A report ships as two files: a ``|``-separated description whose
``column_name`` column lists the data columns in order, and a comma-separated
data file whose own header row is ignored (names are applied by position).
The data is read as strings and typed with ``try_cast`` so that missing-value
tokens and values such as ``"1.0"`` in an integer column behave like the
source loader; NaN readings become NULL.

For repeated analysis the typed table is written once as Parquet partitioned
by ``report_month``; the report filters then prune whole months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tirepulse.operators.common import MONTH_PARTITION
from tirepulse.sources.schema import DEVICE_SCHEMA, DEVICE_TABLE, SENSOR_SCHEMA, SENSOR_TABLE

# The tokens the source loader reads as missing (pandas defaults).
MISSING_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                  "nan", "null"]


def description_columns(spark: SparkSession, desc_path: str) -> list[str]:
    """Column names, in order, from a description file (a few dozen rows)."""
    desc = spark.read.option("sep", "|").option("header", True).csv(desc_path)
    # The description is metadata (one row per column), not data.
    return [r[0].strip() for r in desc.select("column_name").collect()]


def typed_column(raw: Column, dtype: T.DataType) -> Column:
    """A raw string column typed like the source loader: missing-value tokens
    become NULL, ``"1.0"`` is accepted for integers, NaN becomes NULL, and
    timestamps may be date-only or carry a time (space or ``T``)."""
    s = F.trim(raw)
    s = F.when(s.isin(MISSING_TOKENS), F.lit(None)).otherwise(s)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        name = dtype.simpleString()
        direct = s.try_cast(name)
        via_double = s.try_cast("double")
        whole = F.when(F.floor(via_double) == via_double, via_double.try_cast(name))
        return F.coalesce(direct, whole)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        v = s.try_cast(dtype.simpleString())
        return F.when(F.isnan(v), F.lit(None).cast(dtype)).otherwise(v)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return s.try_cast("timestamp_ntz")
    return s


# The whole line of a row whose number of fields is not the description's.
LINE = "_line"


def raw_schema(names: list[str]) -> T.StructType:
    """All columns as text, and the line itself where its fields are too few or too many."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, LINE]])


#: Reader options of a data file; its own header row is ignored.
CSV_OPTIONS = {"header": "true", "enforceSchema": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}


def raw_reports(spark: SparkSession, desc_path: str, data_path: str, quoted_newlines: bool = False) -> DataFrame:
    """The data file as text columns, plus ``_line`` for rows of another length.

    ``quoted_newlines``: a field in quotes may hold line feeds; such files are read whole, not in splits."""
    return (spark.read.schema(raw_schema(description_columns(spark, desc_path))).options(**CSV_OPTIONS)
            .option("multiLine", quoted_newlines).csv(data_path))


#: A quoted field: the quote opens a field; doubled or escaped quotes are part of it.
QUOTED = r'(^|,)\s*"(?:[^"\\]|\\.|"")*"'


def field_count(line: Column) -> Column:
    """Number of fields of a CSV line; separators inside quoted fields don't count."""
    return F.size(F.split(F.regexp_replace(line, QUOTED, "$1"), ","))


def malformed(raw: DataFrame, schema: T.StructType) -> Column:
    """Names of the columns whose text is neither missing nor of the declared
    type, and ``_line`` for a line with more fields than columns. (A short line
    is padded with NULL, as in the source loader.)"""
    types = {f.name: f.dataType for f in schema.fields}
    checks = [F.when(~F.trim(F.col(n)).isin(MISSING_TOKENS) & typed_column(F.col(n), types[n]).isNull()
                     & ~(F.lower(F.trim(F.col(n))) == "nan"), F.lit(n))
              for n in raw.columns if n in types]
    if LINE in raw.columns:
        checks.append(F.when(field_count(F.col(LINE)) > len(raw.columns) - 1, F.lit(LINE)))
    return F.array_compact(F.array(*checks))


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as their declared types; columns that ``schema`` lacks stay text."""
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[typed_column(F.col(n), types[n]).alias(n) if n in types else F.col(n)
                        for n in raw.columns if n != LINE])


def accepted(raw: DataFrame, schema: T.StructType, on_malformed: str = "fail") -> DataFrame:
    """Raw rows, of a batch or a stream, as typed reports.

    ``on_malformed``: a value that doesn't fit its column's type, or a line
    with too many fields, fails the job that reads it (``fail``, as the source
    loader does), drops the row (``skip``; see ``rejected``) or becomes NULL (``null``).
    """
    if on_malformed not in ("fail", "skip", "null"):
        raise ValueError(f"on_malformed: {on_malformed}")
    bad = malformed(raw, schema)
    if on_malformed == "skip":
        raw = raw.filter(F.size(bad) == 0)
    elif on_malformed == "fail":
        message = F.concat(F.lit("malformed report row, columns: "), F.array_join(bad, ", "))
        raw = raw.filter(F.when(F.size(bad) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    out = typed(raw, schema)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in out.columns]
    return out.select("*", *missing)


def rejected(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The raw rows that ``accepted`` skips or fails on, with the names of the
    malformed columns in ``bad_columns``."""
    return raw.withColumn("bad_columns", malformed(raw, schema)).filter(F.size("bad_columns") > 0)


def load_reports(spark: SparkSession, desc_path: str, data_path: str, schema: T.StructType,
                 on_malformed: str = "fail", quoted_newlines: bool = False) -> DataFrame:
    """Read one report table: names from the description file, types from ``schema``.

    Columns named in the description but absent from ``schema`` stay strings;
    schema columns missing from the file are added as NULL of their type. For
    ``on_malformed`` see ``accepted``.
    """
    return accepted(raw_reports(spark, desc_path, data_path, quoted_newlines), schema, on_malformed)


def rejected_reports(spark: SparkSession, desc_path: str, data_path: str, schema: T.StructType,
                     quoted_newlines: bool = False) -> DataFrame:
    """The raw rows that ``load_reports`` skips or fails on; count them for a reject count."""
    return rejected(raw_reports(spark, desc_path, data_path, quoted_newlines), schema)


def load_sensor_reports(spark: SparkSession, desc_path: str, data_path: str, on_malformed: str = "fail") -> DataFrame:
    return load_reports(spark, desc_path, data_path, SENSOR_SCHEMA, on_malformed)


def load_device_reports(spark: SparkSession, desc_path: str, data_path: str, on_malformed: str = "fail") -> DataFrame:
    return load_reports(spark, desc_path, data_path, DEVICE_SCHEMA, on_malformed)


def write_reports(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Persist a typed report table as Parquet partitioned by report month.

    Rows are range-partitioned and sorted by (report time, id) first, so each
    task writes one contiguous time slice (one or two month folders, not one
    file per month per task) and the Parquet min/max statistics of
    ``report_start_at`` are tight enough to skip row groups. ``id`` is part of
    the range key because daily reports share one timestamp per day, and a
    range partitioner cannot split a single key value.
    """
    (df.withColumn(MONTH_PARTITION, F.date_format("report_start_at", "yyyy-MM"))
       .repartitionByRange("report_start_at", "id")
       .sortWithinPartitions("report_start_at", "id")
       .write.mode(mode).partitionBy(MONTH_PARTITION).parquet(path))
    return path


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Stored reports; the feature functions take NaN readings as missing."""
    return spark.read.parquet(path)


def register_views(sensors: DataFrame, devices: DataFrame) -> None:
    """Expose both tables to ``spark.sql`` under the source's table names."""
    sensors.createOrReplaceTempView(SENSOR_TABLE)
    devices.createOrReplaceTempView(DEVICE_TABLE)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over the registered report views (lazy; nothing is collected)."""
    return spark.sql(sql)
