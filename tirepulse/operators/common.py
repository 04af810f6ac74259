"""Report-range filters and date keys shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TS = "report_start_at"
# Optional partition column written by ``sources.ingest.write_reports``.
MONTH_PARTITION = "report_month"


def _ts_literal(df: DataFrame, value) -> Column:
    """A bound (text, date or datetime) as a literal of the timestamp column's type."""
    return F.lit(value).cast(df.schema[TS].dataType)


def _month(bound: Column) -> Column:
    """The month partition that holds a bound (folded to a constant, so folders are pruned)."""
    return F.date_format(bound, "yyyy-MM")


def report_window(df: DataFrame, start, end) -> DataFrame:
    """Closed range ``start <= report_start_at <= end`` (SQL ``BETWEEN``).

    Bounds are typed literals, so the predicate reaches the Parquet scan.
    A date-only ``end`` means midnight of that day, as in the source reports
    (a later report on the last day is outside the range). When the table is
    stored partitioned by ``report_month`` the same range is also applied to
    the partition column, so whole months are pruned before any file is read.
    """
    if start is None and end is None:
        return df
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(TS) >= _ts_literal(df, start))
    if end is not None:
        cond = cond & (F.col(TS) <= _ts_literal(df, end))
    if MONTH_PARTITION in df.columns:
        if start is not None:
            cond = cond & (F.col(MONTH_PARTITION) >= _month(_ts_literal(df, start)))
        if end is not None:
            cond = cond & (F.col(MONTH_PARTITION) <= _month(_ts_literal(df, end)))
    return df.filter(cond)


def half_open_window(df: DataFrame, start, end) -> DataFrame:
    """``start <= report_start_at < end`` (the exploration queries' range)."""
    cond = (F.col(TS) >= _ts_literal(df, start)) & (F.col(TS) < _ts_literal(df, end))
    if MONTH_PARTITION in df.columns:
        cond = cond & (F.col(MONTH_PARTITION) >= _month(_ts_literal(df, start))) & (F.col(MONTH_PARTITION) <= _month(_ts_literal(df, end)))
    return df.filter(cond)


def report_date(c: str = TS) -> Column:
    return F.to_date(F.col(c))
