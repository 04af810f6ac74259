"""Report sinks: each output is written by the executors in parallel.

CSV (header row, as the dashboards consume) or Parquet. Ordering is applied
only here, at the sink, as a range-partitioned sort; pipelines stay unsorted.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def export(df: DataFrame, path: str, fmt: str = "csv", order: list[Column | str] | None = None,
           mode: str = "overwrite") -> str:
    """Write ``df`` to the folder ``path`` (one part file per task)."""
    export_counted(df, path, fmt, order, mode)
    return path


def export_counted(df: DataFrame, path: str, fmt: str = "csv", order: list[Column | str] | None = None,
                   mode: str = "overwrite") -> int:
    """``export``, returning the number of rows, counted while they are written."""
    if order:
        df = df.orderBy(*order)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")
    rows = seen.get["rows"]
    log.info("%s: %d rows", path, rows)
    return rows
