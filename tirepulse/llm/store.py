"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tirepulse.session import discard, discard_at_exit, stored

_MADE: ContextVar[list[str] | None] = ContextVar("tables made", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Lineage ends there: a lost executor costs a re-read, not a recomputation.
    The table is deleted when the driver's process ends, as results may read it
    until then; ``recorded`` tells a caller that needs it no longer where it is.
    """
    out, path = stored(df, name)
    discard_at_exit(df.sparkSession, path)
    if (made := _MADE.get()) is not None:
        made.append(path)
    return out


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the tables that ``written`` makes inside the block, in their order."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)


def discard_all(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that ``written`` made and nothing reads any more."""
    for path in paths:
        discard(spark, path)
