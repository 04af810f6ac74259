"""Deliveries merged into the stored report table: one row per report id, the latest ``updated_at``.

A report can be delivered again unchanged, corrected (a later ``updated_at``), or
late. ``merge_reports`` replaces the stored row of an id only by a later
one, and rewrites only the months that change:

1. The delivery is reduced to its latest row per id.
2. The stored rows of the delivered ids are looked up (id, month and time of
   update are all that is read of the table; the join is on the id). Rows that
   aren't later than what is stored are left out. If none remains, nothing is written.
3. The touched months are those of the remaining rows and of the rows that they
   replace, which a correction of the report's day may have in another month.
   Each is read, merged and written with dynamic partition overwrite; a month
   that a correction has emptied is deleted. All other months keep their files.

The merged months are written to the shared folder before they replace the
stored ones, so the table is never read while it is overwritten, and a merge
that failed before is simply run again: it changes nothing twice.

Rows without an id can't replace each other; equal ones count once. A missing
``updated_at`` is earlier than any other. Two versions of one id with the same
``updated_at`` are told apart by their other columns, in a fixed order, within a
delivery; against the stored row such a version changes nothing. One merge at a time is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tirepulse.operators.common import MONTH_PARTITION
from tirepulse.session import discard, exists, stored
from tirepulse.sources.ingest import write_reports

#: Spark's folder name of a missing partition value.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
_KEY = "_key"


@dataclass(frozen=True)
class Merged:
    """What a merge did: rows that are new or replace one, rows replaced, months rewritten."""
    changed: int
    replaced: int
    months: tuple[str | None, ...]


def month_of(ts: str = "report_start_at") -> Column:
    return F.date_format(ts, "yyyy-MM")


def _keyed(df: DataFrame) -> DataFrame:
    """The id as text; a row without one is its own key."""
    columns = [c for c in df.columns if c != MONTH_PARTITION]
    whole = F.concat(F.lit("row "), F.sha2(F.to_json(F.struct(*columns)), 256))
    return df.withColumn(_KEY, F.coalesce(F.col("id").cast("string"), whole))


def latest_versions(df: DataFrame) -> DataFrame:
    """One row per id: the latest ``updated_at`` (missing is earliest), then the largest other columns.

    A grouped maximum, combined before the shuffle: an id that was delivered very often costs no large task."""
    columns = df.columns
    rest = [c for c in columns if c not in ("updated_at", "id")]
    version = F.struct(F.col("updated_at"), F.col("id"), *rest)
    best = _keyed(df).groupBy(_KEY).agg(F.max(version).alias("_v"))
    return best.select(*[F.col("_v")[c].alias(c) for c in columns], _KEY)


def merge_reports(spark: SparkSession, delivered: DataFrame, path: str) -> Merged:
    """Merges typed reports into the month-partitioned table at ``path`` (made if it isn't there)."""
    columns = [c for c in delivered.columns if c != MONTH_PARTITION]
    fresh, fresh_path = stored(latest_versions(delivered.select(*columns)), "delivered-reports")
    if not exists(spark, path):
        write_reports(fresh.drop(_KEY), path)
        months = tuple(sorted((r[0] for r in fresh.select(month_of().alias("m")).distinct().collect()), key=str))
        n = fresh.count()
        discard(spark, fresh_path)
        return Merged(n, 0, months)

    table = spark.read.parquet(path)
    known = (_keyed_lookup(table)
             .join(fresh.select(_KEY), _KEY, "left_semi")
             .select(_KEY, F.col("updated_at").alias("_stored"), F.col(MONTH_PARTITION).alias("_month"), F.lit(True).alias("_known")))
    versus = fresh.join(known, _KEY, "left")
    later = F.col("_known").isNull() | (F.col("_stored").isNull() & F.col("updated_at").isNotNull()) | (F.col("updated_at") > F.col("_stored"))
    winners, winners_path = stored(versus.filter(later), "changed-reports")
    discard(spark, fresh_path)
    # at most one row a month of the calendar
    touched = sorted({m for r in winners.select(month_of().alias("to"), F.when(F.col("_known"), F.col("_month")).alias("of"),
                                                F.col("_known").isNotNull().alias("replaces")).distinct().collect()
                      for m in ([r.to, r.of] if r.replaces else [r.to])}, key=str)
    if not touched:
        discard(spark, winners_path)
        return Merged(0, 0, ())
    counts = winners.agg(F.count(F.lit(1)), F.count("_known")).first()
    in_touched = F.col(MONTH_PARTITION).isin([m for m in touched if m is not None])
    if None in touched:
        in_touched = F.coalesce(in_touched, F.lit(False)) | F.col(MONTH_PARTITION).isNull()
    stay = _keyed(table.filter(in_touched).select(*columns)).join(winners.select(_KEY), _KEY, "left_anti").select(*columns)
    merged, merged_path = stored(stay.unionByName(winners.select(*columns)), "merged-months")
    left = {r[0] for r in merged.select(month_of().alias("m")).distinct().collect()}
    _replace_months(merged, path)
    for month in touched:
        if month not in left:
            discard(spark, f"{path}/{MONTH_PARTITION}={month if month is not None else NO_MONTH}")
    for folder in (winners_path, merged_path):
        discard(spark, folder)
    return Merged(counts[0], counts[1], tuple(touched))


def _keyed_lookup(table: DataFrame) -> DataFrame:
    """Key, time of update and month of all stored rows: for named rows from these three columns alone."""
    named = (table.filter(F.col("id").isNotNull())
             .select(F.col("id").cast("string").alias(_KEY), "updated_at", MONTH_PARTITION))
    without = _keyed(table.filter(F.col("id").isNull())).select(_KEY, "updated_at", MONTH_PARTITION)
    return named.unionByName(without)


def _replace_months(merged: DataFrame, path: str) -> None:
    """Writes the months of ``merged`` in place of the stored ones, in the layout of ``write_reports``."""
    (merged.withColumn(MONTH_PARTITION, month_of())
     .repartitionByRange("report_start_at", "id").sortWithinPartitions("report_start_at", "id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_PARTITION).parquet(path))
