"""Bucketed report tables: the shuffle of windows and joins is done once, when the table is written.

Every window of the reports is per sensor, and the hub join per vehicle. A table
bucketed by that key is read already parted by it, so Spark plans no exchange
below the window, or the grouped counts and the join. The writer deals rows to
buckets with a rebalancing shuffle, which splits a bucket that a hot key fills
over several tasks (and files); readers of such a bucket are one task, as any
window over one key is, unless ``windows.rolling`` splits the key.

The table is registered in the session's catalog with its files under ``path``;
a cluster with a metastore keeps the entry, other sessions register it again
(``register_bucketed``). Joins on (vehicle, day) of two tables bucketed by vehicle
need ``spark.sql.requireAllClusterKeysForCoPartition=false``, which is left to the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Writes typed reports bucketed by ``key`` and sorted by (key, report time, id); returns the table."""
    order = [key, "report_start_at", "id"]
    (df.hint("rebalance", buckets, key).sortWithinPartitions(*order)
     .write.mode("overwrite").bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)


def register_bucketed(spark: SparkSession, df_schema, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Registers the files of ``write_bucketed`` in a session whose catalog doesn't know the table."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}' "
              f"CLUSTERED BY ({key}) SORTED BY ({key}, report_start_at, id) INTO {buckets} BUCKETS")
    return spark.table(table)
