"""Connected components of an edge list by alternating large-star and
small-star steps (Kiveris et al., 2014), every round cut by ``checkpoint()``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tirepulse.session import ensure_checkpoint_dir


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges (one row)."""
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def component_roots(edges: DataFrame) -> DataFrame:
    """(u, v) rows, v the smallest node of u's component, for each node u but the roots.

    ``edges`` has two columns of one comparable type, read as undirected; null
    ends and loops are ignored. A hub with very many neighbours costs no large
    task: its minimum is pre-aggregated and AQE splits its side of the join.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a) != F.col(b)).alias("_two"))
    current = pairs.filter("_two").select("u", "v").distinct().checkpoint()
    before = _state(current)
    while before[0]:
        both = current.union(current.select("v", "u"))
        nearest = both.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
        large = (both.filter("v > u").join(nearest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        current = small.checkpoint()
        after = _state(current)
        if after == before:
            break
        before = after
    return current
