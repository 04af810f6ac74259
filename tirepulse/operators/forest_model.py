"""Stored isolation forests: fitting and scoring as two jobs.

``fit_forest`` grows a forest on one set of reports and keeps all that scoring
needs: the node table, the inputs' means and deviations, and the contamination
threshold of the training scores. ``save_forest`` appends it as the next version
of a model table; ``load_forest`` reads a version back (the latest by default)
and ``score_with`` applies it to any later reports in one pass, without a
training row in sight.

A model table is two Parquet tables below one folder: ``nodes``, partitioned by
version, and ``versions``, one row a version. The row of a version is written
after its nodes, so a save that failed half-way left no version. Versions are
never changed; one writer at a time is assumed.

What reaches the driver is one row of statistics and the node table, which is
bounded by trees * (2**(height + 1) - 1) rows whatever the size of the reports.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tirepulse.operators import forest
from tirepulse.session import discard, exists, stored

VERSIONS_SCHEMA = ("version int, features array<string>, means array<double>, deviations array<double>, psi int, trees int, "
                   "seed long, contamination double, threshold double, rows long, trained_on string")


@dataclass(frozen=True)
class ForestModel:
    features: list[str]
    means: list[float]
    deviations: list[float]
    nodes: pd.DataFrame
    psi: int
    trees: int
    seed: int
    contamination: float
    threshold: float
    rows: int
    trained_on: str = ""
    version: int | None = None


def _inputs(features: list[str]) -> list[Column]:
    """Model inputs as doubles; a missing one counts as 0, as in the source."""
    missing = lambda c: c.isNull() | F.isnan(c)
    return [F.when(missing(F.col(c).cast("double")), 0.0).otherwise(F.col(c).cast("double")).alias(c) for c in features]


def _scaled(df: DataFrame, model_features: list[str], means: list[float], deviations: list[float]) -> tuple[DataFrame, list[str]]:
    names = [f"_x{k}" for k in range(len(model_features))]
    values = {n: (c - F.lit(m)) / F.lit(s or 1.0) for n, c, m, s in zip(names, _inputs(model_features), means, deviations)}
    return df.withColumns(values), names


def fit_forest(df: DataFrame, id_col: str, features: list[str], trees: int = 100, sample: int = 256,
               contamination: float = 0.04, seed: int = 42, trained_on: str = "") -> ForestModel:
    """A forest grown on ``df`` (ids unique and not NULL), with its scaling and threshold."""
    spark = df.sparkSession
    rows, path = stored(df.select(F.col(id_col).alias("_id"), *_inputs(features)), "forest-training")
    n = forest.require_unique(rows, "_id")
    fit = rows.agg(*[F.avg(c) for c in features], *[F.stddev_pop(c) for c in features]).first()
    means, deviations = [v or 0.0 for v in fit[:len(features)]], [v or 0.0 for v in fit[len(features):]]
    scaled, names = _scaled(rows, features, means, deviations)
    nodes, psi = forest.grow_forest(scaled, "_id", names, trees, sample, seed, n_rows=n)
    scores, scores_path = stored(forest.score_frame(scaled, names, nodes, psi, trees).select("ml_raw_score"), "forest-training-scores")
    threshold = forest.quantile_exact(scores, "ml_raw_score", contamination, n, bounds=forest.SCORE_BOUNDS)
    discard(spark, path)
    discard(spark, scores_path)
    return ForestModel(list(features), means, deviations, nodes, psi, trees, seed, contamination, threshold, n, trained_on)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored version; empty where nothing is stored yet."""
    return spark.read.schema(VERSIONS_SCHEMA).parquet(f"{path}/versions") if exists(spark, f"{path}/versions") \
        else spark.createDataFrame([], VERSIONS_SCHEMA)


def save_forest(spark: SparkSession, model: ForestModel, path: str) -> int:
    """Appends ``model`` to the model table at ``path``; returns its version (1, 2, ...)."""
    version = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    # a save that failed may have left nodes of this version: they are replaced
    spark.createDataFrame(model.nodes, forest.NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes/version={version}")
    row = (version, model.features, model.means, model.deviations, model.psi, model.trees, model.seed,
           model.contamination, model.threshold, model.rows, model.trained_on)
    spark.createDataFrame([row], VERSIONS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def load_forest(spark: SparkSession, path: str, version: int | None = None) -> ForestModel:
    """A stored version, the latest one by default."""
    known = versions(spark, path)
    row = (known if version is None else known.filter(F.col("version") == version)).orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no stored forest at {path}" + ("" if version is None else f" with version {version}"))
    nodes = spark.read.schema(forest.NODE_SCHEMA).parquet(f"{path}/nodes/version={row.version}").toPandas()
    return ForestModel(list(row.features), list(row.means), list(row.deviations), nodes, row.psi, row.trees, row.seed,
                       row.contamination, row.threshold, row.rows, row.trained_on, row.version)


def score_with(df: DataFrame, model: ForestModel, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``ml_anomaly_score`` and ``ml_anomaly_pred`` by a fitted forest; one pass, no shuffle."""
    scaled, names = _scaled(df, model.features, model.means, model.deviations)
    return forest.verdicts(forest.score_frame(scaled, names, model.nodes, model.psi, model.trees), model.threshold, keep)
