"""Isolation forest (Liu, Ting & Zhou 2008) as a Spark job.

Spark ML has no isolation forest, so the estimator the source calls in
process is re-aimed as three distributed steps:

1. **Sampling**: the MD5 of its id gives each row a 60-bit number and a slot. The
   pool is the rows with the smallest numbers, about ``pool_factor * trees *
   sample`` of them; a pool row is offered to a few trees from its slot on (to all
   of them in a small table), and each tree takes the ``sample`` offered rows
   that come first by the MD5 of (seed, tree, id). The draw depends on the ids
   alone, is the same for any partitioning and any engine, and needs them to
   be unique, which is checked.
2. **Growth**: ``groupBy(tree).applyInPandas`` — each group holds at most
   ``sample`` rows (256); at each node the MD5 of (seed, tree, node, feature)
   picks a non-constant feature and the place of the split between its min
   and max; height limit ceil(log2(sample)). Nodes are numbered as in a heap
   (children of k: 2k + 1 and 2k + 2). No random stream is involved, so any engine
   that has MD5 grows the same trees; the oracle does it in SQL.
   The node table is bounded by ``trees * (2**(height+1) - 1)`` rows, which is
   what gets collected and broadcast.
3. **Scoring**: a vectorised function over the feature columns alone walks all
   trees for a whole Arrow batch; score ``s = -2**(-E[h(x)] / c(sample))``
   (lower = more anomalous), rounded to 12 decimals so that rows with the same
   paths tie whatever the order of summation. The other columns never leave the JVM.

The contamination threshold is the exact ``contamination`` quantile of the
scores (linear interpolation), found by repeated histogram narrowing: every
pass is a grouped count over at most ``bins`` bins, and only the final bin
(at most ``bins`` values) reaches the driver.

``pool_factor`` and ``sample`` bound the rows that trees grow from (the
published algorithm); every row is scored. Scores are not bitwise equal to any
particular library (different random streams); the procedure and the score
definition are the published ones.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tirepulse.session import discard, discard_at_exit, stored

# The tree growth and scoring functions run in Python workers, which need not
# have this package installed (a driver started from another folder, or a
# cluster without --py-files). Ship this module's functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329
NODE_SCHEMA = ("t int, node int, feature int, threshold double, left int, right int, "
               "size int, depth int")


def average_path_length(n: np.ndarray | int) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def split_hash(seed: int, t: int, node: int, feature: int) -> str:
    """Hex digits that decide a split: the least of a node's features is taken, digits
    17 to 29 (52 bits) are the place of the split between its min and max."""
    return hashlib.md5(f"{seed}:{t}:{node}:{feature}".encode()).hexdigest()


def _grow_tree(t: int, X: np.ndarray, seed: int, max_depth: int) -> list[tuple]:
    rows = []
    stack = [(0, np.arange(len(X)), 0)]
    while stack:
        node, idx, depth = stack.pop()
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(hi > lo)
        if depth >= max_depth or candidates.size == 0:
            rows.append((t, node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        digits, f = min((split_hash(seed, t, node, f), f) for f in candidates.tolist())
        thr = lo[f] + int(digits[16:29], 16) / 2.0 ** 52 * (hi[f] - lo[f])
        if thr >= hi[f]:
            thr = lo[f]
        go_left = sub[:, f] <= thr
        rows.append((t, node, f, float(thr), 2 * node + 1, 2 * node + 2, len(idx), depth))
        stack.append((2 * node + 2, idx[~go_left], depth + 1))
        stack.append((2 * node + 1, idx[go_left], depth + 1))
    return rows


def _pack(nodes: pd.DataFrame, trees: int):
    """Per-tree arrays for branch-free traversal.

    Children are numbered consecutively (right = left + 1), so one step is
    ``node = left[node] + (x[feature[node]] > threshold[node])``. A leaf points
    to itself with an infinite threshold, so every row can take the same number
    of steps (the height limit). ``path`` holds depth + c(leaf size) at leaves.
    """
    packed = []
    for t in range(trees):
        nd = nodes[nodes.t == t]
        size = int(nd.node.max()) + 1
        pos = nd.node.to_numpy()
        leaf = nd.left.to_numpy() < 0
        feat = np.zeros(size, dtype=np.int64)
        thr = np.full(size, np.inf)
        left = np.arange(size, dtype=np.int64)
        path = np.zeros(size)
        feat[pos[~leaf]] = nd.feature.to_numpy()[~leaf]
        thr[pos[~leaf]] = nd.threshold.to_numpy()[~leaf]
        left[pos[~leaf]] = nd.left.to_numpy()[~leaf]
        path[pos] = nd.depth.to_numpy() + average_path_length(nd["size"].to_numpy())
        packed.append((feat, thr, left, path, int(nd.depth.max())))
    return packed


def _mean_path(X: np.ndarray, packed) -> np.ndarray:
    total = np.zeros(len(X))
    rows = np.arange(len(X))
    for feat, thr, left, path, height in packed:
        node = np.zeros(len(X), dtype=np.int64)
        for _ in range(height):
            node = left[node] + (X[rows, feat[node]] > thr[node])
        total += path[node]
    return total / len(packed)


DRAW_BITS = 60


def _hex_number(text: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(text, start, digits), 16, 10).cast("long")


def turns_of(n: int, trees: int, sample: int, pool_factor: int) -> int:
    """How many trees a pool row is offered to: each tree is offered 4 * pool_factor times its sample."""
    return min(trees, max(4, -(-4 * pool_factor * min(sample, n) * trees // max(1, n))))


def draw_samples(df: DataFrame, id_col: str, n: int, trees: int = 100, sample: int = 256, seed: int = 42,
                 pool_factor: int = 4) -> DataFrame:
    """``df`` rows drawn for each tree (column ``t``): ``min(sample, n)`` of those offered to it."""
    psi = min(sample, n)
    share = min(1.0, pool_factor * trees * psi / max(1, n))
    text = F.col(id_col).cast("string")
    digits = F.md5(text.cast("binary"))
    pool = (df.withColumn("_m", digits)
            .filter(_hex_number(F.col("_m"), 1, DRAW_BITS // 4) < F.lit(share * (1 << DRAW_BITS))))
    first = _hex_number(F.col("_m"), 17, 8)
    turns = F.sequence(F.lit(0), F.lit(turns_of(n, trees, sample, pool_factor) - 1))
    # explode (inside whole-stage codegen) rather than a higher-order filter,
    # which is interpreted per element
    offered = (pool.withColumn("_k", F.explode(turns))
               .withColumn("t", F.pmod(first + F.col("_k"), F.lit(trees)).cast("int")))
    rank = F.md5(F.concat(F.lit(f"{seed}:"), F.col("t").cast("string"), F.lit(":"), text).cast("binary"))
    order = Window.partitionBy("t").orderBy("_p", id_col)
    return (offered.withColumn("_p", rank).withColumn("_r", F.row_number().over(order))
            .filter(F.col("_r") <= psi).drop("_r", "_p", "_m", "_k"))


def require_unique(df: DataFrame, id_col: str) -> int:
    """Number of rows; an error if an id is NULL or occurs twice."""
    n, known, distinct = df.agg(F.count(F.lit(1)), F.count(id_col), F.count_distinct(id_col)).first()
    if known < n or distinct < n:
        raise ValueError(f"{id_col} must be unique and not NULL: {n} rows, {distinct} ids")
    return n


def grow_forest(df: DataFrame, id_col: str, features: list[str], trees: int = 100,
                sample: int = 256, seed: int = 42, pool_factor: int = 4,
                n_rows: int | None = None) -> tuple[pd.DataFrame, int]:
    """Sample and grow the trees; returns (node table, per-tree sample size)."""
    n = n_rows if n_rows is not None else require_unique(df, id_col)
    psi = min(sample, n)
    if psi < 1:
        raise ValueError("isolation forest needs at least one row")
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    base = df.select(F.col(id_col).alias("_id"), *[F.col(c).cast("double").alias(c) for c in features])
    growth_tasks = max(1, min(trees, df.sparkSession.sparkContext.defaultParallelism))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(key[0])
        pdf = pdf.sort_values("_id")
        X = pdf[features].to_numpy(dtype=float)
        return pd.DataFrame(_grow_tree(t, X, seed, max_depth),
                            columns=["t", "node", "feature", "threshold", "left", "right", "size", "depth"])

    # At most `trees` groups of `psi` rows: spread them over explicit
    # partitions (AQE would coalesce this small input into one Python task).
    sampled = draw_samples(base, "_id", n, trees, sample, seed, pool_factor).repartition(growth_tasks, "t")
    nodes = sampled.groupBy("t").applyInPandas(grow, NODE_SCHEMA).toPandas()
    # the model that gets broadcast: bounded by trees x full binary tree of the height limit
    assert len(nodes) <= trees * (2 ** (max_depth + 1) - 1), "node table exceeds its bound"
    if nodes.t.nunique() != trees:
        raise ValueError("a tree drew no row; raise pool_factor")
    return nodes, psi


SCORE_DECIMALS = 12


def score_frame(df: DataFrame, features: list[str], nodes: pd.DataFrame, psi: int,
                trees: int, score_col: str = "ml_raw_score") -> DataFrame:
    """Append ``-2**(-E[h]/c(psi))`` for every row. Only the features go to Python."""
    packed = df.sparkSession.sparkContext.broadcast(_pack(nodes, trees))
    c_psi = float(average_path_length(np.array([psi]))[0]) or 1.0

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        X = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(np.round(-np.power(2.0, -_mean_path(X, packed.value) / c_psi), SCORE_DECIMALS))

    return df.withColumn(score_col, score(*[F.col(c).cast("double") for c in features]))


QUANTILE_BINS = 4096


def kth_smallest(df: DataFrame, col: str, ks: int | list[int], bins: int = QUANTILE_BINS,
                 bounds: tuple[float, float] | None = None):
    """Exact k-th smallest values (0-based ranks) by histogram narrowing.

    Each pass is one grouped count over at most ``bins`` bins of the current
    value range; only the final bin (at most ``bins`` values) reaches the
    driver. All requested ranks are resolved in the same passes.
    """
    single = isinstance(ks, int)
    pending = {k: None for k in ([ks] if single else ks)}
    c = F.col(col)
    lo, hi = bounds if bounds is not None else df.agg(F.min(c), F.max(c)).first()
    ranges = {k: (lo, hi, 0) for k in pending}
    while any(v is None for v in pending.values()):
        todo = sorted({ranges[k] for k, v in pending.items() if v is None})
        lo, hi, before = todo[0]
        ks_here = [k for k, v in pending.items() if v is None and ranges[k] == (lo, hi, before)]
        if lo == hi:
            for k in ks_here:
                pending[k] = float(lo)
            continue
        sub = df.filter((c >= lo) & (c <= hi))
        b = F.least(F.floor((c - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")
        hist = sorted(sub.groupBy(b.alias("b"))
                      .agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("mn"), F.max(c).alias("mx"))
                      .collect())
        for k in ks_here:
            seen = before
            for row in hist:
                if k - seen < row.n:
                    break
                seen += row.n
            if row.n <= bins:
                vals = sorted(r[0] for r in sub.filter((c >= row.mn) & (c <= row.mx)).select(c).collect())
                pending[k] = float(vals[k - seen])
            else:
                ranges[k] = (row.mn, row.mx, seen)
    return pending[ks] if single else [pending[k] for k in ks]


SCORE_BOUNDS = (-1.0, 0.0)  # -2**(-x) for x >= 0


def quantile_exact(df: DataFrame, col: str, q: float, n: int,
                   bounds: tuple[float, float] | None = None) -> float:
    """Linear-interpolated quantile (numpy's default method) of ``col`` over n rows."""
    pos = q * (n - 1)
    k0 = int(math.floor(pos))
    frac = pos - k0
    if frac == 0 or k0 + 1 >= n:
        return kth_smallest(df, col, k0, bounds=bounds)
    v0, v1 = kth_smallest(df, col, [k0, k0 + 1], bounds=bounds)
    return v0 + (v1 - v0) * frac


def isolation_forest(df: DataFrame, id_col: str, features: list[str], trees: int = 100,
                     sample: int = 256, contamination: float = 0.04, seed: int = 42,
                     keep: list[str] | None = None, materialize: bool = True,
                     n_rows: int | None = None) -> DataFrame:
    """``keep`` columns plus ``ml_anomaly_score`` (score minus the contamination
    threshold; negative = outlier) and ``ml_anomaly_pred`` (-1 outlier, 1 inlier).

    ``id_col`` must be unique. Inputs (``materialize``) and scores are written as
    Parquet in the shared checkpoint folder, so the passes over them read the
    columns they need and survive lost executors. The inputs are deleted before
    the function returns, the scores when the driver ends.
    """
    spark = df.sparkSession
    keep = list(dict.fromkeys((keep or [id_col]) + [id_col]))
    narrow, inputs = df.select(*dict.fromkeys(keep + features)), None
    if materialize:  # skip when the caller already reads stored rows
        narrow, inputs = stored(narrow, "forest-inputs")
    n = n_rows if n_rows is not None else require_unique(narrow, id_col)
    nodes, psi = grow_forest(narrow, id_col, features, trees, sample, seed, n_rows=n)
    scored, path = stored(score_frame(narrow, features, nodes, psi, trees).select(*keep, "ml_raw_score"), "forest-scores")
    discard_at_exit(spark, path)
    if inputs:
        discard(spark, inputs)
    offset = quantile_exact(scored, "ml_raw_score", contamination, n, bounds=SCORE_BOUNDS)
    return verdicts(scored, offset, keep)


def verdicts(scored: DataFrame, offset: float, keep: list[str]) -> DataFrame:
    """Score relative to the threshold, and -1 (outlier) below it, else 1."""
    score = F.col("ml_raw_score") - F.lit(offset)
    return scored.select(*keep, score.alias("ml_anomaly_score"),
                         F.when(score < 0, F.lit(-1)).otherwise(F.lit(1)).alias("ml_anomaly_pred"))
