"""Per-sensor rolling windows (7-report frames and day-over-day lags).

The source computes, per sensor ordered by report date, moving AVG / STDDEV /
SUM / COUNT over ``ROWS BETWEEN 6 PRECEDING AND CURRENT ROW`` and LAG(1).
A plain ``Window.partitionBy(sensor_id)`` sends every report of a sensor to one
task, so a sensor (or a NULL / placeholder id) holding a large share of the
rows would run in a single task. ``rolling`` therefore counts rows per key
(pre-aggregated, one job); keys above ``hot_key_rows`` are *hot*.

* Rows of other keys (all rows, if there is no hot key) take the plain window:
  one shuffle, nothing materialised.
* Rows of hot keys are range-partitioned by the window order itself, (key, date,
  id, inputs) with NULLs last, into blocks of about ``block_rows`` rows. The
  splitters are sampled, so gaps and outliers in the ids don't matter. Frames,
  lags and positions are computed per block and stored once; the first rows of
  each block are computed again together with the rows that precede the block,
  which are among the last rows of the previous blocks.

Ties on the date are broken by ``id`` (the source orders by date only, which is
nondeterministic when a sensor has two reports on one day), and ties on both by
the input values, so both ways give the same rows also for repeated ids.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tirepulse.session import ensure_checkpoint_dir

# A window partition up to this many rows runs comfortably in one task.
DEFAULT_HOT_KEY_ROWS = 2_000_000
# Rows per block when a hot key is split.
DEFAULT_BLOCK_ROWS = 500_000
# Hot-key lists up to this size are broadcast; there are at most
# total rows / hot_key_rows of them. A longer list is joined by shuffle.
MAX_BROADCAST_HOT_KEYS = 100_000

_AGGS = {
    "avg": F.avg,
    "stddev": F.stddev_samp,
    "sum": F.sum,
    "count": lambda c: F.count(F.lit(1)) if c is None else F.count(c),
}


@dataclass
class RollingSpec:
    """What to compute over each frame: ``aggs[name] = (kind, column)`` with kind in
    avg/stddev/sum/count, and ``lags[name] = column`` (previous report's value)."""
    aggs: dict[str, tuple[str, Column | str | None]] = field(default_factory=dict)
    lags: dict[str, Column | str] = field(default_factory=dict)
    rows: int = 7


def _named_inputs(df: DataFrame, spec: RollingSpec) -> tuple[DataFrame, RollingSpec, list[str]]:
    """``df`` with an added column for every input given as an expression, and the spec by names."""
    added: dict[str, Column] = {}

    def name(c):
        if c is None or isinstance(c, str):
            return c
        added[f"_in{len(added)}"] = c
        return f"_in{len(added) - 1}"

    named = RollingSpec({k: (kind, name(c)) for k, (kind, c) in spec.aggs.items()},
                        {k: name(c) for k, c in spec.lags.items()}, spec.rows)
    inputs = [c for _, c in named.aggs.values() if c is not None] + list(named.lags.values())
    return df.withColumns(added) if added else df, named, list(dict.fromkeys(inputs))


def _order(date_col: str, tie: str, inputs: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in dict.fromkeys([date_col, tie, *inputs])]


def _window_cols(spec: RollingSpec, part: list[str], order: list[Column]):
    w = Window.partitionBy(*part).orderBy(*order)
    frame = w.rowsBetween(-(spec.rows - 1), 0)
    cols = [_AGGS[kind](None if c is None else F.col(c)).over(frame).alias(name)
            for name, (kind, c) in spec.aggs.items()]
    cols += [F.lag(c, 1).over(w).alias(name) for name, c in spec.lags.items()]
    return w, cols


def hot_keys(df: DataFrame, key: str, hot_key_rows: int) -> DataFrame:
    """Keys with more than ``hot_key_rows`` rows and their row counts."""
    return (df.groupBy(F.col(key).alias("_hk")).agg(F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > hot_key_rows))


def rolling(df: DataFrame, spec: RollingSpec, key: str = "sensor_id",
            date_col: str = "report_date", tie: str = "id",
            hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
            block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """``df`` plus one column per entry of ``spec`` (see module doc).

    ``hot_key_rows=None`` skips the measurement and runs the plain window;
    a small ``hot_key_rows`` / ``block_rows`` forces the split (tests).
    """
    out_cols = df.columns + list(spec.aggs) + list(spec.lags)
    rows, spec, inputs = _named_inputs(df, spec)
    order = _order(date_col, tie, inputs)

    def plain(part: DataFrame) -> DataFrame:
        _, cols = _window_cols(spec, [key], order)
        return part.select("*", *cols).select(*out_cols)

    if hot_key_rows is None:
        return plain(rows)
    hot = hot_keys(rows, key, hot_key_rows)
    n_keys, n_rows = hot.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if not n_keys:
        return plain(rows)
    hot_side = F.broadcast(hot.select("_hk")) if n_keys <= MAX_BROADCAST_HOT_KEYS else hot.select("_hk")
    same = rows[key].eqNullSafe(F.col("_hk"))
    cold = plain(rows.join(hot_side, same, "left_anti"))
    blocks = max(1, -(-n_rows // block_rows))
    split = _split_rolling(rows.join(hot_side, same, "left_semi"), spec, key, date_col, tie,
                           order, out_cols, inputs, blocks)
    return cold.unionByName(split)


def hot_blocks(hot_rows: DataFrame, key: str, order: list[Column], blocks: int) -> DataFrame:
    """``hot_rows`` with ``_blk``, the number of a block in the window order."""
    return (hot_rows.repartitionByRange(blocks, F.col(key).asc_nulls_last(), *order)
            .withColumn("_blk", F.spark_partition_id()))


def _split_rolling(hot_rows, spec, key, date_col, tie, order, out_cols, inputs, blocks):
    context = max(spec.rows - 1, 1 if spec.lags else 0)     # rows that a row looks back at
    in_cols = hot_rows.columns
    part = [key, "_blk"]
    w, cols = _window_cols(spec, part, order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Only the hot rows are stored, once (in the shared folder named by
    # spark.checkpoint.dir): four branches read them.
    ensure_checkpoint_dir(hot_rows.sparkSession)
    p1 = hot_blocks(hot_rows, key, order, blocks).select(
        "*", *cols, F.row_number().over(w).alias("_pos"),
        F.count(F.lit(1)).over(whole).alias("_n")).checkpoint(eager=True)

    # Rows whose frame and lag lie inside their block are final.
    done = p1.filter(F.col("_pos") > context).select(*out_cols)
    if not context:
        return done

    # The last `context` rows before each block, from the tails of the
    # previous `context` blocks of the same key.
    narrow = list(dict.fromkeys([key, date_col, tie, *inputs]))
    tails = p1.filter(F.col("_n") - F.col("_pos") < context).select(*narrow, "_blk")
    wb = Window.partitionBy(key).orderBy("_blk")
    prev = (p1.filter(F.col("_pos") == 1).select(key, "_blk")
            .select(F.col(key).alias("_key"), F.col("_blk").alias("_target"),
                    F.array(*[F.lag("_blk", i).over(wb) for i in range(1, context + 1)]).alias("_srcs"))
            .select("_key", "_target", F.explode("_srcs").alias("_src"))
            .filter(F.col("_src").isNotNull()))
    ctx = (tails.join(prev, tails[key].eqNullSafe(prev["_key"]) & (F.col("_blk") == F.col("_src")))
           .select(*narrow, F.col("_target").alias("_to"), F.col("_blk").alias("_from")))
    newest = Window.partitionBy(key, "_to").orderBy(
        F.col("_from").desc(), *[F.col(c).desc_nulls_first() for c in dict.fromkeys([date_col, tie, *inputs])])
    ctx = (ctx.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= context)
           .select(*narrow, F.col("_to").alias("_blk")).withColumn("_ctx", F.lit(True)))

    heads = p1.filter(F.col("_pos") <= context).select(*in_cols, "_blk").withColumn("_ctx", F.lit(False))
    # context rows come first: they precede the block in the window order
    _, cols2 = _window_cols(spec, part, [F.col("_ctx").desc(), *order])
    fixed = heads.unionByName(ctx, allowMissingColumns=True).select("*", *cols2).filter(~F.col("_ctx"))
    return done.unionByName(fixed.select(*out_cols))
