"""Rolling windows over new reports only, with the state of earlier runs.

A frame of 7 reports and a lag look back 6 reports at most, so the last 6
reports of each sensor are all that a later run needs of the past. ``advance``
puts this state before the new rows, computes the windows over both and
returns the new rows' results and the next state: a daily run reads one day and
the state, not the history of the range.

Late rows (not after the last day that the state has of their sensor) change
the frames of rows that earlier runs returned. Only their sensors are computed
again, from the history, and all their rows from the first late day on are
returned again; a later run's result of a row replaces an earlier one
(``latest_results``). The same holds for repeated rows. NULL is a sensor like
any other.

``run_windows`` keeps results and states of all runs in a folder:
``results/run=N`` and ``state/run=N`` are written first, the row in ``runs``
last, so a run that failed half-way is simply run again. One run at a time.

Scale: the state has at most 6 narrow rows a sensor; it is found by a row number
over each sensor with a limit, which Spark applies before the shuffle too, so a
sensor that holds a third of all rows sends 6 rows a task. The windows
themselves go through ``windows.rolling``, which splits hot sensors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tirepulse.operators.windows import RollingSpec, rolling
from tirepulse.session import discard, exists, stored

_OLD, _FROM = "_old", "_from"


def lookback(spec: RollingSpec) -> int:
    """How many earlier rows a row's frames and lags look at."""
    return max(spec.rows - 1, 1 if spec.lags else 0)


def _inputs(spec: RollingSpec) -> list[str]:
    named = [c for _, c in spec.aggs.values() if c is not None] + list(spec.lags.values())
    if not all(isinstance(c, str) for c in named):
        raise ValueError("windows with a state take named columns")
    return list(dict.fromkeys(named))


def state_columns(spec: RollingSpec, key: str = "sensor_id", date_col: str = "report_date", tie: str = "id") -> list[str]:
    """Columns that the state keeps of a row: what orders it and what frames and lags read."""
    return list(dict.fromkeys([key, date_col, tie, *_inputs(spec)]))


def last_rows(rows: DataFrame, spec: RollingSpec, key: str = "sensor_id", date_col: str = "report_date",
              tie: str = "id") -> DataFrame:
    """The last rows of each sensor in window order, as many as a later row looks back."""
    columns = state_columns(spec, key, date_col, tie)
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_first() for c in columns if c != key])
    return (rows.select(*columns).withColumn("_place", F.row_number().over(newest))
            .filter(F.col("_place") <= lookback(spec)).drop("_place"))


def late_keys(new: DataFrame, state: DataFrame, key: str = "sensor_id", date_col: str = "report_date") -> DataFrame:
    """Sensors with new rows that aren't after all rows of the state, and the first day of such rows."""
    last = state.groupBy(F.col(key).alias("_key")).agg(F.max(date_col).alias("_last"))
    return (new.select(key, date_col).join(last, F.col(key).eqNullSafe(F.col("_key")))
            .filter(F.col(date_col) <= F.col("_last"))
            .groupBy("_key").agg(F.min(date_col).alias(_FROM)))


def advance(new: DataFrame, state: DataFrame, history: DataFrame, spec: RollingSpec, key: str = "sensor_id",
            date_col: str = "report_date", tie: str = "id", **split) -> tuple[DataFrame, DataFrame]:
    """(results, next state) of one run.

    ``new`` has the rows that no run has seen, ``state`` the state after the runs
    before, ``history`` all rows of those runs with the columns of ``new`` (read
    only for sensors with late rows). ``split`` goes to ``windows.rolling``.
    """
    columns = new.columns
    late, path = stored(late_keys(new, state, key, date_col), "late-sensors")
    none_late = late.isEmpty()
    of_late = lambda df, how: df.join(late.select("_key"), df[key].eqNullSafe(F.col("_key")), how)
    past = state.withColumn(_OLD, F.lit(True))
    present = new.withColumn(_OLD, F.lit(False))
    if not none_late:
        past, present = of_late(past, "left_anti"), of_late(present, "left_anti")
    both = present.unionByName(past, allowMissingColumns=True)
    results = rolling(both, spec, key, date_col, tie, **split).filter(~F.col(_OLD)).drop(_OLD)
    if not none_late:
        again = of_late(history.select(*columns).unionByName(new), "left_semi")
        redone = rolling(again, spec, key, date_col, tie, **split)
        since = late.withColumnRenamed("_key", "_late")
        redone = (redone.join(since, redone[key].eqNullSafe(F.col("_late")))
                  .filter(F.col(date_col) >= F.col(_FROM)).drop("_late", _FROM))
        results = results.unionByName(redone)
    else:
        discard(new.sparkSession, path)
    keep = state_columns(spec, key, date_col, tie)
    return results, last_rows(state.select(*keep).unionByName(new.select(*keep)), spec, key, date_col, tie)


# ---------------------------------------------------------------- runs in a folder

def last_run(spark: SparkSession, folder: str) -> int:
    """Number of the last finished run; 0 before the first."""
    if not exists(spark, f"{folder}/runs"):
        return 0
    return spark.read.schema("run int").parquet(f"{folder}/runs").agg(F.max("run")).first()[0] or 0


def run_windows(new: DataFrame, history: DataFrame, folder: str, spec: RollingSpec, key: str = "sensor_id",
                date_col: str = "report_date", tie: str = "id", **split) -> int:
    """One run: results and state of ``new`` go to ``folder``; returns the run's number.

    ``history``: the rows of all earlier runs, as ``new``."""
    spark = new.sparkSession
    before = last_run(spark, folder)
    keep = new.select(*state_columns(spec, key, date_col, tie))
    state = spark.read.schema(keep.schema).parquet(f"{folder}/state/run={before}") if before else spark.createDataFrame([], keep.schema)
    results, following = advance(new, state, history, spec, key, date_col, tie, **split)
    run = before + 1
    results.write.mode("overwrite").parquet(f"{folder}/results/run={run}")
    following.write.mode("overwrite").parquet(f"{folder}/state/run={run}")
    spark.createDataFrame([(run,)], "run int").coalesce(1).write.mode("append").parquet(f"{folder}/runs")
    return run


def latest_results(spark: SparkSession, folder: str, tie: str = "id") -> DataFrame:
    """Results of all finished runs: for each id the rows of the last run that returned it."""
    done = spark.read.parquet(f"{folder}/results").filter(F.col("run") <= last_run(spark, folder))
    newest = done.groupBy(F.col(tie).alias("_tie")).agg(F.max("run").alias("_newest"))
    return (done.join(newest, F.col(tie).eqNullSafe(F.col("_tie")) & (F.col("run") == F.col("_newest")), "left_semi")
            .drop("run"))
