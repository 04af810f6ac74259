"""Windows computed in runs with a carried state equal those of one run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tirepulse.operators import features, window_state
from tirepulse.operators.windows import RollingSpec, rolling

SCHEMA = "id long, sensor_id int, report_date date, x double, y float"
SPEC = RollingSpec(aggs={"mean": ("avg", "x"), "sd": ("stddev", "x"), "total": ("sum", "y"), "n": ("count", None), "known": ("count", "x")},
                   lags={"before": "x", "day": "report_date"}, rows=4)


def _rows(seed, days=9, sensors=12):
    """Per day a report of most sensors (NULL is one of them): missing days, readings and ids, two on a day."""
    rng, rows = random.Random(seed), []
    for d in range(days):
        for s in [*range(sensors), None]:
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                rows.append((None if rng.random() < 0.05 else len(rows), s, dt.date(2024, 1, 1) + dt.timedelta(d),
                             None if rng.random() < 0.1 else float(rng.randrange(50)), float(rng.randrange(9))))
    return rows


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def _run_all(spark, batches, folder, spec=SPEC, **split):
    done = []
    for batch in batches:
        window_state.run_windows(spark.createDataFrame(batch, SCHEMA), spark.createDataFrame(done, SCHEMA), folder, spec, **split)
        done = done + batch
    return window_state.latest_results(spark, folder)


def test_day_by_day_equals_one_run(spark, tmp_path):
    rows = [r for r in _rows(1, days=5) if r[0] is not None]
    days = sorted({r[2] for r in rows})
    got = _run_all(spark, [[r for r in rows if r[2] == d] for d in days], str(tmp_path / "runs"))
    assert _sorted(got) == _sorted(rolling(spark.createDataFrame(rows, SCHEMA), SPEC))
    assert window_state.last_run(spark, str(tmp_path / "runs")) == 5


@pytest.mark.parametrize("split", [{}, {"hot_key_rows": 5, "block_rows": 4}])
def test_late_repeated_and_unnamed_rows(spark, tmp_path, split):
    """Rows that come runs late, some rows twice in later runs, rows of NULL sensors; hot sensors split into blocks."""
    rng = random.Random(4)
    rows = [r for r in _rows(2) if r[0] is not None]
    batches = [[], [], []]
    for r in rows:
        k = min(2, (r[2].day - 1) // 3)
        batches[max(k, rng.choice([0, 0, 0, 0, 1, 2]))].append(r)
    batches[2] += rng.sample(batches[0], 5)
    got = _run_all(spark, batches, str(tmp_path / "runs"), **split)
    assert _sorted(got) == _sorted(rolling(spark.createDataFrame(sum(batches, []), SCHEMA), SPEC))


def test_only_new_rows_and_sensors_with_late_rows_are_returned(spark, tmp_path):
    day = lambda d: dt.date(2024, 1, d)
    first = [(s * 100 + d, s, day(d), float(d), 0.0) for s in (1, 2) for d in range(1, 9)]
    new = [(901, 1, day(9), 9.0, 0.0), (902, 2, day(9), 9.0, 0.0), (999, 2, day(6), 50.0, 0.0)]
    folder = str(tmp_path / "runs")
    _run_all(spark, [first, new], folder)
    again = spark.read.parquet(f"{folder}/results/run=2")
    assert sorted(r.id for r in again.collect()) == [206, 207, 208, 901, 902, 999]
    state = spark.read.parquet(f"{folder}/state/run=2")
    assert {r.sensor_id: r["count"] for r in state.groupBy("sensor_id").count().collect()} == {1: 3, 2: 3}


def test_a_run_without_late_rows_does_not_read_the_history(spark):
    rows = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1), 1.0, 1.0)], SCHEMA)
    new = spark.createDataFrame([(2, 1, dt.date(2024, 1, 2), 3.0, 1.0)], SCHEMA)
    broken = rows.withColumn("x", F.raise_error(F.lit("the history was read")).cast("double"))
    results, state = window_state.advance(new, window_state.last_rows(rows, SPEC), broken, SPEC)
    assert [(r.id, r.mean, r.before) for r in results.collect()] == [(2, 2.0, 1.0)]
    assert state.count() == 2


def test_a_failed_run_is_run_again(spark, tmp_path):
    folder = str(tmp_path / "runs")
    rows = [r for r in _rows(3, days=3) if r[0] is not None]
    one, two = [r for r in rows if r[2].day < 3], [r for r in rows if r[2].day == 3]
    _run_all(spark, [one], folder)
    # results of a second run that never finished
    spark.createDataFrame(two[:2], SCHEMA).write.parquet(f"{folder}/results/run=2")
    assert window_state.latest_results(spark, folder).count() == len(one)
    window_state.run_windows(spark.createDataFrame(two, SCHEMA), spark.createDataFrame(one, SCHEMA), folder, SPEC)
    assert _sorted(window_state.latest_results(spark, folder)) == _sorted(rolling(spark.createDataFrame(rows, SCHEMA), SPEC))


def test_the_state_is_narrow_and_bounded(spark):
    from tirepulse.sources.fixtures import load_reports
    sensors, _ = load_reports(spark, "/root/testdata/sf0.001")
    daily = features.critical_durations(sensors, "2024-01-01", "2024-01-31")
    state = window_state.last_rows(daily, features.stats_spec())
    assert state.groupBy("sensor_id").count().agg(F.max("count")).first()[0] == 6
    assert set(state.columns) == {"sensor_id", "report_date", "id", *features.READINGS.values()}
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2               # the limit holds before the shuffle too
    with pytest.raises(ValueError, match="named columns"):
        window_state.state_columns(RollingSpec(aggs={"a": ("sum", F.col("x") + 1)}))
