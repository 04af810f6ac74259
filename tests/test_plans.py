"""Physical-plan properties that matter at scale."""

import re

import __spark_entry__ as se
from tests.conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rule_plans_have_no_python(spark):
    for name in ("sensor_issues", "device_issues", "anomaly_reasons", "fleet_status"):
        plan = _plan(se.queries()[name](spark, SF_SMALL))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan), name


def test_sensor_issues_one_window_shuffle(spark):
    plan = _plan(se.queries()["sensor_issues"](spark, SF_SMALL))
    windows = re.findall(r"\bWindow \[", plan)
    assert len(windows) == 1, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_join_counts_do_not_emit_pairs(spark):
    plan = _plan(se.queries()["device_sensor_join_counts"](spark, SF_SMALL))
    # both sides are aggregated before the join
    join = plan[plan.find("Join"):]
    assert "HashAggregate" in join


def test_scan_prunes_columns(spark):
    df = se.queries()["fleet_status"](spark, SF_SMALL)
    plan = _plan(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(n.split(":")[0] for n in schema.split(",")) <= {"event_id", "ts", "user_id", "value"}
