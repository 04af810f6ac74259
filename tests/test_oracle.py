"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as se
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare

NAMES = sorted(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    res = compare(spark, name, SF_SMALL, duck_small)
    assert res["status"] == "ok", res


def test_every_query_has_oracle():
    from tirepulse.plans.catalog import QUERIES      # the text operators have their own tests
    assert set(QUERIES) <= set(se.oracle_sql())
    assert set(se.oracle_sql()) <= set(se.queries())


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "report_date", "vehicle_id", "sensor_id", "wheel_position", "wheel_id",
                          "issue_category", "risk_score"]


def test_import_without_session():
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.'); import __spark_entry__ as s; "
            "assert len(s.queries()) > 40 and len(s.oracle_sql()) > 40")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True,
                         cwd=__import__("os").path.dirname(se.__file__))
    assert out.returncode == 0, out.stderr[-2000:]
