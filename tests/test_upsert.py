"""Deliveries merged into the stored table: corrections, repeats, moves, and which files change."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tests.helpers import device_df
from tirepulse.sources import ingest, upsert


def _at(month, day=1, hour=0):
    return dt.datetime(2024, month, day, hour)


def _files(path):
    return {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns
            for folder, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def _months(files):
    return {os.path.basename(os.path.dirname(f)).split("=")[1] for f in files}


def _table(spark, path):
    return {r.id: (r.device_id, r.report_start_at, r.report_month) for r in spark.read.parquet(path).collect()}


def _first(spark, path):
    rows = [dict(id=k, device_id=k, report_start_at=_at(1 + k % 3, 1 + k), updated_at=_at(4)) for k in range(12)]
    assert upsert.merge_reports(spark, device_df(spark, rows), path) == upsert.Merged(12, 0, ("2024-01", "2024-02", "2024-03"))
    return rows


def test_a_delivery_sent_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "devices")
    rows = _first(spark, path)
    before = _files(path)
    assert upsert.merge_reports(spark, device_df(spark, rows + rows), path) == upsert.Merged(0, 0, ())
    assert _files(path) == before


def test_a_correction_replaces_one_row_and_rewrites_its_month_only(spark, tmp_path):
    path = str(tmp_path / "devices")
    rows = _first(spark, path)
    before = _files(path)
    fixed = dict(rows[4], device_id=77, updated_at=_at(4, 2))
    older = dict(rows[5], device_id=88, updated_at=_at(3))
    nothing = dict(rows[6], device_id=99, updated_at=None)
    got = upsert.merge_reports(spark, device_df(spark, [fixed, older, nothing]), path)
    assert got == upsert.Merged(1, 1, ("2024-02",))
    table, after = _table(spark, path), _files(path)
    assert len(table) == 12 and table[4][0] == 77 and table[5][0] == 5 and table[6][0] == 6
    kept = {f for f in before if "2024-02" not in f}
    assert {f: t for f, t in after.items() if f in kept} == {f: before[f] for f in kept}
    assert _months(set(after) - set(before)) == {"2024-02"}


def test_a_report_that_moves_leaves_its_month(spark, tmp_path):
    path = str(tmp_path / "devices")
    _first(spark, path)
    lonely = [dict(id=50, device_id=1, report_start_at=_at(7), updated_at=_at(7))]
    assert upsert.merge_reports(spark, device_df(spark, lonely), path).months == ("2024-07",)
    moved = [dict(id=50, device_id=1, report_start_at=_at(2, 9), updated_at=_at(8)),
             dict(id=51, device_id=1, report_start_at=None, updated_at=_at(8))]
    assert upsert.merge_reports(spark, device_df(spark, moved), path) == upsert.Merged(2, 1, ("2024-02", "2024-07", None))
    table = _table(spark, path)
    assert table[50][2] == "2024-02" and table[51][2] is None and len(table) == 14
    assert not os.path.exists(f"{path}/report_month=2024-07")           # the month that was emptied
    back = [dict(id=51, device_id=1, report_start_at=_at(1, 2), updated_at=_at(9))]
    assert upsert.merge_reports(spark, device_df(spark, back), path) == upsert.Merged(1, 1, ("2024-01", None))
    assert _table(spark, path)[51][2] == "2024-01" and len(_table(spark, path)) == 14


def test_versions_within_a_delivery_and_rows_without_id(spark, tmp_path):
    path = str(tmp_path / "devices")
    _first(spark, path)
    many = [dict(id=3, device_id=100 + k, report_start_at=_at(1, 4), updated_at=_at(5, 1 + k % 20)) for k in range(40)]
    unnamed = [dict(id=None, device_id=d, report_start_at=_at(1, 4), updated_at=_at(5)) for d in (1, 1, 2)]
    delivered = device_df(spark, many + unnamed).repartition(6)
    assert upsert.merge_reports(spark, delivered, path).changed == 3
    assert upsert.merge_reports(spark, delivered.repartition(2), path) == upsert.Merged(0, 0, ())
    rows = spark.read.parquet(path)
    assert rows.filter("id = 3").first().device_id == 139          # the last update, then the larger columns
    assert sorted(r.device_id for r in rows.filter("id IS NULL").collect()) == [1, 2]


def test_reports_read_the_merged_table(spark, tmp_path):
    from tirepulse.operators import kpis
    path = str(tmp_path / "devices")
    rows = _first(spark, path)
    upsert.merge_reports(spark, device_df(spark, [dict(rows[0], vehicle_out_of_service=1, updated_at=_at(6))]), path)
    status = kpis.fleet_status(ingest.read_reports(spark, path), "2024-01-01", "2024-12-31")
    assert status.agg(F.sum("vehicles_out_of_service"), F.sum("operational_fleet")).first() == (1, 11)
    assert set(ingest.read_reports(spark, path).columns) - {"report_month"} == set(device_df(spark, []).columns)
