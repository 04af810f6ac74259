"""Raw-file ingestion (description + data CSV), Parquet layout and report sinks."""

import datetime as dt
import os
import tempfile

import pytest

from tirepulse.operators.common import report_window
from tirepulse.sources import ingest
from tirepulse.sources.schema import DEVICE_SCHEMA


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_load_device_reports_typed(spark):
    folder = tempfile.mkdtemp(prefix="tp-ingest-")
    desc = _write(folder, "desc.csv", "column_name|type\n" + "\n".join(
        f"{f.name}|x" for f in DEVICE_SCHEMA.fields) + "\n")
    data = _write(folder, "data.csv", "\n".join([
        "a,b,c,d,e,f,g,h,i,j",  # header names differ: ignored, positions win
        "1,10,20,0,1,100,86300,2,2024-01-01,2024-01-01 05:00:00",
        "2,10,None,NULL,0,1.0,NaN,,2024-01-02 00:00:00,2024-01-02T01:02:03",
        "3,11,22,0,0,abc,5,1,2024-01-03,",
    ]) + "\n")
    df = ingest.load_device_reports(spark, desc, data, on_malformed="null")
    assert df.schema == DEVICE_SCHEMA
    rows = {r.id: r for r in df.collect()}
    assert rows[1].device_id == 20 and rows[1].not_transmitting_dur == 86300
    assert rows[1].updated_at == dt.datetime(2024, 1, 1, 5, 0)
    assert rows[2].device_id is None and rows[2].vehicle_out_of_service is None
    assert rows[2].transmitting_dur == 1          # "1.0" in an integer column
    assert rows[2].not_transmitting_dur is None   # "NaN"
    assert rows[2].transmission_level is None     # empty
    assert rows[2].updated_at == dt.datetime(2024, 1, 2, 1, 2, 3)
    assert rows[3].transmitting_dur is None       # not a number
    with pytest.raises(Exception, match="malformed report row, columns: transmitting_dur"):
        ingest.load_device_reports(spark, desc, data).collect()
    assert [r.id for r in ingest.load_device_reports(spark, desc, data, on_malformed="skip").orderBy("id").collect()] == [1, 2]


def test_malformed_rows_are_rejected_with_their_columns(spark):
    folder = tempfile.mkdtemp(prefix="tp-ingest-")
    desc = _write(folder, "desc.csv", "column_name|type\n" + "\n".join(
        f"{f.name}|x" for f in DEVICE_SCHEMA.fields) + "\n")
    data = _write(folder, "data.csv", "\n".join([
        "a,b,c,d,e,f,g,h,i,j",
        "1,10,20,0,1,100,86300,2,2024-01-01,2024-01-01",
        "2,10,1.5,0,1,100,86300,2,yesterday,2024-01-01",        # not whole; not a date
        "3,10,20,0,1,100,86300,2,2024-01-01,2024-01-01,extra",  # a field too many
        "4,10,20,0,1",                                          # short: padded, as in the source loader
    ]) + "\n")
    bad = {r.id: list(r.bad_columns) for r in ingest.rejected_reports(spark, desc, data, DEVICE_SCHEMA).collect()}
    assert set(bad) == {"2", "3"} and bad["3"] == ["_line"]
    assert set(bad["2"]) == {DEVICE_SCHEMA.fields[2].name, DEVICE_SCHEMA.fields[8].name}
    good = ingest.load_device_reports(spark, desc, data, on_malformed="skip")
    assert good.schema == DEVICE_SCHEMA and sorted(r.id for r in good.collect()) == [1, 4]


def test_fields_are_counted_with_quotes(spark):
    lines = {"a,b,c": 3, '"a,b",c': 2, 'a,"b, ""x"", y",c': 3, 'a,"b\\",c",d': 3, "": 1, 'a, "b,c" ,d': 3, 'say "a,b",c': 3,
             '"a","b","c,d"': 3, '"never closed,b,c': 3, ',"",,': 4, '"two\nlines, one field",b': 2}
    df = spark.createDataFrame([(k,) for k in lines], "line string")
    got = {r.line: r.n for r in df.select("line", ingest.field_count(df.line).alias("n")).collect()}
    assert got == lines


def test_quoted_separators_and_newlines(spark):
    folder = tempfile.mkdtemp(prefix="tp-quoted-")
    desc = _write(folder, "desc.csv", "column_name|type\n" + "\n".join(f"{f.name}|x" for f in DEVICE_SCHEMA.fields) + "\nnote|x\n")
    good = '1,10,20,0,1,100,86300,2,2024-01-01,2024-01-01,"left, ""rear"" axle"'
    long = '2,10,20,0,1,100,86300,2,2024-01-01,2024-01-01,"left, rear",extra'
    short = '3,10,20,0,1,100,86300,2,2024-01-01,"2024-01-01"'
    data = _write(folder, "data.csv", "\n".join(["h", good, long, short]) + "\n")
    assert {r.id: list(r.bad_columns) for r in ingest.rejected_reports(spark, desc, data, DEVICE_SCHEMA).collect()} == {"2": ["_line"]}
    broken = _write(folder, "lines.csv", "h\n" + '4,10,20,0,1,100,86300,2,2024-01-01,2024-01-01,"two\nlines"\n' + good + "\n")
    rows = {r.id: r.note for r in ingest.load_reports(spark, desc, broken, DEVICE_SCHEMA, quoted_newlines=True).collect()}
    assert rows[4] == "two\nlines" and set(rows) == {1, 4}


def test_partitioned_parquet_prunes_months(spark):
    from tests.helpers import device_df
    folder = tempfile.mkdtemp(prefix="tp-parquet-")
    df = device_df(spark, [dict(id=1, report_start_at=dt.datetime(2024, 1, 5)),
                           dict(id=2, report_start_at=dt.datetime(2024, 2, 5)),
                           dict(id=3, report_start_at=dt.datetime(2024, 3, 5))])
    ingest.write_reports(df, f"{folder}/devices")
    back = ingest.read_reports(spark, f"{folder}/devices")
    sel = report_window(back, "2024-02-01", "2024-02-29")
    assert [r.id for r in sel.collect()] == [2]
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "report_month" in plan
    assert "PushedFilters" in plan and "report_start_at" in plan


def test_mechanical_report_writes_five_outputs(spark):
    from tirepulse.plans.reports import MechanicalPaths, generate_mechanical_failure_report
    from tirepulse.sources.fixtures import load_reports
    folder = tempfile.mkdtemp(prefix="tp-report-")
    sensors, devices = load_reports(spark, "/root/testdata/sf0.001")
    paths = MechanicalPaths(**{k: f"{folder}/{k}" for k in MechanicalPaths.__dataclass_fields__})
    outs = generate_mechanical_failure_report(sensors, devices, "2024-01-01", "2024-01-31", paths)
    for name, df in outs.items():
        back = spark.read.option("header", True).csv(getattr(paths, name))
        assert back.count() == df.count() > 0
        assert back.columns == df.columns


def _counted(spark, df):
    """``df`` with a counter of the rows that jobs read of it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


def test_each_report_table_is_read_once_for_all_outputs(spark, tmp_path):
    from tirepulse.plans.reports import MechanicalPaths, generate_fleet_health_report, generate_mechanical_failure_report
    from tirepulse.sources.fixtures import load_reports
    from tirepulse.session import stored
    sensors, devices = (stored(df, "reports")[0] for df in load_reports(spark, "/root/testdata/sf0.001"))
    plain = generate_mechanical_failure_report(sensors, devices, "2024-01-01", "2024-01-31")
    (s, s_read), (d, d_read) = _counted(spark, sensors), _counted(spark, devices)
    paths = MechanicalPaths(**{k: f"{tmp_path}/{k}" for k in MechanicalPaths.__dataclass_fields__})
    outs = generate_mechanical_failure_report(s, d, "2024-01-01", "2024-01-31", paths)
    assert d_read.value == devices.count()
    assert s_read.value == 2 * sensors.count()           # the reports, and the day origin over the whole table
    for name, df in outs.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].collect())), name
    assert s_read.value == 2 * sensors.count()           # nor do the returned outputs read the tables
    s, s_read = _counted(spark, sensors)
    out = generate_fleet_health_report(s, "2024-01-01", "2024-01-31", str(tmp_path))
    assert s_read.value == 2 * sensors.count() and 0 < out["overall_availability"] <= 1      # all history, and the range


def test_device_health_report_worst_device(spark):
    from tirepulse.plans.reports import generate_device_health_report
    from tirepulse.sources.fixtures import load_reports
    folder = tempfile.mkdtemp(prefix="tp-device-")
    _, devices = load_reports(spark, "/root/testdata/sf0.001")
    out = generate_device_health_report(devices, "2024-01-01", "2024-01-31", folder)
    assert out["worst_device_efficiency"] is not None
    assert spark.read.option("header", True).csv(f"{folder}/fleet_status").count() == 30


def test_sql_views(spark):
    from tirepulse.sources.fixtures import load_reports
    sensors, devices = load_reports(spark, "/root/testdata/sf0.001")
    ingest.register_views(sensors, devices)
    n = ingest.query(spark, "SELECT COUNT(*) FROM time_in_level_sensor").first()[0]
    assert n == sensors.count()


def test_export_counts_rows_while_writing(spark):
    from tirepulse.sources.sinks import export_counted
    folder = tempfile.mkdtemp(prefix="tp-count-")
    df = spark.range(1234).withColumnRenamed("id", "x")
    assert export_counted(df, f"{folder}/a", order=["x"]) == 1234
    assert export_counted(df.limit(0), f"{folder}/b", fmt="parquet") == 0
    assert spark.read.option("header", True).csv(f"{folder}/a").count() == 1234
