"""Incremental ingest: new files are appended once, restarts do not duplicate."""

import os
import tempfile

from tirepulse.sources.schema import DEVICE_SCHEMA
from tirepulse.sources import ingest
from tirepulse.streaming.ingest_stream import ingest_stream, reject_stream


def test_ingest_stream_appends_new_files_once(spark):
    root = tempfile.mkdtemp(prefix="tp-stream-")
    inbox = os.path.join(root, "inbox")
    os.makedirs(inbox)
    desc = os.path.join(root, "desc.csv")
    with open(desc, "w") as fh:
        fh.write("column_name\n" + "\n".join(f.name for f in DEVICE_SCHEMA.fields) + "\n")

    def drop(name, rows):
        with open(os.path.join(inbox, name), "w") as fh:
            fh.write("h1,h2,h3,h4,h5,h6,h7,h8,h9,h10\n" + "\n".join(rows) + "\n")

    out, ckpt = os.path.join(root, "table"), os.path.join(root, "ckpt")
    drop("day1.csv", ["1,10,20,0,0,100,86300,1,2024-01-01,2024-01-01",
                      "2,11,22,0,1,200,86200,2,2024-01-01,2024-01-01"])
    ingest_stream(spark, desc, inbox, out, ckpt, DEVICE_SCHEMA).awaitTermination()
    assert spark.read.parquet(out).count() == 2

    drop("day2.csv", ["3,10,20,0,0,300,86100,1,2024-02-02,2024-02-02"])
    ingest_stream(spark, desc, inbox, out, ckpt, DEVICE_SCHEMA).awaitTermination()
    back = spark.read.parquet(out)
    assert sorted(r.id for r in back.collect()) == [1, 2, 3]
    assert sorted(r[0] for r in back.select("report_month").distinct().collect()) == ["2024-01", "2024-02"]


def test_stream_and_loader_reject_the_same_rows(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    desc = tmp_path / "desc.csv"
    desc.write_text("column_name\n" + "\n".join(f.name for f in DEVICE_SCHEMA.fields) + "\n")
    lines = ["1,10,20,0,0,100,86300,1,2024-01-01,2024-01-01", "2,10,20,0,0,abc,86300,1,2024-01-01,2024-01-01",
             "3,10,20,0,0,100,86300,1,2024-01-01,2024-01-01,extra", "4,None,1.0,0,0,100,NaN,1,2024-02-01,"]
    (inbox / "day1.csv").write_text("header\n" + "\n".join(lines[:3]) + "\n")
    out, bad = str(tmp_path / "table"), str(tmp_path / "rejects")
    for name in ("day1.csv", "day2.csv"):
        if name == "day2.csv":
            (inbox / name).write_text("header\n" + lines[3] + "\n" + lines[1] + "\n")
        ingest_stream(spark, str(desc), str(inbox), out, str(tmp_path / "c1"), DEVICE_SCHEMA).awaitTermination()
        reject_stream(spark, str(desc), str(inbox), bad, str(tmp_path / "c2"), DEVICE_SCHEMA).awaitTermination()
    key = lambda rows: sorted((r.id, list(r.bad_columns)) for r in rows)
    want = ingest.rejected_reports(spark, str(desc), str(inbox), DEVICE_SCHEMA).collect()
    assert key(spark.read.parquet(bad).collect()) == key(want) and len(want) == 3
    loaded = ingest.load_device_reports(spark, str(desc), str(inbox), on_malformed="skip")
    back = spark.read.parquet(out).select(*loaded.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, loaded.collect())) and back.count() == 2
