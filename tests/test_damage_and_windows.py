"""Damaged archives, time windows, and small sinks."""

import datetime as dt
import io
import zipfile

import numpy as np
from encoder import block, dump, tgz
from pyspark.sql import functions as F

from arraymetrics.model import metric_dim, resource_dim
from arraymetrics.operators import joins, select, stats, timegrid
from arraymetrics.sources import archive, config


def test_damaged_archives_are_right_or_in_quarantine(spark):
    rng = np.random.default_rng(5)
    raw = tgz(dump([block([("10", ["A", "B"], ["22", "384"])], 0, 6000, 60, rng.integers(0, 9999, (100, 4)))], "SN1"))
    rows = [("whole", None, raw)]
    for n in range(500):
        broken = bytearray(raw)
        for at in rng.integers(0, len(raw), 8):
            broken[at] = rng.integers(0, 256)
        rows.append((f"d{n}", None, bytes(broken)))
    got = {}
    for r in archive.decode(spark.createDataFrame(rows, "path string, member string, content binary").repartition(8)).collect():
        got.setdefault(r.path, []).append((r.reason is not None, r.element, r.metric_id, tuple(r.data or ())))
    whole = sorted(got.pop("whole"))
    assert len(whole) == 4 and len(got) == 500
    assert all(len(x) == 1 and x[0][0] or sorted(x) == whole for x in got.values())


def test_bad_times_end(spark):
    for start, end, step in ((600, 0, 60), (0, 600, -60), (0, 600, 0)):
        raw = tgz(dump([block([("10", ["A"], ["22"])], start, end, step, np.zeros((10, 1)))], "SN1"))
        bad = archive.decode(spark.createDataFrame([("p", None, raw)], "path string, member string, content binary")).collect()
        assert [r.reason for r in bad] == ["bad_header"]


def test_zip_members_fail_alone(spark, tmp_path):
    good = tgz(dump([block([("10", ["A"], ["22"])], 0, 120, 60, [[1], [2]])], "SN1"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in ("a.tgz", "b.tgz", "c.tgz"):
            z.writestr(name, good)
    raw = bytearray(out.getvalue())
    at = raw.index(b"b.tgz") + 60
    raw[at : at + 20] = b"x" * 20
    (tmp_path / "x.zip").write_bytes(bytes(raw))
    got = {r.member: len(r.content) for r in archive.scan_zip_members(spark, str(tmp_path)).collect()}
    assert got == {"a.tgz": len(good), "b.tgz": 0, "c.tgz": len(good)}


def _points(spark, rows):
    cols = "sn string, resource string, element string, metric_id string, metric string, scrape_interval int, ts timestamp, value double"
    return spark.createDataFrame([("S", "Controller", e, m, m, 60, t, v) for e, m, t, v in rows], cols)


def test_windows(spark):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    df = _points(spark, [("A", "23", day(1), 100.0), ("A", "26", day(1), 100.0), ("A", "23", day(3), 5.0), ("A", "26", day(4), 7.0), ("A", "23", day(4, 1), 99.0)])
    assert stats.bandwidth_total(df).first().max_total == 200
    assert stats.bandwidth_total(df, day(2), day(4)).first().max_total == 12  # (the 1st, the 4th]
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    one = _points(spark, [("A", "23", at(-50), 1.0), ("A", "23", at(130), 2.0), ("A", "23", at(170), 3.0)])
    grid = lambda **k: {int((r.ts - at(0)).total_seconds()): r.value for r in timegrid.step_grid(one, F.lit(at(0)), F.lit(at(360)), 60, **k).collect()}
    assert grid() == {180: 3.0} and grid(lookback=5) == {} and grid(lookback=30) == {180: 3.0}
    assert grid(lookback=150) == {0: 1.0, 60: 1.0, 180: 3.0, 240: 3.0, 300: 3.0}


def test_sinks_and_lists(spark, tmp_path):
    joins.write_mapping(joins.metric_mapping(metric_dim(spark)), str(tmp_path / "m"))
    n = metric_dim(spark).count()
    assert spark.read.option("header", True).csv(str(tmp_path / "m" / "csv")).count() == n == spark.read.json(str(tmp_path / "m" / "json")).count()
    metric_dim(spark).coalesce(1).write.option("header", True).csv(str(tmp_path / "d" / "metrics.csv"))
    resource_dim(spark).coalesce(1).write.option("header", True).csv(str(tmp_path / "d" / "resources.csv"))
    metrics, resources = config.load_dims(spark, str(tmp_path / "d"))
    assert sorted(metrics.collect()) == sorted(metric_dim(spark).collect()) and sorted(resources.collect()) == sorted(resource_dim(spark).collect())
    assert len(set(select.DEFAULT_METRICS)) == 59 and len(select.LOAD_METRICS) == 17 and len(select.DEFAULT_RESOURCES) == 8
    pts = spark.createDataFrame([("f1",), ("f1",), ("f2",)], "source_file string")
    bad = spark.createDataFrame([("z", "m1"), ("z", "m2"), ("y", None)], "path string, member string")
    assert tuple(joins.ingest_outcome(pts, bad, 2.0).first()) == (2, 3, 3, 1.5)
    names = spark.createDataFrame([("SN1",), ("SN1\n",)], "sn string")
    assert [r.sn for r in select.match_labels(names, sn="SN1").collect()] == ["SN1"]
