import datetime as dt
import time

import numpy as np
from encoder import block, dump, tgz, zipped
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arraymetrics.model import metric_dim, resource_dim
from arraymetrics.operators import joins
from arraymetrics.sources import archive, store, text
from arraymetrics.streaming import watch


def _points(spark, folder):
    blocks = archive.decode(archive.scan_tgz(spark, str(folder)))
    return archive.to_points(blocks), archive.quarantine(blocks)


def test_decode_shapes_blocks_and_bad_files(spark, tmp_path):
    names = ["DAE010.2", "DAE,0/1 Диск"]
    one = block([("10", names, ["5", "18", "22"])], 1664312040, 1664312940, 60, np.arange(90).reshape(15, 6) - 40)
    two = block([("99", ["E"], ["98765"]), ("99", ["F"], ["22"])], 1664312940, 1664313240, 300, [[7, 8]])
    short = dump([block([("10", ["A"], ["22", "23"])], 0, 300, 60, np.arange(10).reshape(5, 2))], "SN2")[:-4]
    files = {"PerfData_M_SN_SN1_SP0_0_20220101000000.tgz": tgz(dump([one, two])), "b.tgz": tgz(short), "two.tgz": tgz(b"1", b"2"), "plain.tgz": b"no archive", "head.tgz": tgz(b"x" * 100), "json.tgz": tgz(dump([np.array([0, 12], "<i4").tobytes() + b"oops"]))}
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    points, bad = _points(spark, tmp_path)
    assert {(r.path.rsplit("/", 1)[1], r.reason) for r in bad.collect()} == {("two.tgz", "member_count"), ("plain.tgz", "not_gzip"), ("head.tgz", "truncated_header"), ("json.tgz", "bad_header")}
    empty = spark.createDataFrame([("p", None, bytearray()), ("q", None, None)], "path string, member string, content binary")  # Spark's reader leaves empty files out
    assert [r.reason for r in archive.quarantine(archive.decode(empty)).collect()] == ["empty", "empty"]
    rows = points.collect()
    assert sum(r.sn == "SN1" and r.resource_id == "10" for r in rows) == 90
    got = sorted((r.ts, r.value) for r in rows if r.element == names[1] and r.metric_id == "18")
    assert [v for _, v in got] == [float(6 * k + 4 - 40) for k in range(15)]
    assert got[1][0] - got[0][0] == dt.timedelta(seconds=60)
    assert {(r.element, r.metric_id, r.value) for r in rows if r.resource_id == "99"} == {("E", "98765", 7.0), ("F", "22", 8.0)}
    assert sum(r.sn == "SN2" for r in rows) == 8  # the last row is cut off


def test_zip_ingest_names_and_store(spark, tmp_path):
    raw = dump([block([("212", ["CTE0.A.IOM0.P0"], ["1183", "511"])], 1760918640, 1760918820, 60, [[15, 2048], [16, 1024], [19, 0]])], "SN9")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.zip").write_bytes(zipped({"PerfData_M_SN_SN9_SP0_0_20251020000400.tgz": tgz(raw), "note.txt": b""}))
    files = archive.scan_zip_members(spark, str(tmp_path / "in"))
    points, bad = archive.ingest(files, metric_dim(spark), resource_dim(spark))
    assert bad.count() == 0
    got = {(r.metric, r.value) for r in points.collect()}
    assert ("unknown_metric_1183", 15.0) in got and ("link_bandwidth_kb_s", 2.0) in got
    assert archive.ingest(files, metric_dim(spark), resource_dim(spark), include_unknown=False)[0].count() == 3
    store.write_points(points, str(tmp_path / "store"))
    back = store.read_points(spark, str(tmp_path / "store"))
    assert back.count() == 6
    assert "PartitionFilters: [isnotnull(" in back.where("sn = 'SN9'")._jdf.queryExecution().executedPlan().toString()
    store.delete_points(spark, str(tmp_path / "store"), selector=F.col("metric_id") == "511")
    assert store.read_points(spark, str(tmp_path / "store")).count() == 3


def test_text_formats_round_trip(spark, tmp_path):
    raw = dump([block([("207", ['CTE0"\\x', "CTE0-A"], ["68", "22"])], 1760918640, 1760918760, 60, [[1, 2, 3, 4], [5, 6, 7, 8]])])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tgz").write_bytes(tgz(raw))
    points, _ = archive.ingest(archive.scan_tgz(spark, str(tmp_path / "in")), metric_dim(spark), resource_dim(spark))
    key = lambda df: sorted((r.metric, r.element, r.resource, r.sn, r.value, r.ts) for r in df.collect())
    text.write_exposition(points, str(tmp_path / "e"), "gzip")
    assert key(text.read_exposition(spark, str(tmp_path / "e"))) == key(points)
    text.export_series_json(points, str(tmp_path / "j"))
    assert key(text.import_series_json(spark, str(tmp_path / "j"))) == key(points)
    text.write_long_csv(points.where("element = 'CTE0-A'"), str(tmp_path / "c"))
    rows = text.read_long_csv(spark, str(tmp_path / "c")).collect()
    assert len(rows) == 4 and rows[0].time.endswith("Z") and rows[0].sn == "SN1"
    text.write_wide_csv(points, str(tmp_path / "w"))
    wide = spark.read.option("header", True).csv(str(tmp_path / "w" / "cpu_output.csv"))
    assert wide.columns[:7] == ["CPUPERF", "#", "BgnDateTime", "EndDateTime", "Serial", "Slot", "Type"] and wide.count() == 4
    assert sorted(int(r["#"]) for r in wide.collect()) == [1, 2, 3, 4] and "0A" in {r.Slot for r in wide.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.integers(-(2**31), 2**31 - 1), min_size=1, max_size=12), step=st.sampled_from([5, 60, 300]))
def test_decode_inverts_encode(spark, tmp_path, values, step):
    raw = dump([block([("11", ["L"], ["22"])], 1000, 1000 + step * len(values), step, [[v] for v in values])])
    df = spark.createDataFrame([("p", None, bytearray(tgz(raw)))], "path string, member string, content binary")
    rows = archive.to_points(archive.decode(df)).orderBy("ts").collect()
    assert [int(r.value) for r in rows] == values and rows[-1].ts.timestamp() == 1000 + step * (len(values) - 1)


def test_stream_equals_batch_and_loads_once(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for i in range(3):
        raw = dump([block([("10", ["A"], ["22"])], 60 * i, 60 * i + 120, 60, [[i], [i + 1]])])
        (land / f"PerfData_M_SN_SN1_SP0_{i}_20220101000000.tgz").write_bytes(tgz(raw) if i else b"broken")
    out, bad, mark = (str(tmp_path / x) for x in ("out", "bad", "mark"))
    for _ in range(2):  # the second run finds nothing new
        watch.stream_points(watch.watch(spark, str(land), most_files=1), metric_dim(spark), resource_dim(spark), out, bad, mark).awaitTermination(120)
    got = watch.read_stream_points(spark, out)
    batch, _ = archive.ingest(archive.scan_tgz(spark, str(land), "PerfData_"), metric_dim(spark), resource_dim(spark))
    key = lambda df: sorted((r.metric, r.ts, r.value) for r in df.collect())
    assert key(got) == key(batch) and got.count() == 4
    lost = spark.read.parquet(f"{bad}/batch=*")
    assert [r.reason for r in lost.collect()] == ["not_gzip"]
    c = watch.counters(got, lost).first()
    assert (c.processed, c.points, c.failed) == (2, 4, 1)
    (land / "PerfData_M_SN_SN1_SP0_0_20220101000000.tgz").write_bytes(tgz(dump([block([("10", ["A"], ["22"])], 0, 120, 60, [[1], [2]])])))
    blocks, failed = watch.retry_quarantine(spark, lost)
    assert archive.to_points(blocks).count() == 2 and failed.count() == 0


def test_rollup_stream(spark, tmp_path):
    rows = [("S", "R", "E", "m", dt.datetime(2024, 1, 1, 0, k), float(k)) for k in range(12)]
    df = spark.createDataFrame(rows, "sn string, resource string, element string, metric string, ts timestamp, value double")
    df.write.parquet(str(tmp_path / "p"))
    seen = watch.Progress()
    spark.streams.addListener(seen)
    stream = watch.rollup(watch.observed(spark.readStream.schema(df.schema).parquet(str(tmp_path / "p"))))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("rolled").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.sql("select * from rolled").collect()))
    assert got == sorted(map(tuple, watch.rollup(df).collect())) and len(got) == 3
    for _ in range(50):
        if seen.points:
            break
        time.sleep(0.2)
    spark.streams.removeListener(seen)
    assert seen.points == 12


def test_dedupe_and_skip(spark):
    df = spark.createDataFrame([("a", 1.0, "f1"), ("a", 2.0, "f2"), ("b", 3.0, "f1")], "sn string, value double, source_file string")
    assert sorted((r.sn, r.value) for r in joins.dedupe(df).collect()) == [("a", 2.0), ("b", 3.0)]
