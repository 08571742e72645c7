"""The store: sizes of files, deletion in place, crashes, batches that run twice, uploads that grow."""

import datetime as dt
import time
from pathlib import Path

import pytest
from encoder import block, dump, tgz
from pyspark.sql import functions as F

from arraymetrics.model import POINTS, metric_dim, resource_dim
from arraymetrics.sources import store
from arraymetrics.streaming import uploads, watch

UTC = dt.timezone.utc


def _points(spark, days=3, arrays=("S1", "S2"), n=40):
    rows = [(a, "10", "Disk", f"E{k % 4}", "22", "m", dt.datetime(2024, 1, 1 + d, 23, 30, tzinfo=UTC) + dt.timedelta(minutes=k % 29), float(k), 60, f"f{k}", None) for a in arrays for d in range(days) for k in range(n)]
    return spark.createDataFrame(rows, POINTS).repartition(40)


def _key(df):
    return sorted((r.sn or "", str(r.dt), r.element, r.value) for r in df.collect())


def test_one_file_for_each_small_day_and_array(spark, tmp_path):
    at, df = str(tmp_path / "s"), _points(spark)
    store.write_points(df, at)
    listed = store.files(spark, at).collect()
    assert len(listed) == 6 and {(str(r.dt), r.sn) for r in listed} == {(f"2024-01-0{d}", a) for d in (1, 2, 3) for a in ("S1", "S2")}
    assert sum(r.n_rows for r in listed) == 240 and all(Path(r.file.removeprefix("file:")).stat().st_size == r.bytes for r in listed)
    assert _key(store.read_points(spark, at)) == _key(df.withColumn("dt", F.to_date("ts")))
    store.write_points(df.where("value < 3"), at)
    assert store.read_points(spark, at).count() == 240 + 18
    store.write_points(df.where("sn = 'S1' AND value < 3"), at, "overwrite")
    assert sorted((r.sn, r["count"]) for r in store.read_points(spark, at).groupBy("sn").count().collect()) == [("S1", 9), ("S2", 129)]
    with pytest.raises(ValueError):
        store.write_points(df, at, "replace")


def test_large_days_are_split(spark, tmp_path):
    at = str(tmp_path / "s")
    big = spark.range(200_000).select(F.lit("S").alias("sn"), F.lit("10").alias("resource_id"), F.lit("D").alias("resource"), F.lit("E").alias("element"), F.lit("22").alias("metric_id"), F.lit("m").alias("metric"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400).alias("ts"), F.rand(1).alias("value"), F.lit(60).alias("scrape_interval"), F.concat(F.lit("f"), "id").alias("source_file"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        store.write_points(big, at)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert store.files(spark, at).count() > 1 and store.read_points(spark, at).count() == 200_000


def test_odd_serial_numbers(spark, tmp_path):
    at = str(tmp_path / "a b[1]" / "s")
    df = _points(spark, 1, ("S 1+%", "a=b/c", "x[0]*", None), 2)
    store.write_points(df, at)
    assert {r.sn for r in store.read_points(spark, at).collect()} == {"S 1+%", "a=b/c", "x[0]*", None}
    store.delete_points(spark, at, "x[0]*")
    store.delete_points(spark, at, selector=F.col("value") == 1)
    assert sorted((r.sn or "", r.value) for r in store.read_points(spark, at).collect()) == [("", 0.0), ("S 1+%", 0.0), ("a=b/c", 0.0)]


def test_delete_reads_nothing_or_touched_parts_only(spark, tmp_path):
    at = str(tmp_path / "s")
    store.write_points(_points(spark), at)
    broken = [Path(r.file.removeprefix("file:")) for r in store.files(spark, at).where("sn = 'S2' OR dt = '2024-01-01'").collect()]
    for f in broken:
        f.write_bytes(b"no parquet")
        f.with_name(f".{f.name}.crc").unlink()
    before = {r.file for r in store.files(spark, at).collect()}
    store.delete_points(spark, at, "S2")  # reads no file
    left = {r.file for r in store.files(spark, at).collect()}
    assert left < before and len(left) == 3
    store.delete_points(spark, at, selector=(F.col("dt") == "2024-01-03") & (F.col("value") >= 10))
    after = {r.file for r in store.files(spark, at).collect()}
    assert len(after & left) == 2 and len(after) == 3  # one part was written anew
    assert store.read_points(spark, at).where("dt = '2024-01-03'").count() == 10
    store.delete_points(spark, at)
    assert store.read_points(spark, at).count() == 0
    assert store.remove_unlisted(spark, at) == 2 and not list((tmp_path / "s" / "data").iterdir())


def test_crashes_and_other_writers(spark, tmp_path, monkeypatch):
    at, df = str(tmp_path / "s"), _points(spark, 1)
    store.write_points(df, at)
    real = store._commit

    def crash(*a):
        raise KeyboardInterrupt

    for act in (lambda: store.write_points(df, at), lambda: store.delete_points(spark, at, "S1"), lambda: store.delete_points(spark, at, selector=F.col("value") > 5)):
        monkeypatch.setattr(store, "_commit", crash)
        with pytest.raises(KeyboardInterrupt):
            act()
        monkeypatch.setattr(store, "_commit", real)
        assert store.read_points(spark, at).count() == 80

    def late(spark, path, listed, seen):
        monkeypatch.setattr(store, "_commit", real)
        store.write_points(df.where("value = 0"), at)
        real(spark, path, listed, seen)

    monkeypatch.setattr(store, "_commit", late)
    with pytest.raises(store.Conflict):
        store.write_points(df, at)
    assert store.read_points(spark, at).count() == 82
    (tmp_path / "s" / "commits" / f"{3:012d}").write_bytes(b"half a na")  # a writer that died in its commit
    assert store.read_points(spark, at).count() == 82
    store.write_points(df.where("value = 0"), at)
    assert store.read_points(spark, at).count() == 84


def test_a_batch_that_runs_twice_leaves_one_copy(spark, tmp_path):
    at, df = str(tmp_path / "s"), _points(spark, 1)
    store.write_points(df.where("value < 5"), at, source="q", batch=0)
    store.write_points(df.where("value >= 5"), at, source="q", batch=1)
    store.write_points(df.where("value >= 5"), at, source="q", batch=1)
    store.write_points(df.where("value < 5"), at, source="other", batch=1)
    assert store.read_points(spark, at).count() == 90
    plan = store.read_points(spark, at).where("sn = 'S1' AND dt = DATE '2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan


def _dump(k, n=2):
    return tgz(dump([block([("10", ["A"], ["22"])], 600 * k, 600 * k + 60 * n, 60, [[i] for i in range(n)])]))


def test_stream_into_the_store_survives_restarts(spark, tmp_path):
    land, out, bad, mark = (str(tmp_path / x) for x in ("land", "out", "bad", "mark"))
    Path(land).mkdir()
    name = lambda k: Path(land, f"PerfData_M_SN_SN1_SP0_{k}_20220101000000.tgz")

    def run():
        watch.stream_points(watch.watch(spark, land, most_files=1), metric_dim(spark), resource_dim(spark), out, bad, mark).awaitTermination(120)

    for k, raw in enumerate([_dump(0), b"broken", _dump(2)]):
        name(k).write_bytes(raw)
    run()
    name(3).write_bytes(_dump(3, 4))
    run()
    total = watch.running_totals(spark, mark).first()
    assert (total.processed, total.failed, total.points) == (3, 1, 8) and total.first_ts.timestamp() == 0 and total.last_ts.timestamp() == 1980
    assert store.read_points(spark, out).count() == 8
    for f in sorted(Path(mark, "commits").iterdir()):  # the last batch's commit is lost, so it runs again
        if f.name.strip(".") in ("3", "3.crc"):
            f.unlink()
    run()
    assert store.read_points(spark, out).count() == 8 and watch.running_totals(spark, mark).first().points == 8


def test_growing_files_are_loaded_once_and_whole(spark, tmp_path):
    land, out, bad, mark = (str(tmp_path / x) for x in ("land", "out", "bad", "mark"))
    Path(land, "sub").mkdir(parents=True)
    slow, quick = Path(land, "sub", "PerfData_M_SN_SN1_SP0_0_20220101000000.tgz"), Path(land, "PerfData_M_SN_SN2_SP0_0_20220101000000.tgz")
    raw = _dump(0, 30)
    slow.write_bytes(b"")
    quick.write_bytes(_dump(1))
    Path(land, "other.tgz").write_bytes(_dump(2))
    q = watch.stream_points(uploads.uploads(spark, land, seconds=4), metric_dim(spark), resource_dim(spark), out, bad, mark, seconds=1)
    try:
        for cut in (20, 60, len(raw) - 5, len(raw)):
            time.sleep(3)
            slow.write_bytes(raw[:cut])
        for _ in range(60):
            time.sleep(1)
            if q.exception() or (Path(f"{mark}-totals").exists() and (watch.running_totals(spark, mark).first().points or 0) >= 32):
                break
        time.sleep(6)  # nothing is loaded again
    finally:
        q.stop()
    assert q.exception() is None
    total = watch.running_totals(spark, mark).first()
    assert (total.processed, total.failed, total.points) == (2, 0, 32) and store.read_points(spark, out).count() == 32
