"""Tables that users supply, wide files, suggestions, orders, zones."""

import datetime as dt
import difflib
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from arraymetrics.model import metric_dim
from arraymetrics.operators import coverage, joins, quantiles, reports, select, stats, timegrid
from arraymetrics.sources import archive, config, text


def test_seed_is_read_back(spark, tmp_path):
    config.write_seed(spark, str(tmp_path / "c"))
    metrics, resources = config.load_dims(spark, str(tmp_path / "c"))
    assert sorted(metrics.collect()) == sorted(metric_dim(spark).collect()) and resources.count() == 8
    wides = config.load_wide(spark, str(tmp_path / "c"), metrics)
    assert wides == config.seed_wide() and len(wides) == 8


def _csv(path, header, *lines):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")


def test_bad_tables_are_refused(spark, tmp_path):
    d = tmp_path / "d"
    _csv(d / "metrics.csv", "metric_id,display_name,divisor", '22,"A, [0K,4K)",', "22,B,1024", "23,,1", "24,C,0")
    _csv(d / "resources.csv", "resource_id,resource", "10,Disk", "10,LUN")
    _csv(d / "conversions.csv", "metric_id,divisor", "22,-1")
    with pytest.raises(config.BadConfiguration) as e:
        config.load_dims(spark, str(d))
    assert len(str(e.value).split("\n")) == 5
    _csv(d / "metrics.csv", "metric_id,display_name,divisor", '22,"A, [0K,4K)",', "23,B,10")
    _csv(d / "resources.csv", "resource_id,resource", "10,Disk")
    _csv(d / "conversions.csv", "metric_id,divisor", "22,4")
    metrics, _ = config.load_dims(spark, str(d))
    assert {(r.metric_id, r.display_name, r.divisor) for r in metrics.collect()} == {("22", "A, [0K,4K)", 4.0), ("23", "B", 10.0)}
    _csv(d / "wide_resources.csv", "resource_id,file,prefix", "10,disk.csv,RG", "11,lun.csv,LD")
    _csv(d / "wide_columns.csv", "resource_id,place,kind,name,value", "10,0,meta,Rg,@what", "10,1,metric,22,", "10,1,metric,22,", "12,1,other,22,")
    with pytest.raises(config.BadConfiguration) as e:
        config.load_wide(spark, str(d), metrics)
    assert len(str(e.value).split("\n")) == 6
    _csv(d / "wide_resources.csv", "resource_id,file,prefix", "10,disk.csv,RG")
    _csv(d / "wide_columns.csv", "resource_id,place,kind,name,value", "10,5,metric,77,", "10,3,meta,Rg,@element", "10,4,metric,22,", "10,2,meta,Serial,@sn", "10,6,meta,Kind,'-'")
    (w,) = config.load_wide(spark, str(d), metrics)
    assert w == config.Wide("10", "disk.csv", "RG", (("Serial", "@sn"), ("Rg", "@element"), ("Kind", "'-'")), (("22", "A, [0K,4K)"), ("77", "UNKNOWN_METRIC_77")))
    points = spark.createDataFrame([("S1", "10", "E1", "22", dt.datetime(2024, 1, 2), 5.0), ("S1", "10", "E0", "77", dt.datetime(2024, 1, 2), 7.0), ("S1", "11", "E", "22", dt.datetime(2024, 1, 2), 1.0)], "sn string, resource_id string, element string, metric_id string, ts timestamp, value double")
    text.write_wide_csv(points, str(tmp_path / "w"), wides=[w])
    got = spark.read.text(str(tmp_path / "w" / "disk.csv"))
    lines = sorted({r.value for r in got.collect()})  # each file has the header
    assert lines[0] == "RG,#,BgnDateTime,EndDateTime,Serial,Rg,Kind,\"A, [0K_4K)\",UNKNOWN_METRIC_77".replace('"A, [0K_4K)"', "A_ [0K_4K)")
    assert lines[1:] == ["RG,1,01/02/24 00:00:00,01/02/24 00:00:00,S1,E0,'-',0,7.0", "RG,2,01/02/24 00:00:00,01/02/24 00:00:00,S1,E1,'-',5.0,0"]


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.9])
def test_suggestions_equal_all_pairs(spark, threshold):
    rng = random.Random(4)
    words = ["read", "write", "bandwidth", "iops", "usage", "percent", "mb_s", "abc", "axbxc", "queue", "é"]
    names = lambda n: sorted({"_".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(n)} | {"".join(rng.choice("abxy") for _ in range(rng.randint(1, 9))) for _ in range(n)})
    m, a = names(40) + ["abc", "", "a" * 230], names(60) + ["axbxc", "", "a" * 228 + "bc"]
    want = {}
    for x in set(m):
        best = min((-difflib.SequenceMatcher(None, x, y).ratio(), y) for y in set(a))
        if -best[0] >= threshold:
            want[x] = (best[1], round(-best[0], 6))
    frame = lambda xs: spark.createDataFrame([(x,) for x in [*xs, None]], "metric string")
    assert {r.metric: (r.suggestion, r.ratio) for r in coverage.suggest(frame(m), frame(a), threshold).collect()} == want
    with pytest.raises(ValueError):
        coverage.suggest(frame(m), frame(a), 0)


def test_batches_in_order(spark, tmp_path):
    rng = random.Random(2)
    files = [(f"/in/{rng.randint(0, 3)}/{n:03d}.zip", rng.randint(0, 400)) for n in rng.sample(range(1000), 200)] + [("/b/000.zip", 50), ("/a/000.zip", 5000)]
    want, before = {}, 0
    for path, size in sorted(files, key=lambda f: (f[0].rsplit("/", 1)[1], f[0])):
        want[path], before = before // 1000, before + size
    got = archive.batches_in_order(spark.createDataFrame(files, "path string, length long"), 1000)
    assert {r.path: r.batch for r in got.collect()} == want
    for name in ("b.zip", "a.tgz", "c.txt"):
        (tmp_path / name).write_bytes(b"123")
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in archive.archives(spark, str(tmp_path)).collect()) == [("a.tgz", 3), ("b.zip", 3)]


def test_numbers_of_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, F.concat(F.lit("r"), F.col("id") % 7)).alias("by"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("x"), "id")
    got = timegrid.renumber(df, "by", ["x", "id"], 7).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.by, []).append((r.x, r.id, r.no))
    assert len(got) == 3000 and None in groups
    assert all([n for *_, n in sorted(g)] == list(range(1, len(g) + 1)) for g in groups.values())
    assert timegrid.renumber(df.where("false"), "by", ["x"]).count() == 0


def _percentile(v, p):
    pos = (len(v) - 1) * p
    lo = int(pos)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (v[hi] - v[lo]) * (pos - lo)


@pytest.mark.parametrize("per_e,parts", [(64, 1 << 16), (1, 2)])
def test_percentiles_of_any_group(spark, monkeypatch, per_e, parts):
    monkeypatch.setattr(quantiles, "PER_E", per_e)
    monkeypatch.setattr(quantiles, "PARTS", parts)
    rng = random.Random(7)
    groups = {"one": [3.0], "two": [1.0, 2.0], "even": [1.0, 2.0, 10.0, 20.0], "same": [5.0] * 50, "zero": [0.0, -0.0, 0.0, 1e-300], "huge": [-1e308, 1e308, 0.0, 1.5], "close": [1 + k * 1e-13 for k in range(200)], None: [float(rng.randint(-5, 5)) for _ in range(300)], "mixed": [rng.gauss(0, 10 ** rng.randint(-8, 8)) for _ in range(500)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, value double").repartition(5)
    at = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0, "upper": quantiles.UPPER_MEDIAN}
    got = {r.g: r for r in quantiles.percentiles(quantiles.counted(df, ["g"]), ["g"], at).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        v = sorted(vs)
        for name, p in at.items():
            want = v[len(v) // 2] if p == "upper" else _percentile(v, p)
            assert got[g][name] == pytest.approx(want, rel=1e-12, abs=1e-300), (g, name)


def test_approximate_percentiles(spark):
    rows = [(s, "R", "E", m, m, 60, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), float(k)) for s in ("A", "B") for m in ("68", "23", "26", "384", "385") for k in range(1001)]
    df = spark.createDataFrame(rows, "sn string, resource string, element string, metric_id string, metric string, scrape_interval int, ts timestamp, value double")
    exact, near = ({tuple(r[:2]): r for r in stats.stats(df, ["sn", "metric"], approx=x).collect()} for x in (False, True))
    for k, r in exact.items():
        assert (near[k]["max"], near[k]["min"], near[k]["avg"], near[k]["n"]) == (r["max"], r["min"], r["avg"], r["n"]) == (1000.0, 0.0, 500.0, 1001)
        assert (r["median"], r["p95"]) == (500.0, 950.0) and abs(near[k]["median"] - 500) <= 2 and abs(near[k]["p95"] - 950) <= 2
    assert abs(stats.pct(df, ["sn"], 0.9, True).first().value - 900) <= 2 and abs(stats.upper_median(df, ["sn"], True).first().value - 500) <= 2
    for report in (reports.performance_stats, reports.day_night_report, reports.array_summary, reports.period_report, reports.rw_ratio_report, reports.threshold_report, reports.outliers, stats.bandwidth_total):
        assert report(df, approx=True).columns == report(df).columns
    assert reports.compare_arrays(df, "A", "B", approx=True).where("avg_1 <> avg_2").count() == 0
    assert stats.query_range(df, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), 60, approx=True).where("n <> 1001").count() == 0


@pytest.fixture(params=["America/New_York", "Asia/Tokyo"])
def elsewhere(spark, request):
    before, zone = os.environ.get("TZ"), spark.conf.get("spark.sql.session.timeZone")
    os.environ["TZ"] = request.param
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_moments_are_utc_everywhere(spark, elsewhere):
    rows = [("23", 0), ("26", 0), ("23", 6 * 3600), ("26", 6 * 3600 + 1), ("68", 86399), ("68", 86400)]
    df = spark.createDataFrame([(m, s) for m, s in rows], "metric_id string, s long").select(F.lit("A").alias("sn"), F.lit("R").alias("resource"), F.lit("E").alias("element"), "metric_id", F.col("metric_id").alias("metric"), F.lit(60).alias("scrape_interval"), F.timestamp_seconds(F.lit(1704844800) + F.col("s")).alias("ts"), (F.col("s") + 1.0).alias("value"))
    df = df.withColumn("dt", select.utc_date(F.col("ts")))  # 2024-01-10 and the first second of the 11th
    assert {str(r.dt) for r in df.select(F.col("dt").cast("string").alias("dt")).collect()} == {"2024-01-10", "2024-01-11"}
    n = lambda *a, **k: select.between(df, *a, **k).count()
    assert n("2024-01-10T03:00:00+03:00", "2024-01-10T00:00:00Z") == 2 and n("2024-01-09T19:00:00-05:00", dt.datetime(2024, 1, 10)) == 2
    assert n("2024-01-10T01:00:00+03:00") == 6 and n(None, "2024-01-11T09:00:00+09:00") == 6 and n("now-1d", None, now=dt.datetime(2024, 1, 11, tzinfo=dt.timezone.utc)) == 6
    assert {r.v for r in df.select(select.daypart(F.col("ts")).alias("v"), "ts").where("metric_id = '23'").collect()} == {"night", "day"}
    assert stats.bandwidth_total(df, dt.datetime(2024, 1, 10, 1), dt.datetime(2024, 1, 10, 6)).first().max_total == 21602.0  # the write of 06:00:01 is not in
    assert stats.bandwidth_total(df, dt.datetime(2024, 1, 10, 1), dt.datetime(2024, 1, 10, 6, 0, 1)).first().max_total == 43203.0
    r = timegrid.available_range(df, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 0, 0, 0), dt.datetime(2024, 1, 12)).select(F.unix_seconds("start_ts").alias("s"), "available").first()
    assert tuple(r) == (1704844800, True)
    assert timegrid.step_grid(df, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 6), 3600).count() == 3
    assert stats.last_value(df, dt.datetime(2024, 1, 10, 23, 59, 59)).where("metric_id = '68'").first().value == 86400.0
    spans = spark.range(1).select(F.unix_seconds(timegrid.effective_date(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp"), dt.datetime(1970, 1, 1))).alias("s"))
    assert spans.first().s == 0


def test_day_predicates_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("A", "E", "m", dt.datetime(2024, 1, d, 1), 1.0) for d in range(1, 9)], "sn string, element string, metric string, ts timestamp, value double")
    df.withColumn("dt", select.utc_date(F.col("ts"))).write.partitionBy("dt").parquet(str(tmp_path / "p"))
    p = spark.read.parquet(str(tmp_path / "p"))
    files = lambda q: q._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1].split("PushedFilters")[0]
    for q in (timegrid.step_grid(p, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4), 60), timegrid.step_grid(p, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4), 60, 7200), stats.last_value(p, dt.datetime(2024, 1, 4)), stats.query_range(p, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4), 60)):
        assert "dt" in files(q)
    assert timegrid.step_grid(p, dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 4, 2), 3600).count() == 2


def test_nulls_are_lost_nowhere(spark):
    archives = spark.createDataFrame([("S1",), ("S2",), (None,), ("UNKNOWN_1",)], "sn string")
    have = spark.createDataFrame([("S1",), ("UNKNOWN_1",), (None,)], "sn string")
    assert {r.sn for r in joins.skip_existing(archives, have).collect()} == {"S2", None, "UNKNOWN_1"}
    points = spark.createDataFrame([("22", "unknown_metric_22"), ("9", "unknown_metric_9"), ("22", None), (None, "x"), ("22", "other")], "metric_id string, metric string")
    new = sorted((r.metric_id or "", r.metric or "") for r in joins.rename_unknown(points, metric_dim(spark), True).collect())
    assert new == [("", "x"), ("22", ""), ("22", "other"), ("22", "throughput_iopsio_s"), ("9", "unknown_metric_9")]
    assert joins.rename_unknown(points, metric_dim(spark)).count() == 6
