import datetime as dt

import pytest
from pyspark.sql import functions as F

from arraymetrics.functions import names, rules
from arraymetrics.operators import quantiles, coverage, stats, timegrid


def _one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("Read I/O Granularity Distribution: [128K,+∞)(%)", "read_i_o_granularity_distribution_128kinfpercent"),
        ("Avg. Read I/O Response Time(us)", "avg_read_i_o_response_timeus"),
        ("Avg. CPU usage (%)", "avg_cpu_usage_percent"),
        ("UNKNOWN_METRIC_1212", "unknown_metric_1212"),
    ],
)
def test_sanitise(spark, name, want):
    assert _one(spark, names.sanitise(F.lit(name))) == want
    assert _one(spark, names.sanitise(F.lit(want))) == want


def test_file_fields_labels_and_slots(spark):
    x = _one(spark, names.file_fields(F.lit("/a/PerfData_Model6000_SN_2102355THQFSQ2100014_SP0_0_20251020000400.tgz")))
    assert (x.model, x.sn, x.sp, x.dumped) == ("Model6000", "2102355THQFSQ2100014", 0, dt.datetime(2025, 10, 20, 0, 4))
    assert [_one(spark, names.interval_label(F.lit(s))) for s in (5, 60, 300, 5400)] == ["5s", "1m", "5m", "1h"]
    assert _one(spark, names.conversion(F.lit(1 / 1024))) == "×1024"
    assert names.header_text("[0K,4K) [128K,+∞)") == "[0K_4K) [128K_+8)"


def test_weeks_and_medians(spark):
    week = lambda d: tuple(str(_one(spark, c))[:10] for c in timegrid.last_full_week(F.lit(d).cast("timestamp")))
    assert week("2025-10-02") == ("2025-09-22", "2025-09-28") and week("2025-09-28") == ("2025-09-15", "2025-09-21")
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 10, 20)], "value double")
    at = {"u": quantiles.UPPER_MEDIAN, "m": 0.5, "p": 0.95}
    df = df.withColumn("g", F.lit(1))
    r = quantiles.percentiles(quantiles.counted(df, ["g"]), ["g"], at).select("u", "m", F.round("p", 9).alias("p")).first()
    assert (r.u, r.m, r.p) == (10, 6, 18.5)


def test_rules(spark):
    check = lambda v: _one(spark, rules.threshold_check(F.lit(float(v)), F.lit(1584.0), F.lit(1980.0)))
    assert [check(v) for v in (1239, 2405, 1600, 1000, 1900)] == ["forecast_warning", "critical", "forecast_critical", "passed", "forecast_critical"]
    n = F.lit(None).cast("double")
    assert _one(spark, rules.disk_status(n, n, n, n, n)) == "healthy" and _one(spark, rules.bbu_status(F.lit(41.0), n)) == "warning"


def test_coverage_of_empty_tables(spark):
    none = spark.createDataFrame([], "resource string, metric string")
    some = spark.createDataFrame([("r", "read_iops")], "resource string, metric string")
    assert [r.status for r in coverage.coverage(none, some).collect()] == ["extra"]
    assert coverage.suggest(some, none).count() == 0
