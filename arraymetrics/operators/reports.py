"""Reports over all arrays at once: one pass each, joined with the small table of KPIs. With ``approx`` percentiles take bounded memory for each group."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import threshold_check
from ..model import KPIS, kpi_dim, threshold_dim
from .quantiles import UPPER_MEDIAN, joined
from .select import between, daypart, present, select_labels, time_of_day
from .stats import bandwidth_total, pct, stats
from .timegrid import step_grid

#: Parts of an array and metric whose outliers are ranked apart first.
LANES = 32
PERFORMANCE = ("cpu", "bandwidth_read", "bandwidth_write", "latency_read", "latency_write", "iops_read", "iops_write")


def kpi_points(df: DataFrame, kpis=None) -> DataFrame:
    """Present points of KPIs with the report's divisor applied. The KPI table holds nine rows."""
    dim = kpi_dim(df.sparkSession)
    dim = dim.where(F.col("kpi").isin(*kpis)) if kpis else dim
    return present(df).join(F.broadcast(dim), "metric_id").withColumn("value", F.col("value") / F.col("divisor"))


def array_summary(df: DataFrame, sn: str | None = None, digits: int = 2, approx: bool = False, reference: dt.datetime | None = None, lookback: int = 180, step: int = 3600) -> DataFrame:
    """For each array and KPI the statistics, with the array's resources, metrics and extent. With ``reference`` the statistics are those of the ``lookback``
    days before it, on a grid of ``step`` seconds; extent and counts are of all points."""
    rows = select_labels(df, sn=sn)
    whole = rows.groupBy("sn").agg(F.count_distinct("resource").alias("n_resources"), F.count_distinct("metric_id").alias("n_metrics"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    kept = rows if reference is None else gridded(rows, reference - dt.timedelta(days=lookback), reference, step)
    return joined(stats(kpi_points(kept), ["sn", "kpi", "unit"], digits=digits, approx=approx), whole, ["sn"])


def gridded(df: DataFrame, start, end, step: int) -> DataFrame:
    """The last sample of each series in each step of the KPIs' metrics."""
    ids = [m for _, m, _, _ in KPIS]
    return step_grid(df.where(F.col("metric_id").isin(ids)), start, end, step)


def performance_stats(df: DataFrame, sn: str | None = None, start=None, end=None, period: str = "all", digits: int = 2, approx: bool = False) -> DataFrame:
    """Statistics of seven KPIs of each array, at a time of day if asked."""
    rows = time_of_day(between(select_labels(df, sn=sn), start, end), period)
    return stats(kpi_points(rows, PERFORMANCE), ["sn", "kpi", "unit"], digits=digits, approx=approx)


def to_wide(df: DataFrame, ids: list[str], fill: str = "0") -> DataFrame:
    """A row for each array, resource, element and moment, a column for each metric id. The explicit list spares a job."""
    out = df.groupBy("sn", "resource_id", "element", "ts").pivot("metric_id", ids).agg(F.max("value"))
    return out.select("sn", "resource_id", "element", "ts", *(F.coalesce(F.col(f"`{i}`").cast("string"), F.lit(fill)).alias(f"m{i}") for i in ids))


def day_night_report(df: DataFrame, sn: str | None = None, start=None, end=None, digits: int = 2, approx: bool = False) -> DataFrame:
    """Max, p95 and upper median by day and night."""
    kpis = ("bandwidth_read", "bandwidth_write", "latency_read", "latency_write", "cpu")
    rows = kpi_points(between(select_labels(df, sn=sn), start, end), kpis).withColumn("daypart", daypart(F.col("ts")))
    return stats(rows, ["sn", "kpi", "daypart"], digits=digits, approx=approx, middles={"p95": 0.95, "median": UPPER_MEDIAN}).select("sn", "kpi", "daypart", "max", "p95", "median")


def period_report(df: DataFrame, sn: str | None = None, start=None, end=None, digits: int = 2, approx: bool = False) -> DataFrame:
    """Whole-period bandwidth of the busiest controller, latencies and cpu; ``available`` is false if all are missing."""
    rows = between(select_labels(df, sn=sn), start, end)
    band = bandwidth_total(rows, approx=approx)
    names = ("latency_read", "latency_write", "cpu")
    each = stats(kpi_points(rows, names), ["sn", "kpi"], digits=digits, approx=approx, middles={"p95": 0.95})
    v = lambda k, c: F.max(F.when(F.col("kpi") == k, F.col(c))).alias(f"{k}_{c}")
    kpis = each.groupBy("sn").agg(*(v(k, c) for k in names for c in ("max", "p95")))
    out = rows.select("sn").distinct().join(band, "sn", "left").join(kpis, "sn", "left")
    values = [c for c in out.columns if c != "sn"]
    out = out.withColumn("max_total", F.round("max_total", digits)).withColumn("median_total", F.round("median_total", digits))
    return out.withColumn("available", F.coalesce(*values).isNotNull())


def compare_arrays(df: DataFrame, sn1: str, sn2: str, start=None, end=None, digits: int = 2, approx: bool = False) -> DataFrame:
    """C4: averages of two arrays by KPI and the difference in percent of the first; null on a zero base."""
    rows = kpi_points(between(df.where(F.col("sn").isin(sn1, sn2)), start, end), PERFORMANCE)
    each = stats(rows, ["kpi", "sn"], digits=15, approx=approx, middles={"p95": 0.95})
    one = lambda sn, c, n: F.max(F.when(F.col("sn") == sn, F.col(c))).alias(f"{c}_{n}")
    both = each.groupBy("kpi").agg(*(one(sn, c, n) for n, sn in ((1, sn1), (2, sn2)) for c in ("avg", "p95")))
    diff = lambda k: F.round(100 * (F.col(f"{k}_2") - F.col(f"{k}_1")) / F.nullif(F.col(f"{k}_1"), F.lit(0.0)), 1).alias(f"{k}_diff_percent")
    return both.select("kpi", *(F.round(c, digits).alias(c) for c in ("avg_1", "avg_2", "p95_1", "p95_2")), diff("avg"), diff("p95"))


def top_loaded(df: DataFrame, kpi: str, n: int = 10, start=None, end=None, digits: int = 2, approx: bool = False, step: int | None = None) -> DataFrame:
    """G1: arrays by p95 of a KPI, on a grid of ``step`` seconds from ``start`` to ``end`` if given (3600 is usual); a zero or absent p95 counts as the maximum, then as 0."""
    rows = between(df, start, end) if step is None else gridded(df, start, end, step)
    found = stats(kpi_points(rows, (kpi,)), ["sn"], digits=digits, approx=approx)
    load = F.coalesce(F.nullif(F.col("p95"), F.lit(0.0)), F.nullif(F.col("max"), F.lit(0.0)), F.lit(0.0))
    return found.withColumn("load", load).orderBy(F.desc("load"), "sn").limit(n)


def outliers(df: DataFrame, multiplier: float = 1.5, top: int | None = 50, approx: bool = False) -> DataFrame:
    """Samples above ``multiplier`` times the p95 of their array and metric, the highest ``top`` of each with the count of all.

    The p95 is joined back rather than windowed over: points are not sorted by array. What is found is ranked and counted in LANES for each array and
    metric first, of which the best of each are ranked again."""
    keys = ["sn", "metric_id"]
    limits = pct(df, keys, 0.95, approx).withColumnRenamed("value", "p95")
    found = joined(present(df), limits, keys).where(F.col("value") > F.col("p95") * multiplier)
    order = [F.desc("value"), "ts", "element"]
    lane = Window.partitionBy(*keys, "_lane")
    local = found.withColumn("_lane", F.pmod(F.xxhash64("ts", "element"), F.lit(LANES))).withColumn("_r", F.row_number().over(lane.orderBy(*order))).withColumn("_n", F.count("*").over(lane))
    local = local.where(F.col("_r") <= top) if top else local
    whole = Window.partitionBy(*keys)
    ranked = local.withColumn("rank", F.row_number().over(whole.orderBy(*order))).withColumn("n_outliers", F.sum(F.when(F.col("_r") == 1, F.col("_n"))).over(whole))
    ranked = ranked.where(F.col("rank") <= top) if top else ranked
    return ranked.select("sn", "metric_id", "element", "ts", "value", F.round("p95", 9).alias("p95"), "rank", "n_outliers")


def rw_ratio_report(df: DataFrame, read_id: str = "265", heavy: float = 60.0, light: float = 40.0, digits: int = 2, approx: bool = False) -> DataFrame:
    """Distribution of the share of reads, and the class of the workload."""
    own = present(df).where(F.col("metric_id") == read_id)
    span = own.groupBy("sn").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count_distinct("element").alias("n_controllers"))
    rows = joined(stats(own, ["sn"], digits=15, approx=approx, middles={"m": 0.5, "q": 0.75, "p": 0.95}), span, ["sn"])
    days = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 86_400_000_000
    kind = F.when(F.col("m") >= heavy, "read").when(F.col("m") <= light, "write").otherwise("mixed")
    return rows.select(
        "sn", F.round("m", digits).alias("read_median"), F.round("q", digits).alias("read_p75"), F.round("p", digits).alias("read_p95"), F.round(100 - F.col("m"), digits).alias("write_median"),
        "first_ts", "last_ts", F.round(days, digits).alias("days"), "n_controllers", kind.alias("workload"), F.when(days >= 7, "full").otherwise("partial").alias("coverage"),
    )


def rw_class_distribution(report: DataFrame) -> DataFrame:
    return report.groupBy("workload").agg(F.count("*").alias("n_arrays"))


def compare_picks(df: DataFrame, picks: DataFrame, digits: int = 2, approx: bool = False) -> DataFrame:
    """Statistics of up to a few picks (pick, resource, element, metric) side by side."""
    keys = ["pick", "sn", "resource", "element", "metric"]
    return stats(df.join(picks, ["resource", "element", "metric"]), keys, digits=digits, approx=approx, middles={"p95": 0.95}).select(*keys, "p95", "avg", "min", "max")


def threshold_report(df: DataFrame, growth: float = 0.3, digits: int = 2, approx: bool = False) -> DataFrame:
    """the p95 of KPIs against the limits of the array's model, or the default's."""
    dim = threshold_dim(df.sparkSession)
    own = dim.where("model <> '_default'").select(F.col("model").alias("sn"), "kpi", F.col("warning").alias("_w"), F.col("critical").alias("_c"))
    base = dim.where("model = '_default'").select("kpi", "warning", "critical")
    rows = pct(kpi_points(df), ["sn", "kpi"], 0.95, approx).withColumnRenamed("value", "p95")
    out = rows.join(F.broadcast(base), "kpi").join(F.broadcast(own), ["sn", "kpi"], "left")
    w, c = F.coalesce("_w", "warning"), F.coalesce("_c", "critical")
    return out.select("sn", "kpi", F.round("p95", digits).alias("p95"), w.alias("warning"), c.alias("critical"), threshold_check(F.round("p95", digits), w, c, growth).alias("outcome"))
