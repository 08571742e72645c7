"""Statistics over points."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SERIES
from . import quantiles
from .select import as_column, in_days, present


def series_of(df: DataFrame) -> list[str]:
    return [c for c in SERIES if c in df.columns]


def label_values(df: DataFrame, label: str, **equal) -> DataFrame:
    """Distinct values of a label, within a selector."""
    from .select import select_labels

    return select_labels(df, **equal).select(label).where(F.col(label).isNotNull()).distinct()


def series(df: DataFrame) -> DataFrame:
    """The catalog of series."""
    return df.select(*series_of(df)).distinct()


def series_count(df: DataFrame) -> DataFrame:
    """Series of each metric."""
    return series(df).groupBy("metric").agg(F.count("*").alias("n_series"))


def metrics_by_resource(df: DataFrame, sn: str | None = None, at=None) -> DataFrame:
    """D3: for each resource the points and the sorted metric names, of one array or time if given."""
    from .select import between, select_labels

    kept = select_labels(df, sn=sn)
    kept = between(kept, at, at) if at is not None else kept
    return kept.groupBy("resource").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("metric")), ",").alias("metrics"))


def upper_median(df: DataFrame, by: list[str], approx: bool = False) -> DataFrame:
    """The upper middle of each group's sorted values."""
    return pct(df, by, quantiles.UPPER_MEDIAN, approx)


#: What ``stats`` gives beside counts and means.
MIDDLES = {"median": 0.5, "p95": 0.95}


def stats(df: DataFrame, by: list[str], divisor: Column | None = None, digits: int = 2, approx: bool = False, middles: dict | None = None) -> DataFrame:
    """Max, min, avg, median, p95 (or the ``middles`` asked for) and count of present samples; the divisor comes first. No group meets in one task. With
    ``approx`` percentiles come from sketches, without interpolation."""
    middles = MIDDLES if middles is None else middles
    rows = df if divisor is None else df.withColumn("value", F.col("value") / divisor)
    if approx:
        v = F.col("value")
        whole = present(rows).groupBy(*by).agg(F.max(v).alias("max"), F.min(v).alias("min"), F.avg(v).alias("avg"), F.count(v).alias("n"))
        found = quantiles.approximate(rows, by, middles)
    else:
        counts = quantiles.counted(rows, by)
        whole = counts.groupBy(*by).agg(F.max("v").alias("max"), F.min("v").alias("min"), (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("avg"), F.sum("n").alias("n"))
        found = quantiles.percentiles(counts, by, middles)
    out = quantiles.joined(whole, found, by)
    return out.select(*by, *(F.round(c, digits).alias(c) for c in ("max", "min", "avg", *middles)), "n")


def pct(df: DataFrame, by: list[str], p: float | str, approx: bool = False) -> DataFrame:
    """The interpolated percentile of each group."""
    at = {"value": p}
    return quantiles.approximate(df, by, at) if approx else quantiles.percentiles(quantiles.counted(df, by), by, at)


def max_over_time(df: DataFrame, by: list[str]) -> DataFrame:
    """The maximum of each series, then of all."""
    return present(df).groupBy(*series_of(df)).agg(F.max("value").alias("value")).groupBy(*by).agg(F.max("value").alias("value"))


def quantile_over_time(df: DataFrame, by: list[str], phi: float, approx: bool = False) -> DataFrame:
    """The quantile of each series, then the largest."""
    return pct(df, series_of(df), phi, approx).groupBy(*by).agg(F.max("value").alias("value"))


def avg_over_time(df: DataFrame) -> DataFrame:
    """D10."""
    return present(df).groupBy(*series_of(df)).agg(F.avg("value").alias("value"))


def add_series(a: DataFrame, b: DataFrame, keys=("sn", "resource", "element", "scrape_interval")) -> DataFrame:
    """Sum of two metrics' values of equal labels (one row each)."""
    x, y = a.select(*keys, F.col("value").alias("va")), b.select(*keys, F.col("value").alias("vb"))
    return x.join(y, list(keys)).select(*keys, (F.col("va") + F.col("vb")).alias("value"))


def bandwidth_total(df: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None, approx: bool = False) -> DataFrame:
    """For each array the most that one controller reached: greatest read plus greatest write, and the same of medians. With ``start`` and ``end`` the window is that of whole days back
    from the end: (end - n days, end], n one more than the whole days between."""
    if start is not None and end is not None:
        after, to = as_column(end - dt.timedelta(days=(end - start).days + 1)), as_column(end)
        df = in_days(df.where((F.col("ts") > after) & (F.col("ts") <= to)), after, to)
    keys = ["sn", "resource", "element", "scrape_interval"]
    kinds = df.where(F.col("metric_id").isin("23", "26")).select(*keys, (F.col("metric_id") == "23").alias("read"), "value")
    each = stats(kinds, [*keys, "read"], digits=15, approx=approx, middles={"middle": 0.5})
    one = lambda c, read: F.max(F.when(F.col("read") == read, F.col(c)))
    sums = each.groupBy(*keys).agg((one("max", True) + one("max", False)).alias("most"), (one("middle", True) + one("middle", False)).alias("middle"))
    return sums.groupBy("sn").agg(F.max("most").alias("max_total"), F.max("middle").alias("median_total"))


def time_range(df: DataFrame) -> DataFrame:
    """First and last moment of each array, in milliseconds."""
    return df.groupBy("sn").agg(F.unix_millis(F.min("ts")).alias("first_ms"), F.unix_millis(F.max("ts")).alias("last_ms"))


def arrays_metadata(df: DataFrame) -> DataFrame:
    """Arrays with their collection interval (the least that occurs)."""
    from ..functions.names import interval_label

    return df.groupBy("sn").agg(F.min("scrape_interval").alias("scrape_interval")).withColumn("label", interval_label(F.col("scrape_interval")))


def last_value(df: DataFrame, at=None, lookback: Column | None = None, keys: list[str] | None = None) -> DataFrame:
    """The last sample of each series, not after ``at`` (a datetime or column) nor older than ``lookback`` (an interval; None: unlimited)."""
    rows = present(df)
    if at is not None:
        at = as_column(at)
        rows = in_days(rows.where(F.col("ts") <= at), None, at)
        if lookback is not None:
            rows = in_days(rows.where(F.col("ts") > at - lookback), at - lookback)
    return rows.groupBy(*(keys or series_of(df))).agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))


def query_range(df: DataFrame, start, end, step: int, digits: int = 2, approx: bool = False) -> DataFrame:
    """Of each series over a step grid: count, first, last and statistics."""
    from .timegrid import step_grid

    grid, keys = step_grid(df, start, end, step), series_of(df)
    ends = grid.groupBy(*keys).agg(F.min_by("value", "ts").alias("first"), F.max_by("value", "ts").alias("last"))
    return quantiles.joined(ends, stats(grid, keys, digits=digits, approx=approx), keys)
