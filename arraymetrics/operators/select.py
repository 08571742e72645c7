"""Selection of points."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import utc_date, utc_hour, utc_moment

SHORT_LIST = 1000
#: The resources that are read by default.
DEFAULT_RESOURCES = ["207", "212", "225", "216", "266", "10", "11", "21"]
#: The metrics that are read by default.
DEFAULT_METRICS = [
    "18", "22", "25", "28", "23", "26", "1079", "1073", "627", "1074", "240", "1158", "1154", "1162", "1166", "1170", "1174", "1332", "1333", "1334", "1335",
    "1337", "1338", "1633", "260", "261", "262", "1298", "1297", "68", "1299", "1182", "33", "34", "35", "36", "37", "1183", "1184", "44", "45", "46", "47", "48",
    "1185", "1188", "93", "95", "333", "384", "385", "24", "27", "228", "369", "808", "812", "813", "1075",
]
#: The metrics that the direct load reads by default.
LOAD_METRICS = DEFAULT_METRICS[:17]


def select_ids(df: DataFrame, resources=None, metrics=None, include_unknown: bool = True, dims: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """B1: allow-lists of resource and metric ids (None: all). Without ``include_unknown`` ids that the dictionaries (resource,
    metric) lack go too. Apply it before points are exploded."""
    for col, ids in (("resource_id", resources), ("metric_id", metrics)):
        if ids is not None and len(ids) <= SHORT_LIST:
            df = df.where(F.col(col).isin(list(ids)))
        elif ids is not None:
            df = df.join(df.sparkSession.createDataFrame([(i,) for i in set(ids)], f"{col} string"), col, "left_semi")
    if not include_unknown and dims is not None:
        df = df.join(dims[0].select("resource_id"), "resource_id", "left_semi").join(dims[1].select("metric_id"), "metric_id", "left_semi")
    return df


def invalid_ids(requested: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Requested ids that the dictionary lacks."""
    return requested.join(dim.select(key), key, "left_anti")


def select_wide(df: DataFrame, wide: DataFrame) -> DataFrame:
    """Points whose resource exports their metric."""
    return df.join(wide.select("resource_id", "metric_id"), ["resource_id", "metric_id"], "left_semi")


def select_labels(df: DataFrame, **equal) -> DataFrame:
    """Equality on any label; a None is no condition."""
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def match_labels(df: DataFrame, **patterns: str) -> DataFrame:
    """Fully anchored patterns; ``.+`` also asks that the label is there."""
    for name, pattern in patterns.items():
        df = df.where(F.col(name).rlike(f"\\A(?:{pattern})\\z") & F.col(name).isNotNull())
    return df


def _utc(at: dt.datetime) -> dt.datetime:
    return at.astimezone(dt.timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def moment(text, now: dt.datetime) -> dt.datetime:
    """A time given as datetime, ISO text, ``now`` or ``now-<n><m|h|d|w>``, in UTC; without an offset it is UTC. A bad number means now, an unknown unit no offset."""
    if isinstance(text, dt.datetime):
        return _utc(text)
    if not text.startswith("now"):
        return _utc(dt.datetime.fromisoformat(text))
    now = _utc(now)
    m = re.fullmatch(r"now-(\d+)(\w)", text.strip())
    if not m:
        return now
    unit = {"m": "minutes", "h": "hours", "d": "days", "w": "weeks"}.get(m[2])
    return now - dt.timedelta(**{unit: int(m[1])}) if unit else now


def as_column(at) -> Column:
    """A moment as a column: columns stay, datetimes without an offset are UTC whatever the zones of host and session are."""
    return at if isinstance(at, Column) else utc_moment(_utc(at))


def in_days(df: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Where there is a ``dt`` partition column, the days from one moment to another, so that whole partitions are left out."""
    for at, keep in ((first, lambda d: F.col("dt") >= d), (last, lambda d: F.col("dt") <= d)):
        if at is not None and "dt" in df.columns:
            df = df.where(keep(utc_date(at)))
    return df


def between(df: DataFrame, start=None, end=None, now: dt.datetime | None = None) -> DataFrame:
    """Points of [start, end]; where there is a ``dt`` partition column, whole days are pruned as well."""
    now = now or dt.datetime.now(dt.timezone.utc)
    lo, hi = (None if x is None else utc_moment(moment(x, now)) for x in (start, end))
    for at, keep in ((lo, lambda c: F.col("ts") >= c), (hi, lambda c: F.col("ts") <= c)):
        if at is not None:
            df = df.where(keep(at))
    return in_days(df, lo, hi)


def daypart(ts: Column) -> Column:
    """``day`` from 05:00 to 18:59 UTC, else ``night``."""
    return F.when(utc_hour(ts).between(5, 18), "day").otherwise("night")


def time_of_day(df: DataFrame, period: str = "all") -> DataFrame:
    """B9."""
    return df if period == "all" else df.where(daypart(F.col("ts")) == period)


def present(df: DataFrame) -> DataFrame:
    """Without missing samples."""
    return df.where(F.col("value").isNotNull() & ~F.isnan("value"))


def nonzero(df: DataFrame) -> DataFrame:
    """B11."""
    return df.where(F.col("value") > 0)


def search_metrics(df: DataFrame, word: str) -> DataFrame:
    """Metric names that hold a word."""
    return df.where(F.lower("metric").contains(word.lower())).select("metric").distinct()


def lookup(df: DataFrame, resource_id: str, metric_id: str, element: str, at) -> DataFrame:
    """One point."""
    return between(select_labels(df, resource_id=resource_id, metric_id=metric_id, element=element), at, at)
