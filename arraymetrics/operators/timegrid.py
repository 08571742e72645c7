"""Step grids, weeks and periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .select import as_column, in_days, present


def step_grid(df: DataFrame, start, end, step: int, lookback: int | None = None) -> DataFrame:
    """The last sample of each series in (start + (k - 1) step, start + k step], stamped with the end; a sample at the very start
    falls in bucket 0; an empty bucket gives no row. A sample counts for every step that comes within ``lookback`` seconds after it (None: one step), those before
    ``start`` too if it is longer than a step. Bounds are datetimes (UTC without an offset) or columns."""
    from .stats import series_of

    start, end = as_column(start), as_column(end)
    df = in_days(df, start - F.make_dt_interval(secs=F.lit(max(0, lookback or 0))), end)
    micros = F.unix_micros("ts") - F.unix_micros(start)
    k = F.ceil(micros / F.lit(step * 1_000_000))
    rows = present(df)
    if lookback is None or lookback <= step:
        rows = rows.where((F.col("ts") >= start) & (F.col("ts") <= end)).withColumn("bucket", k)
        if lookback is not None:
            rows = rows.where(F.col("bucket") * (step * 1_000_000) - micros < lookback * 1_000_000)
    else:
        last = F.ceil((micros + lookback * 1_000_000) / F.lit(step * 1_000_000)) - 1
        most = F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(step * 1_000_000))
        rows = rows.where((F.col("ts") > start - F.make_dt_interval(secs=F.lit(lookback))) & (F.col("ts") <= end)).withColumn("_from", F.greatest(k, F.lit(0))).withColumn("_to", F.least(last, most))
        rows = rows.where("_from <= _to").withColumn("bucket", F.explode(F.sequence("_from", "_to")))
    keys = series_of(df)
    return rows.groupBy(*keys, "bucket").agg(F.max_by("value", "ts").alias("value")).select(*keys, F.timestamp_micros(F.unix_micros(start) + F.col("bucket") * (step * 1_000_000)).alias("ts"), "value")


#: E3, fixed values: longest period in days and the step in seconds; None: any longer.
LADDERS = {
    "performance": [(14, 300), (45, 600), (None, 3600)],
    "outliers": [(7, 300), (30, 900), (90, 3600), (None, 21600)],
    "report": [(45, 300), (None, 600)],
    "rw_ratio": [(14, 60), (None, 300)],
}


def adaptive_step(days: Column, ladder: str) -> Column:
    out = F.lit(LADDERS[ladder][-1][1])
    for limit, step in reversed(LADDERS[ladder][:-1]):
        out = F.when(days <= limit, F.lit(step)).otherwise(out)
    return out


def last_full_week(at: Column) -> tuple[Column, Column]:
    """Monday 00:00:00 and Sunday 23:59:59 of the last week that is over; on a Sunday the week before."""
    day = F.floor(F.unix_seconds(at) / 86_400)
    start = F.timestamp_seconds((day - F.pmod(day + 3, F.lit(7)) - 7) * 86_400)  # day 0 was a Thursday
    return start, start + F.expr("INTERVAL '6 23:59:59' DAY TO SECOND")


def effective_date(last: Column, reference: Column, now: dt.datetime) -> Column:
    """E5: the earlier of both, whichever exists, else now."""
    return F.coalesce(F.least(last, reference), as_column(now))


def last_datapoint(df: DataFrame) -> DataFrame:
    """E6."""
    return df.groupBy("sn").agg(F.max("ts").alias("last_ts"))


def data_period(df: DataFrame, metric_id: str, start, end) -> DataFrame:
    """What a window really holds of a metric: first, last and days between."""
    from .select import between

    span = between(present(df).where(F.col("metric_id") == metric_id), start, end).groupBy("sn").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return span.withColumn("days", (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 86_400_000_000)


def available_range(df: DataFrame, start: dt.datetime, end: dt.datetime, reference: dt.datetime) -> DataFrame:
    """The preferred window where an array has data in it, else up to 7 days before the last point of the 180 days up to the
    reference and 30 after; ``available`` is false where neither has data."""
    start, end = as_column(start), as_column(end)
    inside = F.col("ts").between(start, end)
    near = F.col("ts").between(as_column(reference - dt.timedelta(days=180)), as_column(reference + dt.timedelta(days=30)))
    one = df.groupBy("sn").agg(F.count_if(inside).alias("n"), F.max(F.when(near, F.col("ts"))).alias("hi"), F.min(F.when(near, F.col("ts"))).alias("lo"))
    return one.select(
        "sn",
        F.when(F.col("n") > 0, start).otherwise(F.greatest(F.col("lo"), F.col("hi") - F.expr("INTERVAL 7 DAYS"))).alias("start_ts"),
        F.when(F.col("n") > 0, end).otherwise(F.col("hi")).alias("end_ts"),
        ((F.col("n") > 0) | F.col("hi").isNotNull()).alias("available"),
    )


def renumber(df: DataFrame, by: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Running numbers from 1 in each group of ``by``, in ``order``.

    Rows are dealt by range and sorted, once, into a written table that keeps each one's part and place. A row's number is its place less that
    of the group's first row in the part, plus the group's rows in earlier parts, which come from a table with a row for each part and group. No
    group meets in one task, and numbers don't change when executors are lost, as nothing is dealt twice.
    """
    from pyspark.sql import Window

    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, by, *order).sortWithinPartitions(by, *order)
    dealt = written(dealt.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))  # the id's high bits number the part
    counts = dealt.groupBy(by, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = counts.select(F.col(by).alias("_by"), F.col("_part").alias("_of"), (before - F.col("_first") + 1).alias("_shift"))
    both = dealt.join(shift, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_of")))
    return both.withColumn("no", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_by", "_of", "_shift")
