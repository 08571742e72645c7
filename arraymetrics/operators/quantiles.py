"""Exact percentiles of groups of any size.

A group's values never meet in one task. Equal values are counted first; the counts are added up in bands of a monotone function of the
value, of which a group has a bounded number; running sums over the bands tell in which one a rank stands, and the values of that band alone are counted
in finer bands, then sorted. All of it is one lazy plan: the shuffle with the counted values is made once and read by every step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import present

#: Bands for each power of e (at most 91,000 in all), and parts of a band.
PER_E, PARTS = 64, 1 << 16


def counted(df: DataFrame, by: list[str], value: Column | str = "value") -> DataFrame:
    """``by``, v and n: how often each value stands in each group. Missing samples are left out."""
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, v.cast("double").alias("value"))
    return present(rows).groupBy(*by, F.col("value").alias("v")).agg(F.count("*").alias("n"))


def same(a: DataFrame, b: DataFrame, by: list[str], prefix: str) -> Column:
    """Equal groups of two tables, of which the second has its keys under ``prefix``; null is a group like others."""
    return reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[prefix + c]) for c in by))


def _located(rows: DataFrame, by: list[str], band: str, over: list[str]) -> DataFrame:
    """Of the bands of each group of ``over`` with the count ``m``, ``ahead`` (the values before the band)."""
    w = Window.partitionBy(*over).orderBy(band)
    return rows.withColumn("ahead", F.sum("m").over(w) - F.col("m"))


def ranked(counts: DataFrame, by: list[str], ranks: list[Column]) -> DataFrame:
    """``by``, total, and r0, r1, ...: the values at ``ranks`` (from 0, expressions of the group's ``total``) of the sorted values."""
    band = F.floor(F.signum("v") * F.log1p(F.abs("v")) * PER_E).cast("long")
    bands = counts.groupBy(*by, band.alias("band")).agg(F.sum("n").alias("m"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    bands = _located(bands, by, "band", by).withColumn("total", F.sum("m").over(Window.partitionBy(*by)))
    want = F.array(*(F.struct(F.lit(i).alias("i"), r.cast("long").alias("rank")) for i, r in enumerate(ranks)))
    hit = lambda x: (F.col("ahead") <= x) & (x < F.col("ahead") + F.col("m"))
    first = bands.withColumn("w", F.explode(want)).where(hit(F.col("w.rank"))).select(*by, "band", "lo", "hi", "total", F.col("w.i").alias("i"), (F.col("w.rank") - F.col("ahead")).alias("rank"))
    keys = [*(f"_{c}" for c in by), "i"]
    t = first.select(*(F.col(c).alias(f"_{c}") for c in by), F.col("band").alias("_band"), "lo", "hi", "total", "i", "rank")
    inside = counts.join(t, same(counts, t, by, "_") & (band == F.col("_band")))
    part = F.when(F.col("lo") == F.col("hi"), 0).otherwise(F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * PARTS), F.lit(PARTS - 1))).cast("int")
    inside = inside.select(*keys, "v", "n", "total", "rank", part.alias("part"))
    parts = _located(inside.groupBy(*keys, "part").agg(F.sum("n").alias("m"), F.first("rank").alias("rank")), by, "part", keys)
    t = parts.where(hit(F.col("rank"))).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("part").alias("_part"), (F.col("rank") - F.col("ahead")).alias("_rank"))
    last = inside.join(t, same(inside, t, keys, "_") & (F.col("part") == F.col("_part"))).select(*keys, "v", "total", F.col("n").alias("m"), F.col("_rank").alias("rank"))
    last = _located(last, by, "v", keys).where(hit(F.col("rank")))
    return last.groupBy(*(F.col(f"_{c}").alias(c) for c in by)).agg(F.first("total").alias("total"), *(F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"r{i}") for i in range(len(ranks))))


#: Asks ``percentiles`` for the upper middle of the sorted values.
UPPER_MEDIAN = "upper"


def percentiles(counts: DataFrame, by: list[str], at: dict[str, float | str]) -> DataFrame:
    """``by`` and for each name in ``at`` the interpolated percentile (a share), or the upper median, of ``counted`` values."""
    last = F.col("total") - 1
    ranks = []
    for p in at.values():
        ranks += [F.floor(F.col("total") / 2)] if p == UPPER_MEDIAN else [F.floor(last * p), F.ceil(last * p)]
    found, out, i = ranked(counts, by, ranks), [], 0
    for name, p in at.items():
        if p == UPPER_MEDIAN:
            out.append(F.col(f"r{i}").alias(name))
            i += 1
            continue
        lo, hi, pos = F.col(f"r{i}"), F.col(f"r{i + 1}"), last * p
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi).alias(name))
        i += 2
    return found.select(*by, *out)


def approximate(df: DataFrame, by: list[str], at: dict[str, float | str], value: str = "value") -> DataFrame:
    """As ``percentiles``, by sketches of bounded size, without interpolation."""
    return present(df).groupBy(*by).agg(*(F.percentile_approx(value, 0.5 if p == UPPER_MEDIAN else p).alias(name) for name, p in at.items()))


def joined(a: DataFrame, b: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """The columns of two tables with a row for each group; null is a group like others."""
    if not by:
        return a.crossJoin(b)  # one row each
    b = b.select(*(F.col(c).alias(f"_{c}") for c in by), *(c for c in b.columns if c not in by))
    return a.join(b, same(a, b, by, "_"), how).drop(*(f"_{c}" for c in by))
