"""Coverage of expected metrics."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..sources.scratch import written


def coverage(expected: DataFrame, available: DataFrame) -> DataFrame:
    """Resource, metric and status of the union of both: ok, missing or extra."""
    e = expected.select("resource", "metric").distinct().withColumn("_e", F.lit(True))
    a = available.select("resource", "metric").distinct().withColumn("_a", F.lit(True))
    status = F.when(F.col("_e").isNull(), "extra").when(F.col("_a").isNull(), "missing").otherwise("ok")
    return e.join(a, ["resource", "metric"], "full_outer").select("resource", "metric", status.alias("status"))


def coverage_summary(cov: DataFrame) -> DataFrame:
    """D27."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    return cov.agg(n("ok", "missing").alias("expected"), n("ok", "extra").alias("available"), n("ok").alias("ok"), n("missing").alias("missing"), n("extra").alias("extra"))


def with_original(cov: DataFrame, metrics: DataFrame) -> DataFrame:
    """C11: the dictionary's display name, of the smallest id where several share a sanitised name."""
    from .joins import named_metrics

    names = named_metrics(metrics).groupBy("metric").agg(F.min_by("display_name", "metric_id").alias("display_name"))
    return cov.join(names, "metric", "left").withColumn("in_dictionary", F.col("display_name").isNotNull())


@F.pandas_udf(DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _letters(name: Column) -> Column:
    """The letters of a name, told apart by how often each came before: equal sets are equal multisets of letters. An empty name has one of its own."""
    ordered = F.array_sort(F.split(name, ""))
    return F.when(name == "", F.array(F.lit(""))).otherwise(F.transform(ordered, lambda x, i: F.concat(x, (i + 1 - F.array_position(ordered, x)).cast("string"))))


def suggest(missing: DataFrame, available: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The most similar available name of each missing one, at ``threshold`` (above 0) at least; ties go to the smaller name.

    The similarity of names of m and n letters is 2 M / (m + n), where M is no more than the letters that they have in common. So a name shares at least
    threshold * m / (2 - threshold) letters with any that is near enough, and two such names share one of their rarest letters: names are joined
    on as many of these as that asks for, and pairs that don't have the letters in common are dropped before they are compared.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0")
    one = lambda df, name: df.select(F.col("metric").alias("text"), F.lit(name).alias("side")).where(F.col("metric").isNotNull())
    names = one(missing, "name").unionAll(one(available, "other")).distinct().withColumn("letters", _letters(F.col("text")))
    names = written(names)  # a row for each name; what gave them is not worked out again in each step
    m, a = (names.where(F.col("side") == s).select(F.col("text").alias(s), "letters") for s in ("name", "other"))
    often = m.select(F.explode("letters").alias("letter")).unionAll(a.select(F.explode("letters").alias("letter"))).groupBy("letter").agg(F.count("*").alias("often"))

    def rare(df: DataFrame, name: str) -> DataFrame:
        n = F.length(name)
        most = n - F.ceil(F.lit(threshold / (2 - threshold)) * n - 1e-9).cast("int") + 1
        each = df.select(name, "letters", F.explode("letters").alias("letter")).join(often, "letter")
        firsts = each.groupBy(name).agg(F.first("letters").alias("letters"), F.slice(F.array_sort(F.collect_list(F.struct("often", "letter"))), F.lit(1), F.greatest(most, F.lit(1))).alias("rare"))
        return firsts.select(name, F.col("letters").alias(f"{name}_letters"), F.explode("rare.letter").alias("letter"))

    both = rare(m, "name").join(rare(a, "other"), "letter")
    enough = 2 * F.size(F.array_intersect("name_letters", "other_letters")) >= F.lit(threshold) * (F.length("name") + F.length("other")) - 1e-9
    pairs = both.where(enough | ((F.col("name") == "") & (F.col("other") == ""))).select("name", "other").distinct()
    scored = pairs.withColumn("ratio", _similarity("name", "other")).where(F.col("ratio") >= threshold)
    best = scored.groupBy("name").agg(F.min(F.struct((-F.col("ratio")).alias("r"), F.col("other"))).alias("s"))
    return best.select(F.col("name").alias("metric"), F.col("s.other").alias("suggestion"), F.round(-F.col("s.r"), 6).alias("ratio"))


def metric_sets(expected: DataFrame, available: DataFrame) -> DataFrame:
    """H2, H3: resource, metric and the part of the two sets that holds it: missing (expected only), extra (available only) or both."""
    keys = ["resource", "metric"]
    e, a = expected.select(*keys).distinct(), available.select(*keys).distinct()
    parts = {"missing": e.exceptAll(a), "extra": a.exceptAll(e), "both": e.intersect(a)}
    return reduce(DataFrame.unionAll, (df.withColumn("part", F.lit(n)) for n, df in parts.items()))
