"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _minima(pairs: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours. Partial sums keep a hub's neighbours from meeting in one task."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``id`` and ``root`` (the smallest id of the component) of every node of ``edges`` (long a, long b).

    Each round hangs the larger neighbours of every node on its smallest neighbour, then the smaller ones. The rounds needed
    grow with the logarithm of the longest path; each ends in a checkpoint, and only a count and a checksum reach the
    driver. Nodes that stand in no edge, or only in an edge with themselves, are not returned.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = None
    for _ in range(most_rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _minima(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        now = checkpointed(small.where("u <> v").distinct())
        got = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if got == mark:
            break
        mark = got
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionAll(now.select("v", "v").distinct())
