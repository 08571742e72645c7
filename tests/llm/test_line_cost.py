"""What hashes of a line's parts and distances of long lines cost, and that they stay what they were."""

import random
import time

from pyspark.sql import functions as F

from arraymetrics.llm import linededup


def _timed(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1).cache()
    df.count()
    times = []
    for _ in range(2):
        began = time.perf_counter()
        got = df.select(linededup.edit_distance(F.col("a"), F.col("b")).alias("d"), F.levenshtein("a", "b").alias("l") if len(pairs[0][0]) < 500 else F.lit(2).alias("l")).collect()
        times.append(time.perf_counter() - began)
    assert all(r.d == r.l for r in got)
    return min(times)


def test_equal_beginnings_and_ends_cost_little(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice("abcdefgh") for _ in range(4000)) for _ in range(150)]
    apart = _timed(spark, [(x, "X" + x[1:-1] + "Y") for x in lines])
    together = _timed(spark, [(x, x[:2000] + "XY" + x[2002:]) for x in lines])
    assert together < apart / 3


def test_distance_of_lines_that_share_most(spark):
    rng = random.Random(4)
    pairs = []
    for n in [*range(24), 31, 32, 63, 64, 65, 130]:
        x = "".join(rng.choice("aaé") for _ in range(n))
        for _ in range(12):
            y = list(x)
            for _ in range(rng.randint(0, 2)):
                at = rng.randint(0, len(y))
                y[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é", "b"])
            pairs.append((x, "".join(y)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for a, b in (("a", "b"), ("b", "a")):
        assert df.where(linededup.edit_distance(F.col(a), F.col(b)) != F.levenshtein(a, b)).count() == 0


def test_parts_of_bytes_and_of_characters_hash_alike(spark):
    long = spark.createDataFrame([(1, "a plain line of some length", 27), (2, "é plain line of some length", 27)], "key long, line string, chars int")
    for probes in (False, True):
        got = linededup._parts(long, "k", 2, probes).collect()
        want = long.select("key", F.explode(F.array(*(F.xxhash64(F.substr("line", F.lit(1 + s) + F.floor(i * (F.col("chars") - g) / 3).cast("int"), F.floor((i + 1) * (F.col("chars") - g) / 3).cast("int") - F.floor(i * (F.col("chars") - g) / 3).cast("int")), F.col("chars") - g, F.lit(i)) for g, i, s in linededup._places(2, probes)))).alias("part")).collect()
        assert sorted((r.k, r.part) for r in got) == sorted((r.key, r.part) for r in want) and len(got) == (24 if probes else 6)
