"""Lines whose bound of edits grows with them."""

import random

from corpus import sentence
from pyspark.sql import functions as F

from arraymetrics.llm import linededup


def test_line_edits_grow_with_the_line(spark):
    rng = random.Random(8)

    def allowed(n):
        return n // 12 if n < 36 else int(n**0.5 / 2)

    def distance(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
            prev = row
        return prev[-1]

    lines = []
    for n in (8, 12, 16, 23, 24, 35, 36, 40, 63, 64, 65, 99, 100, 143, 144, 200, 255, 256, 300):
        base = "".join(rng.choice("abcdefghé ") for _ in range(n - 1)) + "x"
        lines.append(base)
        for more in (-1, 0, 0, 1):  # spread evenly, or at random; inside, at and beyond the bound
            changed = list(base)
            edits = max(1, allowed(n) + more)
            at = sorted(rng.sample(range(n), edits)) if more else [k * n // edits for k in range(edits)]
            for k in reversed(at):
                changed[k : k + rng.randint(0, 1)] = rng.choice(["", "Q", "é"])
            lines.append("".join(changed))
    lines.append("the quarter's figures were published by the treasury on the second day of the month and then taken back by a clerk of the house")
    lines.append(lines[-1].replace("treasury", "ministry"))
    lines += [f"Chapter {k:03d} of the collected letters of the house of {sentence(rng, 3)}" for k in range(60)]
    lines = [x for x in dict.fromkeys(lines) if x.strip()]
    rng.shuffle(lines)
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    near = lambda a, b: abs(len(a) - len(b)) <= 12 and distance(a, b) <= allowed(min(len(a), len(b)))
    want = {k for k, b in enumerate(lines) if any(near(a, b) for a in lines[:k])}
    got = {r.doc_id for r in linededup.decisions(df, None, linededup.LEAST_CHARS).where(F.col("n_removed") > 0).collect()}
    assert got == want and len(want) > 40
