"""Lines of one template, near and not near each other, against all pairs."""

import random

import pytest

from arraymetrics.llm import linededup


def _edits(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1]


def _allowed(n):
    return n // 12 if n < 36 else int(n**0.5 / 2)


@pytest.mark.parametrize("first", [linededup.FIRST, 1])
def test_crowds_lose_no_line(spark, monkeypatch, first):
    monkeypatch.setattr(linededup, "FIRST", first)
    rng = random.Random(first)
    base = "the quick harbour master walked under seven lights"
    variants = []
    for n in range(90):
        x = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            at = rng.randrange(len(x))
            x[at : at + 1] = rng.choice([[], ["z"], [x[at], "q"], [rng.choice("abcdefgh")]])
        variants.append("".join(x) + rng.choice(["", f" no {n:03d}", "s"]))
    rng.shuffle(variants)
    docs = [(i, v + "\n" + f"own line {i * 7919 % 1000:04d} of document {i}") for i, v in enumerate(variants)] + [(500, base), (501, base)]
    places, want = {}, {}
    for i, t in docs:
        for k, x in enumerate(t.split("\n")):
            places.setdefault(x, (i, k))
    near = {x for x, p in places.items() if any(q < p and abs(len(x) - len(y)) <= 8 and _edits(x, y) <= _allowed(min(len(x), len(y))) for y, q in places.items() if len(min(x, y, key=len)) >= linededup.LEAST_CHARS and y != x)}
    for i, t in docs:
        want[i] = ",".join(str(k) for k, x in enumerate(t.split("\n")) if places[x] != (i, k) or x in near)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.removed_lines for r in linededup.decisions(df, None, linededup.LEAST_CHARS).collect()} == want
    assert 20 < sum(v != "" for v in want.values())
