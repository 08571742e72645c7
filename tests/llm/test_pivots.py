"""Crowded lines that are told apart by what they have of one line: none is lost, and few pairs are made."""

import random

import pytest
from pyspark.sql import functions as F

from arraymetrics.llm import linededup


def _edits(a, b, anywhere=False):
    prev = [0] * (len(b) + 1) if anywhere else list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return min(prev) if anywhere else prev[-1]


def _allowed(n):
    return n // 12 if n < 36 else int(n**0.5 / 2)


def _word(rng, n=5):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n))


def test_best_place_of_a_window(spark):
    rng = random.Random(31)
    rows = []
    for _ in range(150):
        text = "".join(rng.choice("abcé𝄞") for _ in range(rng.choice([0, 3, 16, 40, 90])))
        at = rng.randint(0, max(0, len(text) - 16))
        piece = list(text[at : at + 16])
        for _ in range(rng.randint(0, 6)):
            piece[rng.randint(0, len(piece)) :][:1] = []
            where = rng.randint(0, len(piece))
            piece[where : where + rng.randint(0, 1)] = rng.choice(["", "x", "a", "é"])
        rows.append((("".join(piece) + _word(rng, 16))[:16], text))
    got = spark.createDataFrame(rows, "p string, t string").select("p", "t", linededup._best_place(F.split("p", ""), F.split("t", "")).alias("d")).collect()
    assert [r.d for r in got] == [_edits(r.p, r.t, True) for r in got] and len({r.d for r in got}) > 5


@pytest.mark.parametrize("repeats", [False, True])
def test_measured_lines_lose_no_line(spark, monkeypatch, repeats):
    monkeypatch.setattr(linededup, "FOLLOWERS", 2)
    monkeypatch.setattr(linededup, "FIRST", 1)
    rng = random.Random(32 + repeats)
    base = [_word(rng)] * 26 if repeats else [_word(rng) for _ in range(26)]
    seen, lines = [], [" ".join(base)]
    for n in range(70):
        x = list(rng.choice(seen) if seen and n % 2 else base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            at = rng.randrange(len(x))
            x[at : at + 1] = rng.choice([[], [_word(rng)], [x[at], "é"], [x[at] + "s"], [x[at][1:]], [_word(rng, 2)]])
        seen.append(x)
        lines.append(" ".join(x))
    lines = list(dict.fromkeys(lines))
    near = lambda a, b: abs(len(a) - len(b)) <= 8 and _edits(a, b) <= _allowed(min(len(a), len(b)))
    want = {k for k, b in enumerate(lines) if any(near(a, b) for a in lines[:k])}
    told, as_it_was = [], linededup._measured
    monkeypatch.setattr(linededup, "_measured", lambda *x: told.append(as_it_was(*x)) or told[0])
    monkeypatch.setattr(linededup, "dropped", lambda *x: None)
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {r.doc_id for r in linededup.decisions(df, None, linededup.LEAST_CHARS).where("n_removed > 0").collect()}
    assert got == want and 20 < len(want) < len(lines) - 5
    assert told[0].where("size(off) > 0").count() > 20


def test_variants_beyond_the_bound_make_few_pairs(spark, monkeypatch):
    rng = random.Random(33)
    word = lambda: "".join(rng.choice("then") for _ in range(5))  # noqa: E731  few letters, so pairs of letters hardly differ
    base = [word() for _ in range(50)]
    lines = [" ".join(base)]
    for _ in range(90):
        x = list(base)
        for at in rng.sample(range(50), 6):
            x[at] = "".join(rng.choice("aors") for _ in range(5)) if rng.random() < 0.5 else word()
        lines.append(" ".join(x))
    made, as_it_was = [], linededup._crowd_rest

    def counted(*x):
        out = as_it_was(*x)
        made.append(out.count())
        return out

    monkeypatch.setattr(linededup, "_crowd_rest", counted)
    monkeypatch.setattr(linededup, "FIRST", 0)
    table = linededup.line_table(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), linededup.LEAST_CHARS)
    linededup.near_lines(table, None).count()
    assert made[0] < 1000  # 408; 3,911 without the pivot
