"""How often the lines of one template meet."""

import random

from arraymetrics.llm import linededup


def test_a_pair_of_crowded_lines_is_made_once(spark, monkeypatch):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    base = [word(5) for _ in range(50)]
    lines = []
    for _ in range(40):
        x = list(base)
        x[rng.randrange(50)] = word(5)
        lines.append(" ".join(x))
    seen, pairs, as_it_was = 0, set(), linededup._unordered

    def counted(rows):
        nonlocal seen
        seen += rows.count()
        pairs.update((r.a, r.b) for r in as_it_was(rows).collect())
        return as_it_was(rows)

    monkeypatch.setattr(linededup, "_unordered", counted)
    monkeypatch.setattr(linededup, "FIRST", 0)
    table = linededup.line_table(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), linededup.LEAST_CHARS)
    linededup.near_lines(table, None).count()
    # lines of one length find each other from both sides
    assert 500 < len(pairs) <= 780 and seen <= 2 * len(pairs)
