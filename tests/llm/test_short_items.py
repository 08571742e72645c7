"""Benchmark items of fewer words than a window."""

import itertools

from arraymetrics.llm import decontaminate


def test_short_items_bear_their_share_of_replaced_words(spark):
    words = [f"w{k}" for k in range(13)]
    docs, want = [], set()
    for n in range(1, 14):
        bear = max(k for k in range(n) if n - k >= 0.8 * n)
        for m in range(bear + 2):
            for at in itertools.combinations(range(n), min(m, n)):
                text = [f"i{n}{w}" if k not in at else "zzz" for k, w in enumerate(words[:n])]
                docs.append((len(docs), "before " + " ".join(text) + " behind"))
                if m <= bear:
                    want.add((docs[-1][0], n))
    bench = spark.createDataFrame([(n, " ".join(f"i{n}{w}" for w in words[:n])) for n in range(1, 14)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, bench, least=1).collect()} == want
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, bench).collect()} == {x for x in want if x[1] >= decontaminate.LEAST}
    assert {r.doc_id for r in decontaminate.decontaminated(df, bench, least=1).collect()} == {i for i, _ in docs} - {i for i, _ in want}
