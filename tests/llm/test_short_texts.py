"""Texts too short to tell their language by."""

import random

from arraymetrics.llm import langid


def test_only_evidence_rejects(spark):
    rng = random.Random(6)
    words = ["river", "stone", "light", "under", "walking", "harbour"]
    learned = [(i, " ".join(rng.choice(words) for _ in range(30)), "en") for i in range(20)]
    model = langid.fit(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    docs = [(0, "Re."), (1, "A."), (2, "All rights reserved."), (3, "zzqj xxwv " * 10), (4, "stone river harbour " * 5), (5, "12 !"), (6, None), (7, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in langid.keep(df, model, 0.3).collect()) == [0, 1, 2, 4]
    assert langid.keep(df, langid.fit(df.selectExpr("*", "CAST(NULL AS STRING) AS lang")), 0.3).count() == 0
