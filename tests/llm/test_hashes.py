"""Texts on which hashes modulo a power of two collide, and rows that share an id."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from corpus import SCHEMA, sentence
from tokenizers import Tokenizer

from arraymetrics.llm import bpe, common, decontaminate, jaccard, substring, suffixes

sha = lambda x: hashlib.sha256(x).hexdigest()


def morse(n, one, two):
    """A Thue-Morse sequence."""
    return [(one, two)[bin(i).count("1") & 1] for i in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, *[None] * 9) for i, t in texts], SCHEMA)


@pytest.mark.parametrize("n", [2048, 8192])
def test_byte_texts(spark, n):
    a, b = "".join(morse(n, "a", "b")), "".join(morse(n, "b", "a"))
    texts = [(1, f"one. {a} two. {a} end"), (2, f"one. {b} two. {b} end"), (3, a), (4, b), (5, b)]
    df = frame(spark, texts)
    t = Tokenizer.from_file(bpe.default_vocabulary())
    want = {i: (sha(np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes()), sha(x.encode())) for i, x in texts}
    assert {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(df, digest=True).collect()} == want
    got = {r.doc_id: r for r in jaccard.near_duplicates(df).collect()}
    assert [got[i].class_id for i in (3, 4, 5)] == [3, 4, 4] and got[3].n_links == 0
    seen = Counter(x[k : k + 400] for _, x in texts for k in range(len(x) - 399))
    for r in suffixes.remove_repeats(df).collect():
        x = dict(texts)[r.doc_id]
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - 399):
            if seen[x[k : k + 400]] > 1:
                gone[k : k + 400] = True
        assert r.n_removed == gone.sum()


def test_word_texts(spark):
    a, b = " ".join(morse(2048, "ab", "ba")), " ".join(morse(2048, "ba", "ab"))
    df = frame(spark, [(1, a), (2, b), (3, "x " * 60 + b)])
    seen, want = {}, {}
    for i, t in ((1, a), (2, b), (3, "x " * 60 + b)):
        w = t.split()
        for k in range(len(w) - 49):
            seen.setdefault(tuple(w[k : k + 50]), i)
        want[i] = len({p for k in range(len(w) - 49) if seen[tuple(w[k : k + 50])] < i for p in range(k, k + 50)})
    assert {r.doc_id: r.n_removed for r in substring.remove_repeats(df).collect()} == want
    items = spark.createDataFrame([(7, a)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.overlaps(frame(spark, [(1, b[:20]), (2, a)]), items).collect()} == {2}


def test_words_and_windows():
    data = np.frombuffer(b"a aa aaaaaaaa aaaaaaaaa " + b"b" * 64 + b" " + b"b" * 65 + b" aa " + b"b" * 65, np.uint8)
    w = common.Words(data, np.array([0, len(data)]), "space", two=True)
    assert len(set(w.hash.tolist())) == len(set(w.hash2.tolist())) == 6 and w.hash[1] == w.hash[6] and w.hash[5] == w.hash[7]
    r = common.Rolling(np.concatenate([w.hash, w.hash]))
    assert r.windows(np.array([1]), np.array([7])) == r.windows(np.array([9]), np.array([15])) != r.windows(np.array([2]), np.array([8]))


def test_joins_are_repaired_until_they_agree():
    path = bpe.default_vocabulary()
    encoding, _ = bpe.load(path)
    text = "The harbour was quiet. Nobody came, and under the light a river of copper stones went by at seven."
    ids = bpe.encode_text(encoding, text)
    code = lambda x: bpe.encode_text(encoding, x)
    assert bpe.repaired([text[:11], text[40:45], text[70:]], [code(text[11:40]), code(text[45:70])], path).tolist() == ids.tolist()


def test_shared_and_null_ids(spark):
    import random

    rng = random.Random(3)
    a, b, c = (sentence(rng, 90) for _ in range(3))
    rows = [(5, a), (5, b), (6, b + " more"), (None, c), (None, c + " again"), (7, a), (None, a)]
    got = sorted(jaccard.near_duplicates(frame(spark, rows)).collect(), key=str)
    assert sorted((r.n_links, r.n_copies) for r in got) == [(0, 3)] * 3 + [(1, 1)] * 4
    assert {r.class_id for r in got if r.doc_id == 6} == {5}
    kept = [r.text for r in jaccard.one_of_each(frame(spark, rows)).collect()]
    assert len(kept) == 3 and a in kept and b in kept and (c in kept) != (c + " again" in kept)
    items = spark.createDataFrame([(1, " ".join(b.split()[10:40]))], "item_id long, text string")
    left = decontaminate.decontaminated(frame(spark, rows), items)
    assert sorted(r.text for r in left.collect()) == sorted(t for _, t in rows if not t.startswith(b))


def test_factors_copy_from_their_places(spark):
    import random

    rng = random.Random(6)
    a, b = sentence(rng, 200).split(), sentence(rng, 150).split()
    texts = [(1, " ".join(a)), (2, " ".join(b)), (9, " ".join(["new"] * 5 + a[20:120] + b[30:100] + a[5:60])), (10, " ".join(a))]
    words = {i: t.split() for i, t in texts}
    got = {r.doc_id: r for r in substring.remove_repeats(frame(spark, texts)).collect()}
    assert not got[1].factors and [tuple(f) for f in got[10].factors] == [(0, 200, 1, 0)]
    assert {(f.start, f.words, f.ref_doc, f.ref_start) for f in got[9].factors} >= {(5, 100, 1, 20), (105, 70, 2, 30), (175, 55, 1, 5)}
    for f in got[9].factors:
        assert f.words >= 50 and words[9][f.start : f.start + f.words] == words[f.ref_doc][f.ref_start : f.ref_start + f.words]
    assert got[9].n_removed == 225 and got[9].kept == "new new new new new"
