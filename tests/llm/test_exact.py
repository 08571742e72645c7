"""Operators whose result is fixed, against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import empty, frame, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arraymetrics.llm import bpe, common, linededup, substring, suffixes, topk


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def test_rolling_windows_and_words():
    data = np.frombuffer("ab cab, ab\tcab é".encode(), np.uint8)
    w = common.Words(data, np.array([0, 7, len(data)]), "space")
    assert [data[s:e].tobytes().decode() for s, e in zip(w.start, w.end)] == ["ab", "cab,", "ab", "cab", "é"]
    assert w.doc.tolist() == [0, 2, 5] and w.hash[0] == w.hash[2] and w.hash[1] != w.hash[3]
    assert list(common.slices(np.array([0, 5, 6, 30, 31]), 10)) == [(0, 2), (2, 3), (3, 4)]
    x = np.array([5, 3, 9, 1, 7, 7], np.uint64)
    assert substring.slide(x, 3, np.minimum, np.uint64(99)).tolist() == [3, 1, 1, 1, 7, 7]


def test_bpe_is_the_tokenizers(spark):
    t = Tokenizer.from_file(bpe.default_vocabulary())
    want = Counter()
    for r in rows():
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False).encode()))] += 1
    assert Counter(map(tuple, bpe.encode_decode(frame(spark), digest=True).collect())) == want
    full = {r.doc_id: r for r in bpe.encode_decode(frame(spark)).collect()}
    assert full[9].decoded == rows()[3][1] and len(full[9].ids) % 4 == 0
    assert bpe.encode_decode(empty(spark)).count() == 0


def test_bpe_chunks_fall_alike_and_rejoin():
    encoding, _ = bpe.load(bpe.default_vocabulary())
    long = " ".join(r[1] or "" for r in rows()) * 2
    raw = np.frombuffer(long.encode(), np.uint8)
    offs = np.array([0, len(raw) // 2, len(raw)])
    _, start, end, h1, _ = bpe.chunks(raw, offs)
    assert len(start) > 10 and len(set(h1.tolist())) < len(h1)
    at, ids = 0, []
    for s, e in zip(start.tolist(), end.tolist()):
        ids += [*bpe.encode_text(encoding, bpe._plain(raw[at:s])), *bpe.encode_text(encoding, bpe._plain(raw[s:e]))]
        at = e
    ids += [*bpe.encode_text(encoding, bpe._plain(raw[at:]))]
    assert ids == bpe.encode_text(encoding, long).tolist()


def test_line_dedup(spark):
    docs = [(r[0], r[1]) for r in rows()]
    first, place = {}, {}
    for i, t in docs:
        for k, x in enumerate((t or "").split("\n") if t is not None else []):
            if re.search(r"\S", re.sub(r"[^\x21-\x7e\x80-\U0010ffff]", " ", x)):
                p = (i if i is not None else 2**63 - 1, k)
                first[x] = min(first.get(x, p), p)
    lines = list(first)

    def edits(a, b, most=2):
        if abs(len(a) - len(b)) > most:
            return most + 1
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i] + [0] * len(b)
            for j, y in enumerate(b, 1):
                row[j] = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if min(row) > most:
                return most + 1
            prev = row
        return prev[-1]

    near = {b for a in lines for b in lines if first[a] < first[b] and min(len(a), len(b)) >= 24 and edits(a, b) <= 2}
    assert near
    want = Counter()
    for i, t in docs:
        parts = t.split("\n") if t is not None else []
        gone = [k for k, x in enumerate(parts) if x in first and ((i if i is not None else 2**63 - 1, k) != first[x] or x in near)]
        want[(i, len(parts), len(gone), ",".join(map(str, gone)))] += 1
    assert Counter(map(tuple, linededup.decisions(frame(spark)).collect())) == want
    out = linededup.deduplicate(frame(spark))
    assert out.columns == frame(spark).columns and out.count() == len(docs)
    texts = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert texts[0] == docs[0][1] and texts[26 * 3] == "" and texts[1000] is None
    assert linededup.deduplicate(empty(spark)).count() == 0 and linededup.decisions(empty(spark)).count() == 0


def test_bit_parallel_distance(spark):
    import random

    rng = random.Random(2)
    pairs = []
    while len(pairs) < 250:
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randint(0, len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        if abs(len(a) - len("".join(b))) <= 2:
            pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").select(linededup.edit_distance(F.col("a"), F.col("b"), 2).alias("d"), F.levenshtein("a", "b").alias("l"))
    assert all(r.d == r.l if r.l <= 2 else r.d > 2 for r in df.collect())


def test_word_windows(spark):
    want, seen = Counter(), defaultdict(set)
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    for r in rows():
        w = split(r[1])
        for i in range(len(w) - 49):
            if r[0] is not None:
                seen[tuple(w[i : i + 50])].add(r[0])
    for r in rows():
        w = split(r[1])
        gone = set()
        for i in range(len(w) - 49):
            if r[0] is not None and min(seen[tuple(w[i : i + 50])]) < r[0]:
                gone.update(range(i, i + 50))
        want[(r[0], len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode()))] += 1
    assert sum(k[2] > 0 for k in want) > 4
    assert Counter(map(tuple, substring.remove_repeats(frame(spark), digest=True).collect())) == want
    assert substring.remove_repeats(empty(spark)).count() == 0


def test_byte_strings(spark):
    seen, want = Counter(), Counter()
    raws = [(r[0], (r[1] or "").encode()) for r in rows()]
    for _, t in raws:
        seen.update(t[i : i + 400] for i in range(len(t) - 399))
    for i, t in raws:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if seen[t[k : k + 400]] > 1:
                gone[k : k + 400] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want[(i, len(t), int(gone.sum()), spans, sha(np.frombuffer(t, np.uint8)[~gone].tobytes()))] += 1
    assert sum(k[2] > 0 for k in want) > 6
    assert Counter(map(tuple, suffixes.remove_repeats(frame(spark), digest=True).collect())) == want
    assert suffixes.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("size", [0, 1, 4, 130])
def test_top_k(spark, size):
    rng = np.random.default_rng(size)
    vectors = [(i, [float(x) for x in rng.choice([-1.5, 0.25, 0.3, 2.0], 3)]) for i in range(size)]
    vectors += [(500 + i, [1.0, 1.0, 1.0]) for i in range(30 if size > 4 else 0)]
    bad = [(900, None), (901, [1.0, None, 2.0]), (902, [float("nan"), 1.0, 1.0]), (903, [math.inf, 0.0, 0.0]), (904, []), (None, [1.0, 1.0, 1.0]), (910, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 0, i) for i, v in vectors + bad], "vec_id long, embedding array<float>, label int, score long").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5)
    q = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in vectors}
    want = set()
    for i, v in q.items():
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in q.items() if j != i)[:5]
            want |= {(i, n, j, -s) for n, (s, j) in enumerate(best, 1)}
    assert {tuple(r) for r in got.collect()} == want


def test_lines_of_one_template(spark):
    """Many variants share segments; all near ones are found among them."""
    import random

    rng = random.Random(9)
    base = "seven quiet harbour lights under the copper stone walking"
    docs = []
    for i in range(60):
        x = list(base)
        for _ in range(rng.choice([1, 1, 2, 6])):
            x[rng.randrange(18)] = rng.choice("abcdefgh")
        docs.append((i, "".join(x)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    lines = df.select("doc_id", "text")
    pairs = lines.alias("x").join(lines.alias("y"), F.expr("x.doc_id < y.doc_id AND levenshtein(x.text, y.text) <= 2")).select(F.col("y.doc_id")).distinct()
    want = {r[0] for r in pairs.collect()}
    assert 10 < len(want) < 60
    assert {r.doc_id for r in linededup.decisions(df).collect() if r.n_removed} == want
