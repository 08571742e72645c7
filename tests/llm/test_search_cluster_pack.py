"""Ranked search, clusters and packing against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import empty, frame, rows
from tokenizers import Tokenizer

from arraymetrics.llm import bpe, centroids, lexical, packing, topk

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, score string"


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    held = defaultdict(set)
    for i, t in items:
        if i is not None and t is not None:
            held[i] |= set(terms(t))
    out = Counter()
    for item, own in held.items():
        found = []
        for i, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if s > 0 and i is not None:
                found.append((-s, i))
        out.update((item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1))
    return out


@pytest.mark.parametrize("block,cells,wide", [(lexical.BLOCK_BYTES, lexical.CELLS, lexical.WIDE), (40, 8, 10**9), (10**6, 40, 1)])
def test_ranked_search(spark, monkeypatch, block, cells, wide):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "WIDE", wide)
    items = [(1, "The RIVER walking"), (2, "the of and stone harbours thunder copper7"), (3, "nothing here at all"), (4, ""), (5, None), (None, "river"), (6, "river"), (6, "quiet market"), (7, "字かな交じり文漢字 é"), (1, "The RIVER walking"), (8, "one a b c")]
    found = lexical.search(frame(spark), spark.createDataFrame([(*r, 9, "x") for r in items], ITEMS), 4)
    assert [n for n, _ in found.dtypes] == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == ranked([r[:2] for r in rows()], items, 4)


def test_ranked_search_of_nothing(spark):
    some = spark.createDataFrame([(1, "river", 1, "x")], ITEMS)
    assert lexical.search(empty(spark), some).count() == 0
    assert lexical.search(frame(spark), some.where("item_id > 5")).count() == 0
    assert lexical.search(frame(spark), spark.createDataFrame([(1, None, 1, "x"), (2, "-- !", 1, "x")], ITEMS)).count() == 0


def test_equal_scores_go_by_id(spark):
    docs = spark.createDataFrame([(i, "river stone") for i in range(40, 0, -1)] + [(99, "other words")], "doc_id long, text string").repartition(7)
    assert [r.doc_id for r in lexical.search(docs, spark.createDataFrame([(1, "river", 1, "x")], ITEMS), 5).orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def lloyd(vectors, k, dims, scale, rounds):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    c = [v for _, v in start]
    dist = lambda v, w: sum((a - b) ** 2 for a, b in zip(v, w))
    near = lambda v: min((dist(v, w), n) for n, w in enumerate(c))
    for _ in range(rounds if c else 0):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[1]].append(v)
        c = [[sum(x) // len(own[n]) for x in zip(*own[n])] if own[n] else w for n, w in enumerate(c)]
    got = [(i, *near(v)[::-1]) for i, v in kept] if c else []
    sums = Counter()
    for _, n, d in got:
        sums[n] += d
    return Counter((i, n, d, sums[n], sum(sums.values()), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for i, n, d in got)


def vectors(dims, seed=3):
    rng = np.random.default_rng(seed)
    out = [(i, rng.normal(size=dims).tolist()) for i in range(60)] + [(100 + i, [0.5] * dims) for i in range(30)]
    out += [(7, [0.25] * dims), (7, [0.25] * dims), (None, [1.0] * dims), (200, None), (201, []), (202, [0.1] * (dims - 1)), (203, [None] + [0.1] * (dims - 1))]
    return out + [(204, [float("nan")] * dims), (205, [float("inf")] + [0.0] * (dims - 1)), (206, [0.0] * dims), (207, [-0.001] * dims)]


@pytest.mark.parametrize("dims,width,block,k", [(6, 4, 7, 5), (5, 16, 512, 200), (3, 1, 1, 1)])
def test_clusters(spark, monkeypatch, dims, width, block, k):
    monkeypatch.setattr(centroids, "WIDTH", width)
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows_ = vectors(dims)
    df = spark.createDataFrame([(i, v, 3, "c") for i, v in rows_], "vec_id long, embedding array<double>, cluster int, block string").repartition(3)
    got = centroids.cluster(df, k, dims, 256, 3)
    assert Counter(map(tuple, got.collect())) == lloyd(rows_, k, dims, 256, 3)


def test_clusters_of_huge_components(spark):
    big = [(i, [x, 1.5]) for i, x in enumerate([1e15, 1e15, -2e6, 3e6, 0.0, 12345.678, -1e15, 1e15 + 2])]
    df = spark.createDataFrame(big[:1] + big[1:2] + big[7:], "vec_id long, embedding array<double>")
    assert Counter(map(tuple, centroids.cluster(df, 2, 2, 256, 2).collect())) == lloyd([big[0], big[1], big[7]], 2, 2, 256, 2)
    small = [b for b in big if abs(b[1][0]) < 1e9]
    assert Counter(map(tuple, centroids.cluster(spark.createDataFrame(small, "vec_id long, embedding array<double>"), 3, 2, 256, 2).collect())) == lloyd(small, 3, 2, 256, 2)
    with pytest.raises(Exception, match="no room in a long"):
        centroids.cluster(spark.createDataFrame(big, "vec_id long, embedding array<double>"), 1, 2, 256, 1).collect()


def test_clusters_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.cluster(none).collect() == []
    assert centroids.cluster(spark.createDataFrame([(None, [1.0] * 64), (3, [1.0])], "vec_id long, embedding array<float>")).collect() == []
    with pytest.raises(ValueError, match="more than"):
        centroids.cluster(none, 10**6)


def test_pieces_are_powers_of_two():
    for n in [0, 1, 2, 3, 1023, 1024, 1025, 5000]:
        c = packing.cut(n)
        assert sum(c) == n and all(x & (x - 1) == 0 and x <= 1024 for x in c) and c == sorted(c, reverse=True)
        assert len([x for x in c if x < 1024]) == len({x for x in c if x < 1024})


def test_packing(spark, tmp_path):
    t = Tokenizer.from_file(bpe.default_vocabulary())
    want = Counter((r[0], tuple(t.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in rows())
    packed = packing.pack(frame(spark), longest=256)
    got = packed.collect()
    assert len({r.sequence_id for r in got}) == len(got) and all(r.offset == 0 and r.length == 1 << r.bucket <= 256 for r in got)
    assert sorted(got, key=lambda r: r.sequence_id) == sorted(got, key=lambda r: (r.bucket, r.sequence_id))
    # pieces of a document stand together in the order they were made
    whole, texts = Counter(), []
    for r in got:
        if r.start == 0:
            texts.append([])
        texts[-1].append(r)
    for rs in texts:
        ids = b"".join(r.ids for r in rs)
        assert [r.start for r in rs] == np.cumsum([0] + [r.length for r in rs])[:-1].tolist() and {r.doc_tokens for r in rs} == {len(ids) // 4}
        whole[(rs[0].doc_id, tuple(np.frombuffer(ids, "<u4").tolist()))] += 1
    assert whole == want
    digests = packing.pack(frame(spark), longest=256, digest=True).collect()
    assert sorted((r.sequence_id, zlib.crc32(r.ids)) for r in got) == sorted((r.sequence_id, r.ids_crc32) for r in digests)
    packing.write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == len(got) and back.where("bucket = 8").select("length").distinct().collect()[0][0] == 256
    assert all(r.padding == 0 and r.ids == r.sequences << r.bucket for r in packing.padding(packed).collect())
    assert packing.pack(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(frame(spark), longest=1000)


@pytest.mark.parametrize("text", ["a" + " " * 20_000 + "b", " " * 2_000_000, "x" + "\n" * 2_000_000 + "é", " \t\n　\x85" * 400_000 + "<|endoftext|>" + " " * 10_000 + "\x1c z", "q " * 9000 + " " * 9999 + "'s"])
def test_very_long_runs_of_blanks(text):
    encoding, _ = bpe.load(bpe.default_vocabulary())
    assert bpe.encode_text(encoding, text).tolist() == Tokenizer.from_file(bpe.default_vocabulary()).encode(text, add_special_tokens=False).ids


def test_very_long_runs_of_blanks_in_documents(spark):
    t = Tokenizer.from_file(bpe.default_vocabulary())
    texts = [" " * 1_100_000, "word " * 3000 + "\n" * 50_000 + "word " * 3000, "word " * 3000]
    got = {r.doc_id: r for r in bpe.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, x in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids and got[i].decoded == x


def nearest(rows_, k):
    out = Counter()
    for n, (q, v) in enumerate(rows_):
        found = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(rows_) if m != n and len(v) == len(w))
        out.update((q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1))
    return out


def test_top_k_of_large_scores_and_repeated_ids(spark):
    x = [1e6, 1e6, 1e6, 1e6, 1e6]
    rows_ = [(1, x), (2, [-v for v in x]), (3, x), (3, x), (3, [1.0, 2.0, 3.0, 4.0, 5.0]), (4, [1e6 - 1, 0.0, 0.0, 0.0, 0.0]), (5, [0.0] * 5)]
    got = topk.top_k(spark.createDataFrame(rows_, "vec_id long, embedding array<double>"), "vec_id > 0", 3)
    assert Counter(map(tuple, got.collect())) == nearest([(i, [math.floor(1024 * a) for a in v]) for i, v in rows_], 3)
    with pytest.raises(Exception, match="no room in a long"):
        topk.top_k(spark.createDataFrame([(1, [3e6] * 5), (2, [3e6] * 5)], "vec_id long, embedding array<double>"), "vec_id > 0", 3).collect()
