"""Operators that learn, propagate or join approximately: against brute force, on held-out rows, or both."""

import itertools
import random
import re
import zlib

import pytest
from corpus import SCHEMA, empty, frame, rows, sentence

from arraymetrics.llm import components, decontaminate, jaccard, langid, quality, urlfilter


def crc(i):
    return zlib.crc32(str(i).encode())


def test_masks_bear_two_replaced_words_of_thirteen():
    for a, b in itertools.combinations(range(13), 2):
        assert any(all(o + p not in (a, b) for p, c in enumerate(m) if c == "1") for m in decontaminate.MASKS for o in range(14 - len(m)))


def test_decontamination(spark):
    rng = random.Random(4)
    items = [sentence(rng, n) for n in (7, 13, 20, 40, 3)] + [None]
    bench = spark.createDataFrame([*enumerate(items), (2, items[2])], "item_id long, text string")
    base = [sentence(rng, 60) for _ in range(12)]
    changed = items[3].split()
    changed[5], changed[20] = "qqq", "zzz"
    docs = [*enumerate(base), (20, base[0] + " " + items[0] + " " + base[1]), (21, items[1].upper()), (22, base[2] + "\n" + items[2].replace(" ", ",  ")), (23, " ".join(changed) + " " + base[3]), (24, items[4] + " " + base[5]), (25, None), (None, items[3]), (26, ""), (22, base[2] + "\n" + items[2])]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, bench).collect()}
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
    want = set()
    for (i, t), (k, b) in itertools.product(docs, enumerate(items)):
        w, x = words(t), words(b)
        size = min(13, len(x))
        if len(x) >= decontaminate.LEAST and any(sum(p == q for p, q in zip(w[a : a + size], x[c : c + size])) >= 0.8 * size for a in range(len(w) - size + 1) for c in range(len(x) - size + 1)):
            want.add((i, k))
    assert got == want and {20, 21, 22, 23} <= {i for i, _ in got}
    longer = decontaminate.decontaminated(df, bench, least=6)
    assert {r.doc_id for r in longer.collect()} == {i for i, _ in docs} - {20, 21, 22, 23, None}  # 24 holds an item of three words
    kept = decontaminate.decontaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {20, 21, 22, 23, 24, None}  # rows without an id are judged by their text too
    assert decontaminate.overlaps(df, bench.where("false")).count() == 0 and decontaminate.overlaps(df.where("false"), bench).count() == 0


def test_language_id(spark):
    rng = random.Random(5)
    words = {"xx": ["aba", "abba", "baab", "aab"], "yy": ["cdc", "dccd", "ddc", "cdd"]}
    data = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(4, 50))), lang) for i, lang in enumerate(["xx", "yy"] * 60)]
    data += [(500, None, "xx"), (501, "", "yy"), (502, "123 !!", None), (503, "abba aba", None), (503, "abba aba", None), (None, "cdd ddc cdc", "xx")]
    df = spark.createDataFrame([(*r, 1.0) for r in data], "doc_id long, text string, lang string, score double")
    got = langid.identify(df).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == lang for i, _, lang in data[:120]) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and crc(r.doc_id) % 5 == 0) for r in got)
    assert [by[i].lang_pred for i in (500, 501, 502, 503, None)] == ["und", "und", "und", "xx", "yy"]
    # what is held out teaches nothing
    flipped = [(i, t, ("yy" if lang == "xx" else "xx") if i is not None and crc(i) % 5 == 0 else lang) for i, t, lang in data]
    again = langid.identify(spark.createDataFrame([(*r, 1.0) for r in flipped], df.schema)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert langid.identify(df.where("false")).count() == 0
    assert {r.lang_pred for r in langid.identify(df.drop("lang").selectExpr("*", "cast(null as string) as lang")).collect()} == {"und"}


def test_more_than_64_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    data = [(i, " ".join([f"{letters[k // 26]}{letters[k % 26]}q{letters[k % 26]}"] * 5), f"l{k:02d}") for i, k in enumerate(list(range(70)) * 3)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}
    assert sum(got[i] == lang for i, _, lang in data) > 0.95 * len(data)


def test_quality(spark):
    rng = random.Random(6)
    text = lambda good: " ".join(rng.choice(["calm", "sea", "over", "hill"]) + ("" if good else "!!") for _ in range(rng.randint(5, 60)))
    docs = [(i, text(i % 3 > 0)) for i in range(240)] + [(900, None), (901, ""), (901, ""), (None, "calm sea")]
    labels = [(i, int(i % 3 > 0), 0) for i in range(240)] + [(0, None, 0), (None, 1, 0), (3000, 1, 0)]
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id long, text string, label int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.classify(d, lab).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert len(held) > 30 and all(crc(r.doc_id) % 4 == 2 for r in held) and all(r.predicted == int(r.doc_id % 3 > 0) for r in held if r.doc_id < 240)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    swapped = spark.createDataFrame([(i, 1 - q if q is not None and i is not None and crc(i) % 4 == 2 else q, t) for i, q, t in labels], lab.schema)
    assert sorted(map(str, quality.classify(d, swapped).collect())) == sorted(map(str, got))
    assert {r.score for r in quality.classify(d, lab.where("false")).collect()} == {0.5} and quality.classify(d.where("false"), lab).count() == 0


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://A.Example.ORG/es/1?x", ("a.example.org", "/es/1", "example.org/es/", "block")),
        ("https://example.org/en/12#t", ("example.org", "/en/12", "example.org/en/1", "block")),
        ("x://badexample.org/en/12", ("badexample.org", "/en/12", "org/", "allow")),
        ("http://b.com/fr/", ("b.com", "/fr/", "com/fr/", "allow")),
        ("http://b.com?q=/fr/", ("b.com", "", None, "allow")),
        ("http://org/", ("org", "/", "org/", "allow")),
        ("http://ÉX.net://y/de/", ("Éx.net:", "//y/de/", None, "allow")),
        ("no scheme", ("", "", None, "allow")),
        (None, ("", "", None, "allow")),
    ],
)
def test_url_rules(spark, url, want):
    df = spark.createDataFrame([(1, url, None, "h")], "page_id long, url string, html string, host string")
    r = urlfilter.judge(df).first()
    assert (r.host, r.path, r.rule, r.verdict) == want


def test_link_propagation(spark):
    edges = [("a", "b", 1), ("a", "c", 3), ("b", "c", 1), ("c", "a", 1), ("d", "c", 2)]
    seeds = [("trust", "a", 1.0), ("trust", "b", 3.0), ("distrust", "c", 1.0)]
    got = {(r.kind, r.host): r.mass for r in urlfilter.propagate(spark.createDataFrame(seeds, "kind string, host string, weight double"), spark.createDataFrame(edges, "src string, dst string, n long")).collect()}
    for kind in ("trust", "distrust"):
        e = edges if kind == "trust" else [(b, a, n) for a, b, n in edges]
        s = {h: w for k, h, w in seeds if k == kind}
        front = {h: w / sum(s.values()) for h, w in s.items()}
        rank = dict(front)
        for _ in range(urlfilter.ROUNDS):
            new = {}
            for a, b, n in e:
                new[b] = new.get(b, 0) + urlfilter.DAMPING * front.get(a, 0) * n / sum(m for x, _, m in e if x == a)
            front = new
            for h, m in front.items():
                rank[h] = rank.get(h, 0) + m
        total = sum(rank.values())
        for h, m in rank.items():
            assert abs(got.get((kind, h), 0) - m / total) < 1e-6
    link = '<a class="x" HREF=\'//c.net/x\'>t</a> <a href="/in">i</a> <a href="http://u@D.net:80/">d</a>'
    pages = [(1, "http://x.com/de/1", None), (2, "http://y.net/1", '<a href="http://x.com/">'), (3, "http://z.net/", link), (3, "http://z.net/", link), (None, "http://y.net/2", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {(r.src, r.dst) for r in urlfilter.host_edges(df).collect()} == {("y.net", "x.com"), ("z.net", "c.net"), ("z.net", "d.net")}
    verdicts = [(r.page_id, r.verdict) for r in urlfilter.judge(df).collect()]
    assert sorted(verdicts, key=str) == [(1, "block"), (2, "block"), (3, "allow"), (3, "allow"), (None, "block")]
    assert urlfilter.judge(df.where("false")).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5)]
    rng.shuffle(edges)
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_join(spark):
    bands, r = jaccard.band_shape()
    assert bands * r <= jaccard.MOST_HASHES and 1 - (1 - 0.8**r) ** bands >= 0.99
    data = [(x[0], x[1]) for x in rows()]
    words = {}
    for i, t in data:
        words.setdefault(tuple(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())), []).append(i)
    sets = {w: {w[k : k + 5] for k in range(len(w) - 4)} or ({w} if w else set()) for w in words}
    near = {(a, b) for a, b in itertools.permutations(sets, 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert near
    got = [tuple(x) for x in jaccard.near_duplicates(frame(spark)).collect()]
    assert len(got) == len(data)
    by = {i: (c, n, k) for i, c, n, k in got if i is not None}
    class_of = {w: w for w in words}
    for _ in words:
        for a, b in near:
            class_of[a] = class_of[b] = min(class_of[a], class_of[b])
    groups = {}
    for w, ids in words.items():
        groups.setdefault(class_of[w], []).extend(i for i in ids if i is not None)
    for w, ids in words.items():
        for i in ids:
            if i is not None:
                assert by[i] == (min(groups[class_of[w]]), sum(a == w for a, _ in near), len(ids))
    kept = jaccard.one_of_each(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == sorted({min(g) for g in groups.values() if g})
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_blocks_of_a_large_group(spark):
    rng = random.Random(8)
    base = sentence(rng, 120).split()
    docs = []
    for i in range(450):
        w = list(base)
        w[rng.randrange(120)] = f"v{i}"
        docs.append((i, " ".join(w), *[None] * 9))
    got = jaccard.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    sets = [{tuple(w[k : k + 5]) for k in range(116)} for w in (d[1].split() for d in docs)]
    want = [sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for a in sets]
    assert {r.class_id for r in got} == {0} and [r.n_links for r in sorted(got, key=lambda r: r.doc_id)] == want
