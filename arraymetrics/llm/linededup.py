"""Near-duplicate lines by a segment-partition edit join, in DataFrame functions only.

A line is cut into MAX_EDITS + 1 segments. Two lines within MAX_EDITS edits share one segment of the shorter line unchanged, at a
place in the longer one that the lengths narrow to a few; so lines are joined on hashes of (length, segment number, segment), and the
pairs found are verified with a bit-parallel edit distance over the 2 * MAX_EDITS + 1 diagonals that matter.

With ``edits`` None the bound grows with the line (``allowed``). Lines of one bound t form a band and are cut alike, into t + 1 segments as
long as the band's shortest line has room for, the first half counted from the line's start and the rest from its end. One
segment is unchanged with as many edits before it as its number says and no more than t less that behind it, so it is probed within that
many places: about t * t / 2 probes, an eighth of the line's length.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, dropped, stored

MAX_EDITS = 2
#: Shorter lines are compared for equality only: a few edits would make them anything. No less than (MAX_EDITS + 1) * MAX_EDITS.
MIN_CHARS = 24
#: The shortest line that ``allowed`` gives an edit.
LEAST_CHARS = 12
#: Rounds in which the segments of growing bounds are probed, each a part of their numbers, so that a part of the probes is on disk at once.
PASSES = 4
#: Lines with one segment in common beyond which they meet under a bound only, and the buckets of that bound.
CROWD, BUCKETS = 8, 256
#: Earliest lines of a crowd that all its lines meet first.
FIRST = 4
#: Lines of one pivot from which on they are measured by it; the characters of its windows, and how far from its place there a line may have one.
FOLLOWERS, WINDOW, DRIFT = 64, 16, 32
#: Characters by which equal beginnings and ends are measured.
STEPS = tuple(1 << k for k in range(14, 1, -1))
_LAST = (1 << 63) - 1


def _hash(line: Column, n: Column, edits: int, i: Column, shift: Column) -> Column:
    """Hash of segment ``i`` of a line of ``n`` characters, read ``shift`` characters later in ``line``. Segments are even parts."""
    cut = lambda k: F.floor(k * n / (edits + 1)).cast("int")
    return F.xxhash64(F.substr(line, cut(i) + shift + 1, cut(i + 1) - cut(i)), n, i)


def _by_bytes(line: Column, hashes: Callable[[Column], Column]) -> Column:
    """``hashes`` of parts of a line. A line of one byte a character is cut as bytes, which needs no count of the characters before a part; the hashes
    are the same."""
    return F.when(F.octet_length(line) == F.length(line), hashes(line.cast("binary"))).otherwise(hashes(line))


def _places(edits: int, probes: bool) -> list[tuple[int, int, int]]:
    """(gap, segment, shift) under which a line can be found, or finds lines that are ``gap`` characters shorter, for every gap up to ``edits``. Of a segment's
    possible places only those are taken that leave enough edits for both sides (the multi-match-aware choice)."""
    if not probes:
        return [(0, i, 0) for i in range(edits + 1)]
    return [
        (gap, i, shift)
        for gap in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, gap - (edits - i)), min(i, gap + (edits - i)) + 1)
    ]


def _parts(long: DataFrame, name: str, edits: int, probes: bool) -> DataFrame:
    """A row (``name``: the key, ``part``: the hash) for each place of each line. The places are dealt out first: hashes of all of them in one row make a method so
    long that the JVM doesn't compile it."""
    at = F.explode(F.array(*(F.struct(*(F.lit(x).alias(k) for k, x in zip("gis", place, strict=True))) for place in _places(edits, probes)))).alias("at")
    rows = long.select(F.col("key").alias(name), "line", "chars", at)
    part = _by_bytes(F.col("line"), lambda x: _hash(x, F.col("chars") - F.col("at.g"), edits, F.col("at.i"), F.col("at.s")))
    return rows.select(name, F.lit(0).alias(f"n_{name}"), part.alias("part"))  # the hashes tell the lengths themselves


def _pieces_fit(a: Column, b: Column, edits: int) -> Column:
    """True for all lines within ``edits`` edits: of three times as many even pieces of ``a`` all but ``edits`` are unchanged, so they stand
    in ``b`` no more than ``edits`` characters away. Far cheaper than the distance."""
    n, m = F.length(a), 3 * edits
    cut = lambda k: F.floor(k * n / m).cast("int")
    stands = (F.substr(b, F.greatest(cut(k) - edits, F.lit(0)) + 1, cut(k + 1) - cut(k) + 2 * edits).contains(F.substr(a, cut(k) + 1, cut(k + 1) - cut(k))) for k in range(m))
    return sum(x.cast("int") for x in stands) >= m - edits


def allowed(n: Column) -> Column:
    """Edits between a line of ``n`` characters and a longer one that leave them near: one in 12 characters below 36, from there half the
    root of the length (5 at 100, 10 at 400)."""
    return F.when(n < 36, F.floor(n / LEAST_CHARS)).otherwise(F.floor(F.sqrt(n) / 2)).cast("int")


def _shortest(t: Column) -> Column:
    """Characters of the shortest line with ``t`` allowed edits."""
    return F.when(t < 3, t * LEAST_CHARS).otherwise(4 * t * t)


def _cut(line: Column, n: Column, t: Column, i: Column, shift: Column) -> Column:
    """Hash of segment ``i`` of the band ``t``, read ``shift`` characters later in ``line``."""
    size = F.floor(_shortest(t) / (t + 1)).cast("int")
    at = F.when(2 * i <= t, i * size).otherwise(n - (t + 1 - i) * size)
    return F.xxhash64(F.substr(line, (at + shift + 1).cast("int"), size), t, i)


def _numbers(t: Column, turn: int) -> Column:
    """The segments of the band ``t`` that are probed in round ``turn``."""
    return F.filter(F.sequence(F.lit(0), t), lambda i: i % PASSES == turn)


def _band_index(line: Column, n: Column, turn: int) -> Column:
    """As ``_index``, for the line's own bound."""
    return _by_bytes(line, lambda x: F.transform(_numbers(allowed(n), turn), lambda i: _cut(x, n, allowed(n), i, F.lit(0))))


def _band_probes(line: Column, n: Column, turn: int) -> Column:
    """Hashes under which a line finds lines no longer than itself: of its own band, and of the one before if its longest lines can
    grow to this one."""

    def places(text: Column, t: Column) -> Column:
        def around(i: Column) -> Column:
            most = F.when(2 * i <= t, i).otherwise(t - i)
            return F.transform(F.sequence(-most, most), lambda shift: _cut(text, n, t, i, shift))

        return F.flatten(F.transform(_numbers(t, turn), around))

    t = allowed(n)
    bands = F.filter(F.array(t, t - 1), lambda x: (x == t) | ((x > 0) & (n < _shortest(t) + x)))
    return _by_bytes(line, lambda text: F.array_distinct(F.flatten(F.transform(bands, lambda x: places(text, x)))))


def edit_distance(a: Column, b: Column, edits: int = MAX_EDITS) -> Column:
    """Edits between two strings if they are ``edits`` at most, else a greater number; for strings whose lengths differ by no more than
    that. What both begin and end with is left out first, but for a few characters.

    Column j of the matrix is held as bits for the rows j - edits to j + edits: where the value goes up (vp) and down (vn)
    from the row before. Rows outside count as one more than their neighbour, which no cheap path needs.
    """
    # one-element arrays bind a value to a name, so that it is worked out once: here the characters, above the match mask
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))

    def distance(x: Column) -> Column:
        return _walk(x["p"], x["t"], edits)

    def inner(x: Column) -> Column:
        short, n, m = F.least(x["n"], x["m"]), x["n"], x["m"]

        def same(begun: Column | None) -> Column:
            """Characters that both begin with, or end with behind the first ``begun``, to within the least of STEPS."""

            def longer(k: Column, s: Column) -> Column:
                cut = lambda c, size: F.substr(c, k + 1 if begun is None else size - k - s + 1, s)
                return F.when((k + s + (F.lit(0) if begun is None else begun) <= short) & (cut(x["a"], n) == cut(x["b"], m)), k + s).otherwise(k)

            return F.aggregate(F.array(*map(F.lit, STEPS)), F.lit(0), longer)

        def cut(y: Column) -> Column:
            middle = lambda c, size: chars(F.substr(c, y["p"] + 1, size - y["p"] - y["q"]))
            return F.struct(middle(x["a"], n).alias("p"), middle(x["b"], m).alias("t"))

        return bound(bound(same(None), lambda p: F.struct(p.alias("p"), same(p).alias("q"))), cut)

    chars = lambda c: F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))
    return bound(bound(F.struct(a.alias("a"), b.alias("b"), F.length(a).alias("n"), F.length(b).alias("m")), inner), distance)


def _walk(p: Column, t: Column, edits: int) -> Column:
    width = 2 * edits + 1
    every = (1 << width) - 1
    long = lambda x: F.lit(x).cast("long")
    diagonal = F.size(p) - F.size(t)

    def step(s: Column, j: Column) -> Column:
        match = long(0)
        here = F.get(t, j - 1)
        for b in range(width):
            row = j + (b - edits)  # from 1
            match = match.bitwiseOR(F.when((row >= 1) & (F.get(p, row - 1) == here), long(1 << b)).otherwise(long(0)))

        def advance(m: Column) -> Column:
            vp = F.shiftright(s["vp"], 1).bitwiseOR(long(1 << (width - 1)))
            vn = F.shiftright(s["vn"], 1)
            d0 = ((m.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(m).bitwiseOR(vn).bitwiseAND(long(every))
            hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(long(every))
            hn = d0.bitwiseAND(vp)
            up = F.shiftleft(hp, 1).bitwiseOR(long(1))
            same = F.call_function("shiftright", d0, (diagonal + edits).cast("int")).bitwiseAND(long(1)) == 1
            return F.struct(
                F.shiftleft(hn, 1).bitwiseOR(F.bitwise_not(d0.bitwiseOR(up))).bitwiseAND(long(every)).alias("vp"),
                up.bitwiseAND(d0).alias("vn"),
                (s["d"] + F.when((j + diagonal >= 1) & ~same, 1).otherwise(0)).alias("d"),
            )

        return F.when(s["d"] > edits, s).otherwise(F.get(F.transform(F.array(match), advance), F.lit(0)))

    start = F.struct(long(every & ~((1 << (edits + 1)) - 1)).alias("vp"), long(0).alias("vn"), F.abs(diagonal).alias("d"))
    return F.when(F.size(t) == 0, F.size(p)).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1))), start, step, lambda s: s["d"]))


def _lines(docs: DataFrame) -> DataFrame:
    """Every line but blank ones: its document (``doc``: the id, ``place``: the id to order by, ``dk``: hash of the text), number and
    key. ``other`` is a second hash that tells apart lines of one key."""
    at = F.posexplode(F.split("text", "\n", -1)).alias("no", "line")
    rows = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc"), "text").select("doc", F.xxhash64("text").alias("dk"), at)
    return rows.where(F.col("line").rlike(r"\S")).select("doc", F.coalesce("doc", F.lit(_LAST)).alias("place"), "dk", "no", F.xxhash64("line").alias("key"), F.xxhash64("line", F.lit(7)).alias("other"), "line")


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each distinct line: key, first place (struct of place and number), n, and the text and its length if long enough
    to be compared by edits. Lines whose keys collide are left out, and so are never removed. Written in buckets of ``key``, so
    that lines are looked up without shuffling their texts again."""
    text = F.when(F.length("line") >= min_chars, F.col("line"))
    grouped = _lines(docs).groupBy("key").agg(F.min("other").alias("_a"), F.max("other").alias("_b"), F.min(F.struct("place", "no")).alias("first"), F.count("*").alias("n"), F.first(text, ignorenulls=True).alias("line"))
    return bucketed(grouped.where("_a = _b").select("key", "first", "n", "line", F.length("line").alias("chars")), "key")


def _odd(line: Column) -> Column:
    """Which of BUCKETS hold an odd number of the line's character pairs, as an array of 64-bit masks."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(line) - 1), lambda i: F.pmod(F.hash(F.substr(line, i, F.lit(2))), F.lit(BUCKETS)))

    def masks(p: Column) -> Column:
        flip = lambda k: lambda s, x: F.when(F.floor(x / 64) == k, s.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x % 64))).otherwise(s)
        return F.array(*(F.aggregate(p, F.lit(0).cast("long"), flip(k)) for k in range(BUCKETS // 64)))

    return F.get(F.transform(F.array(pairs), masks), F.lit(0))


def _close(a: Column, b: Column, edits: int | Column) -> Column:
    """True for all lines within ``edits`` edits: an edit takes away two character pairs at most and adds two."""
    out = F.lit(0)
    for k in range(BUCKETS // 64):
        out = out + F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return out <= 4 * edits


def _later(pairs: DataFrame, long: DataFrame) -> DataFrame:
    """Keys of the later lines of those pairs (a, b) that lie within what ``allowed`` gives their shorter one."""
    text = lambda k: long.select(F.col("key").alias(k), F.col("first").alias(f"f{k}"), F.col("line").alias(f"l{k}"))
    half = stored(pairs.join(text("a"), "a"))
    # Spark's own distance, banded by the bound; -1 beyond it
    near = half.join(text("b"), "b").where(F.call_function("levenshtein", F.col("la"), F.col("lb"), allowed(F.least(F.length("la"), F.length("lb")))) >= 0)
    near = stored(near.select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("key")).distinct())
    dropped(half)
    return near


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("long", "short").alias("a"), F.greatest("long", "short").alias("b")).distinct()


def _flagged(side: DataFrame, key: str, gone: DataFrame | None) -> DataFrame:
    """``side`` with ``g_`` and the name of its key: whether the line is known to go."""
    if gone is None:
        return side.withColumn(f"g_{key}", F.lit(False))
    return side.join(gone.select(F.col("key").alias(key), F.lit(True).alias(f"g_{key}")), key, "left").withColumn(f"g_{key}", F.coalesce(f"g_{key}", F.lit(False)))


def _may_be_near() -> Column:
    """For a pair of crowded lines: lengths and character pairs allow it."""
    bound = allowed(F.col("n_short"))
    return (F.col("long") != F.col("short")) & (F.col("n_long") >= F.col("n_short")) & (F.col("n_long") <= F.col("n_short") + bound) & _close(F.col("bag"), F.col("other"), bound)


def _best_place(piece: Column, text: Column) -> Column:
    """Least edits between ``piece``, an array of WINDOW characters, and any part of the array ``text`` (Myers' bit vectors, with a free beginning and end)."""
    long = lambda x: F.lit(x).cast("long")
    every = long((1 << WINDOW) - 1)
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    top = lambda x: F.shiftright(x, WINDOW - 1).bitwiseAND(long(1))
    up = lambda x: F.shiftleft(x, 1).bitwiseAND(every)

    def step(s: Column, c: Column) -> Column:
        match = long(0)
        for i in range(WINDOW):
            match = match.bitwiseOR(F.when(F.get(piece, F.lit(i)) == c, long(1 << i)).otherwise(long(0)))

        def steps(m: Column) -> Column:
            d0 = ((m.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"])).bitwiseOR(m).bitwiseAND(every)
            return F.struct(m.bitwiseOR(s["vn"]).alias("v"), s["vn"].bitwiseOR(F.bitwise_not(d0.bitwiseOR(s["vp"])).bitwiseAND(every)).alias("hp"), s["vp"].bitwiseAND(d0).alias("hn"))

        def advance(x: Column) -> Column:
            d = s["d"] + top(x["hp"]) - top(x["hn"])
            vp = up(x["hn"]).bitwiseOR(F.bitwise_not(x["v"].bitwiseOR(up(x["hp"]))).bitwiseAND(every))
            return F.struct(vp.alias("vp"), up(x["hp"]).bitwiseAND(x["v"]).alias("vn"), d.alias("d"), F.least(s["best"], d).alias("best"))

        return bound(bound(match, steps), advance)

    start = F.struct(every.alias("vp"), long(0).alias("vn"), long(WINDOW).alias("d"), long(WINDOW).alias("best"))
    return F.aggregate(text, start, step, lambda s: s["best"].cast("int"))


def _off(line: Column, pivot: Column) -> Column:
    """The windows of ``pivot`` (w: number) that ``line`` doesn't have unchanged near their place, one behind the other, and d: the least edits to any part of
    ``line`` around that place. Null for a line that lacks half of them or more."""
    count = F.floor(F.length(pivot) / WINDOW).cast("int")
    piece = lambda w: F.substr(pivot, w * WINDOW + 1, F.lit(WINDOW))

    def look(s: Column, w: Column) -> Column:
        found = F.position(piece(w), line, F.greatest(s["at"], w * WINDOW + 1 - DRIFT))
        near = (found > 0) & (found <= w * WINDOW + 1 + DRIFT)
        step = lambda x: F.struct(F.when(near, found + WINDOW).otherwise(s["at"]).alias("at"), F.when(near, s["off"]).otherwise(F.concat(s["off"], F.array(w))).alias("off"))
        return F.get(F.transform(F.array(F.lit(0)), step), F.lit(0))

    def measured(w: Column) -> Column:
        around = DRIFT + allowed(F.length(line))
        first = F.greatest(w * WINDOW - around, F.lit(0))
        chars = F.struct(F.split(piece(w), "").alias("p"), F.split(F.substr(line, first + 1, w * WINDOW + WINDOW + around - first), "").alias("t"))
        return F.get(F.transform(F.array(chars), lambda x: F.struct(w.alias("w"), _best_place(x["p"], x["t"]).alias("d"))), F.lit(0))

    off = F.aggregate(F.sequence(F.lit(0), count - 1), F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("off")), look, lambda s: s["off"])
    return F.when(count >= 4, F.get(F.transform(F.array(off), lambda x: F.when(2 * F.size(x) < count, F.transform(x, measured))), F.lit(0)))


def _measured(rows: DataFrame, long: DataFrame) -> DataFrame:
    """key, ``pivot`` and ``off`` (as ``_off``) of crowded lines (``rows``: key, f, parts). A line's pivot is the earliest line of its largest crowd."""
    rows = rows.withColumn("part", F.explode("parts")).drop("parts")
    heads = rows.groupBy("part").agg(F.count("*").alias("size"), F.min(F.struct("f", "key")).alias("head"))
    rows = stored(rows.join(heads, "part").groupBy("key").agg(F.min(F.struct(-F.col("size"), F.col("head")))["head"]["key"].alias("pivot")))
    text = lambda key, name: long.select(F.col("key").alias(key), F.col("line").alias(name))
    pivots = stored(rows.groupBy("pivot").count().where(F.col("count") >= FOLLOWERS).select("pivot").join(text("pivot", "as"), "pivot"))
    out = stored(rows.join(pivots, "pivot").join(text("key", "line"), "key").select("key", "pivot", _off(F.col("line"), F.col("as")).alias("off")).where("off IS NOT NULL"))
    dropped(rows, pivots)
    return out


def _like(bound: Column) -> Column:
    """For a pair of lines of one pivot: true if they are within ``bound`` edits. A window that one has unchanged is a part of its own text, so the pair has no fewer edits there
    than the other needs for the window at its best place, and parts that don't overlap add up."""

    def beyond(a: str, b: str) -> Column:
        return F.aggregate(F.filter(b, lambda x: ~F.array_contains(F.col(f"{a}.w"), x["w"])), F.lit(0), lambda s, x: s + x["d"])

    return F.coalesce((F.col("p_long") != F.col("p_short")) | ((beyond("o_long", "o_short") <= bound) & (beyond("o_short", "o_long") <= bound)), F.lit(True))


def _crowd_first(a: DataFrame, b: DataFrame, long: DataFrame, gone: DataFrame | None) -> DataFrame:
    """Keys of lines that are known to go once those of crowds (a, b: as ``_candidates`` has them), unless they were known before, have met the FIRST earliest
    lines there."""
    x, y = rows = [stored(_flagged(side, key, gone).withColumn("part", F.explode("parts")).drop("parts")) for key, side in (("long", a), ("short", b))]
    earliest = lambda x, f: x.withColumn("_r", F.row_number().over(Window.partitionBy("part").orderBy(f))).where(F.col("_r") <= FIRST).drop("_r")
    met = lambda x, y, later: x.join(y.withColumnRenamed("bag", "other"), (x["part"] == y["part"]) & later & _may_be_near()).select("long", "short")
    some = met(x.where("NOT g_long"), earliest(y, "f_short"), F.col("f_long") > F.col("f_short")).unionAll(met(earliest(x, "f_long"), y.where("NOT g_short"), F.col("f_short") > F.col("f_long")))
    some = stored(_unordered(some))
    found = _later(some, long)
    dropped(some, *rows)
    known = stored(found if gone is None else found.unionAll(gone).distinct())
    dropped(found, *([] if gone is None else [gone]))
    return known


def _crowd_rest(sides: list[tuple[DataFrame, DataFrame]], long: DataFrame, gone: DataFrame) -> DataFrame:
    """Pairs (a, b) of crowded lines that may be near, each once, of all rounds (``sides``).

    All variants of one line are near each other, so their pairs grow with the square of their number. But a line goes for one near line before it. So each
    line has met the FIRST earliest lines of its crowds before, and pairs whose later line is known to go are not made. All others are, in the first crowd
    that both lines are in, unless what both have of one pivot tells them apart.
    """

    def whole(tables: list[DataFrame], key: str) -> DataFrame:
        rows = functools.reduce(DataFrame.unionAll, tables).groupBy(key, f"n_{key}").agg(F.array_sort(F.flatten(F.collect_list("parts"))).alias("parts"), F.first("bag").alias("bag"), F.first(f"f_{key}").alias(f"f_{key}"))
        return stored(rows)

    tables = [whole([side[k] for side in sides], key) for k, key in enumerate(("long", "short"))]
    side = lambda t, key: t.select(F.col(key).alias("key"), F.col(f"f_{key}").alias("f"), "parts")
    measured = _measured(side(tables[0], "long").unionAll(side(tables[1], "short")), long)
    by_pivot = lambda t, key: t.join(measured.select(F.col("key").alias(key), F.col("pivot").alias(f"p_{key}"), F.col("off").alias(f"o_{key}")), key, "left")
    x, y = (by_pivot(_flagged(t, key, gone), key) for t, key in zip(tables, ("long", "short"), strict=True))
    x = x.select("*", F.explode("parts").alias("part"))
    y = y.withColumnRenamed("bag", "other").select("*", F.posexplode("parts").alias("at", "part")).withColumn("before", F.expr("slice(parts, 1, at)")).drop("parts", "at")
    goes = F.when(F.col("f_long") < F.col("f_short"), F.col("g_short")).otherwise(F.col("g_long"))
    once = (F.col("n_long") != F.col("n_short")) | (F.col("long") < F.col("short"))  # lines of one length find each other from both sides
    pairs = x.join(y, (x["part"] == y["part"]) & ~goes & once & _may_be_near() & ~F.exists("before", lambda p: F.array_contains(F.col("parts"), p)) & _like(allowed(F.col("n_short"))))
    pairs = stored(_unordered(pairs))
    dropped(*tables, measured)
    return pairs


def _candidates(long: DataFrame, edits: int | None, turn: int) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """Pairs of lines (a, b) with a segment in common, written.

    A segment that more than CROWD lines share (the variants of one template, say) would pair all of them. Of such segments the probes
    only learn that they are crowded; their lines meet under a bound on their character pairs, which no near line exceeds. With growing bounds they have not
    met yet, and the lines that look for others and those that are found come too, each with its crowded segments.
    """
    line = F.col("line")
    n = F.col("chars") if edits is None else F.lit(0)
    bound = F.lit(edits) if edits is not None else allowed(F.col("n_short"))
    fits = (F.col("n_long") >= F.col("n_short")) & (F.col("n_long") <= F.col("n_short") + bound)
    parts = lambda name, hashes: long.select(F.col("key").alias(name), n.alias(f"n_{name}"), F.explode(hashes(line, n, turn)).alias("part")) if edits is None else _parts(long, name, edits, name == "long")
    index = stored(parts("short", _band_index))
    crowds = stored(index.groupBy("part").count().where(F.col("count") > CROWD).select("part"))
    probes = parts("long", _band_probes)
    single = index.join(crowds, "part", "left_anti").select("part", "short", "n_short").unionAll(crowds.select("part", F.lit(None).cast("long"), F.lit(None).cast("int")))
    met = stored(probes.join(single, "part").where(F.col("short").isNull() | ((F.col("long") != F.col("short")) & fits)).select("long", "part", "short"))

    crowded = lambda rows, key: stored(rows.groupBy(key).agg(F.collect_set("part").alias("parts")).join(long.select(F.col("key").alias(key), n.alias(f"n_{key}"), "line", "first"), key).select(key, f"n_{key}", "parts", _odd(F.col("line")).alias("bag"), *([F.col("first").alias(f"f_{key}")] if edits is None else [])))
    bags = crowded(met.where("short IS NULL").select("long", "part"), "long"), crowded(index.join(crowds, "part", "left_semi").select("short", "part"), "short")
    pairs = met.where("short IS NOT NULL").select("long", "short")
    if edits is not None:
        a, b = (x.withColumn("part", F.explode("parts")).drop("parts") for x in bags)
        b = b.withColumnRenamed("bag", "other")
        inside = a.join(b, (a["part"] == b["part"]) & (F.col("long") != F.col("short")) & fits & _close(F.col("bag"), F.col("other"), bound))
        pairs = pairs.unionAll(inside.select("long", "short"))
    pairs = stored(_unordered(pairs))
    dropped(index, crowds, met, *(bags if edits is not None else ()))
    return pairs, bags if edits is None else None


def near_lines(table: DataFrame, edits: int | None = MAX_EDITS) -> DataFrame:
    """Keys of the lines that lie within ``edits`` edits (None: as ``allowed``) of another line whose first place comes earlier."""
    long = table.where("line IS NOT NULL")
    if edits is None:
        turns, sides, gone = [], [], None
        for turn in range(PASSES):
            pairs, bags = _candidates(long, None, turn)
            gone = _crowd_first(*bags, long, gone)
            turns.append(pairs)
            sides.append(bags)
        turns.append(_crowd_rest(sides, long, gone))
        dropped(*(x for bags in sides for x in bags))
        pairs = functools.reduce(DataFrame.unionAll, turns).distinct()
        return _later(pairs, long).unionAll(gone).distinct()

    pairs, _ = _candidates(long, edits, 0)
    text = lambda k: long.select(F.col("key").alias(k), F.col("first").alias(f"f{k}"), F.col("line").alias(f"l{k}"))
    half = stored(pairs.join(text("a"), "a"))
    dropped(pairs)
    near = half.join(text("b"), "b").where(_pieces_fit(F.col("la"), F.col("lb"), edits)).where(edit_distance(F.col("la"), F.col("lb"), edits) <= edits)
    near = stored(near.select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("key")).distinct())
    dropped(half)
    return near


def removals(docs: DataFrame, edits: int | None = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, dk and ``gone``, the sorted numbers (from 0) of the lines to remove, for each document that has any."""
    table = line_table(docs, min_chars)
    found = near_lines(table, edits)
    near = found.withColumn("near", F.lit(True))
    judged = table.select("key", "first", "n").join(near, "key", "left").where("n > 1 OR near").select("key", "first", F.coalesce("near", F.lit(False)).alias("near"))
    hit = _lines(docs).select("doc", "place", "dk", "no", "key").join(judged, "key").where(F.col("near") | (F.col("first") != F.struct("place", "no")))
    gone = stored(hit.groupBy("doc", "dk").agg(F.array_sort(F.collect_set("no")).alias("gone")))
    dropped(table, found)
    return gone


def deduplicate(docs: DataFrame, edits: int | None = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, with the duplicate lines taken out of ``text``.

    Lines end at ``\\n``. Places are ordered by doc_id (nulls last), then line number. A line goes if the same line, or one
    within ``edits`` edits (None: as ``allowed``; for lines of ``min_chars`` characters and more), has an earlier place, itself removed or not. Blank lines
    stay; null and empty texts stay as they are; a text whose lines all go becomes empty. Rows that repeat one document are judged alike, as
    one. ``n_chars``, where there is one, is set anew.
    """
    gone = removals(docs, edits, min_chars).select(F.col("doc").alias("__am_doc"), F.col("dk").alias("__am_dk"), F.col("gone").alias("__am_gone"))
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__am_gone", i)), "\n")
    out = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["__am_doc"]) & (F.xxhash64(docs["text"]) == gone["__am_dk"]), "left")
    out = out.withColumn("text", F.when(F.col("__am_gone").isNull(), F.col("text")).when(F.size("__am_gone") == F.size(lines), F.lit("")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__am_gone").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def decisions(docs: DataFrame, edits: int | None = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_lines (numbers from 0, as text with commas) of every row of ``docs``; see
    ``deduplicate``. A null text has no lines."""
    gone = removals(docs, edits, min_chars)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_k"), F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"))
    out = rows.join(gone, rows["doc_id"].eqNullSafe(gone["doc"]) & (F.col("_k") == F.col("dk")), "left")
    return out.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed_lines"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines to remove from every document."""
    return decisions(spark.read.parquet(f"{sf_dir}/documents.parquet"))
