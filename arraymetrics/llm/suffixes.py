"""Substring dedup over bytes by distributed prefix doubling.

Which byte strings of THRESHOLD bytes occur twice is what the neighbours in a suffix array would tell. Ranking all suffixes would move every byte of the
corpus many times over, so suffixes are ranked at *samples*: places where a rolling hash is smallest among its neighbours, which equal
texts pick alike. A sample's first rank is that of its first FIRST bytes. Then Spark sorts pairs of the ranks at a sample and at the sample 1 further
on, 2 further on, and at last as many further on as take the pair past the threshold; a sample whose pair stands at one place only has no
rank and takes no further part. The pieces between two samples that first ranks don't cover enter the pairs with their hash.

The last rank of a sample covers all strings that start between it and the sample before (its *gap*), so these repeat if it does. Where
it doesn't, though the ranks that lie inside a string do, the string is at the edge of a repeat; such strings, and those with no sample near, are sorted by
hash and compared with their neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import covered, dropped, grams8, mix, slices, span_hashes, span_keys, stored, text_buffer
from .substring import slide

THRESHOLD = 400
#: A sample's hash is the smallest of REACH on either side, each of GRAM bytes; its place is REACH before it, so all that picks it lies behind.
REACH, GRAM = 48, 8
#: Bytes of the first rank. A string finds its first sample up to NEAR bytes after its start.
FIRST = 150
NEAR = THRESHOLD - FIRST
#: Samples are more than REACH apart, so so many steps take a sample past NEAR.
STEPS = -(-NEAR // (REACH + 1))


def _samples(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the samples, whose context and first rank lie within one text, and the text of each."""
    n = len(data) - GRAM + 1
    if n < 2 * REACH + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = (mix(grams8(data)) >> np.uint64(32)).astype(np.uint32)
    low = slide(h, REACH, np.minimum, np.uint32(2**32 - 1))
    z = np.flatnonzero((h[REACH : n - REACH] < low[: n - 2 * REACH]) & (h[REACH : n - REACH] <= low[REACH + 1 : n - REACH + 1]))
    row = np.searchsorted(offs, z, side="right") - 1
    ok = z + FIRST <= offs[row + 1]
    return z[ok], row[ok]


def _table(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """The samples of a slice: text, number in it, place, hash of the first bytes, distance to the next sample (0: none) and hash of what
    its first bytes leave out of it, whether no sample NEAR behind follows, and hash of a side piece: for such last samples all from
    the sample before to the end, for other first samples what stands before."""
    z, row = _samples(data, offs)
    m = len(z)
    no = np.arange(m) - np.searchsorted(row, row)
    follows = np.append(row[1:] == row[:-1], False) if m else np.zeros(0, bool)
    gap = np.where(follows, np.append(z[1:], 0) - z, 0)
    more = np.zeros(m, np.uint64)
    wide = np.flatnonzero(gap > FIRST)
    more[wide] = span_hashes(data, z[wide] + FIRST, z[wide] + gap[wide])
    final = z[np.searchsorted(row, row, side="right") - 1] < z + NEAR
    begin = np.where(no > 0, z[np.maximum(np.arange(m) - 1, 0)], offs[row])
    side = np.zeros(m, np.uint64)
    apart = np.flatnonzero(final | (no == 0))
    side[apart] = span_hashes(data, begin[apart], np.where(final, offs[row + 1], z)[apart])
    return row, no, z - offs[row], span_hashes(data, z, z + FIRST), gap, more, final, side


#: What a text learns of a sample with a first rank: that the pair one further on has a rank; that the last pair has; that strings of such a gap are
#: compared all the same, on behalf of all gaps of its last rank.
PAIR, WHOLE, SPEAKS = 1, 2, 4


class _Text:
    """One text's samples, and the gaps between: gap j holds the strings whose first sample is j."""

    def __init__(self, text: np.ndarray, marks: np.ndarray):
        self.n, self.text = len(text), text
        self.z, _ = _samples(text, np.array([0, self.n]))
        m = len(self.z)
        self.starts = max(0, self.n - THRESHOLD + 1)  # strings start before this
        self.low = np.concatenate([[0], self.z[:-1] + 1]) if m else self.z
        self.high = np.minimum(self.z + 1, self.starts)
        kind = np.full(m, -1)
        kind[marks >> 3] = marks & 7
        self.whole = np.flatnonzero((kind >= 0) & (kind & WHOLE > 0) & (self.high > self.low))
        self.open = np.flatnonzero((kind >= 0) & ((kind & WHOLE == 0) | (kind & SPEAKS > 0)))
        self.dead = np.concatenate([[0], np.cumsum(kind < 0)])
        self.odd = np.concatenate([[0], np.cumsum((kind < 0) | (kind & PAIR == 0))])

    def singles(self) -> np.ndarray:
        """Strings to compare one by one: those of open gaps in which every rank repeats that lies inside the string, and those with no sample near."""
        z = self.z
        size = np.maximum(0, self.high - self.low)[self.open]
        i = np.repeat(self.low[self.open] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else np.zeros(0, np.int64)
        j = np.repeat(self.open, size)
        i, j = (x[z[j] - i <= NEAR] for x in (i, j)) if len(i) else (i, j)
        last = np.searchsorted(z, i + NEAR, side="right")
        pairs = np.maximum(j, last - 2)
        i = i[(self.dead[last] == self.dead[j]) & (self.odd[pairs] == self.odd[j])]
        every = np.arange(self.starts)
        lonely = every[np.append(z, np.iinfo(np.int64).max // 2)[np.searchsorted(z, every)] - every > NEAR]
        return np.unique(np.concatenate([i, lonely]))

    def compared(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The singles, their keys, the first place of each different one, and the number of that one for each."""
        at = self.singles()
        key = span_keys(self.text, at, at + THRESHOLD)
        _, first, which = np.unique(key[:, 0] ^ (key[:, 1] << np.uint64(1)), return_index=True, return_inverse=True)
        return at, key, first, which


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _rows(rows: list[tuple], digest: bool) -> list[pa.Array]:
    c = list(zip(*rows, strict=True)) or [()] * 5
    kept = pa.array([hashlib.sha256(x).hexdigest() for x in c[4]], pa.string()) if digest else pa.array(c[4], pa.binary())
    return [*(pa.array(x, pa.int64()) for x in c[:4]), kept]


_SAMPLES = "tk long, j int, z int, name long, gap int, more long, final boolean, side long"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = text_buffer(b.column("text"))
        tk = b.column("tk").to_numpy()
        for i, j in slices(offs):
            row, no, z, name, gap, more, final, side = _table(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            cols = [tk[i + row], no.astype(np.int32), z.astype(np.int32), name.view(np.int64), gap.astype(np.int32), more.view(np.int64), final, side.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], [x.split()[0] for x in _SAMPLES.split(", ")])


def _ranked(rows: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose keys stand at two places or more (tk, j), with the rank of the keys in sorted order, and the table of ranks. Each
    key is counted and sorted once, however many rows have it; the ranks are written, so that they stay as they are."""
    place = F.xxhash64("tk", "j")
    twice = rows.groupBy(*keys).agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo < hi").select(*keys, "lo")
    ranks = stored(twice.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id()))
    return rows.join(ranks, keys), ranks


def _further(ranks: DataFrame, name: str, offset: int) -> DataFrame:
    """Pairs of the ranks at a sample and ``offset`` samples on."""
    return ranks.join(ranks.select("tk", (F.col("j") - offset).alias("j"), F.col(name).alias("far")), ["tk", "j"])


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _last_keys(alive: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """For each sample the key that covers its gap's strings: the ranks of the longest runs from the sample before on, and up to the first
    sample NEAR behind, and that sample's own rank; no row where one of them has none."""
    all_ = alive.join(one, ["tk", "j"], "left").join(two, ["tk", "j"], "left")
    around = F.collect_list(F.struct("j", "z", "r", "one", "two")).over(Window.partitionBy("tk").orderBy("j").rowsBetween(-1, STEPS))

    def key(x: Column) -> Column:
        of = lambda j: F.get(F.filter(x["around"], lambda e: e["j"] == j), F.lit(0))
        ahead = F.get(F.filter(x["around"], lambda e: (e["j"] > x["j"]) & (e["z"] >= x["z"] + NEAR)), F.lit(0))
        return _bound(F.struct(ahead.alias("ahead"), of(x["j"] - F.when(x["j"] == 0, 0).otherwise(1)).alias("from")), lambda y: run(x, y, of))

    def run(x: Column, y: Column, of) -> Column:
        length = y["ahead"]["j"] - y["from"]["j"]  # samples passed
        two_, one_ = of(y["ahead"]["j"] - 4)["two"], of(y["ahead"]["j"] - 2)["one"]
        return F.when(length < 8, F.struct(
            F.when(length >= 4, 2).when(length >= 2, 1).otherwise(0).alias("depth"),
            F.when(length >= 4, y["from"]["two"]).when(length >= 2, y["from"]["one"]).otherwise(x["r"]).alias("a"),
            F.when(length >= 4, two_).when(length >= 2, one_).otherwise(x["more"]).alias("b"),
            y["ahead"]["r"].alias("end"), (y["ahead"]["z"] - y["from"]["z"]).alias("span"), F.when(x["j"] == 0, x["side"]).otherwise(0).cast("long").alias("side"),
        ))

    inner = all_.withColumn("around", around).where("NOT final").select("tk", "j", _bound(F.struct("j", "z", "r", "more", "side", "around"), key).alias("k")).select("tk", "j", "k.*")
    zero = F.lit(0).cast("long")
    tails = alive.where("final").select("tk", "j", F.lit(-1).alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("end"), F.lit(0).alias("span"), "side")
    return stored(inner.dropna().unionAll(tails))


def _marks(base: DataFrame) -> DataFrame:
    """tk and the marks (8 times the sample's number, plus PAIR, WHOLE and SPEAKS) of all samples with a first rank."""
    first = stored(base.select("tk", "text").mapInArrow(_sampled, _SAMPLES))
    named, ranks0 = _ranked(first, ["name"], "r")
    # texts equal as a whole have equal samples, and stand here once
    alive = stored(named.select("tk", "j", "z", "gap", "more", "final", "side", "r").repartition("tk").dropDuplicates(["tk", "j"]))
    dropped(first, ranks0)
    next_ = alive.select("tk", (F.col("j") - 1).alias("j"), F.col("r").alias("r1"), F.col("more").alias("more1"), F.col("gap").alias("gap1")).where("gap1 > 0")
    one, ranks1 = _ranked(alive.where("gap > 0").select("tk", "j", "r", "more", "gap").join(next_, ["tk", "j"]), ["r", "more", "gap", "r1", "more1", "gap1"], "one")
    one = stored(one.select("tk", "j", "one"))
    two, ranks2 = _ranked(_further(one, "one", 2), ["one", "far"], "two")
    two = stored(two.select("tk", "j", "two"))
    keys = _last_keys(alive, one, two)
    last, ranks3 = _ranked(keys, ["depth", "a", "b", "end", "span", "side"], "whole")
    last = last.select("tk", "j", "whole", (F.col("lo") == F.xxhash64("tk", "j")).alias("speaks"))
    judged = stored(alive.select("tk", "j", "r").join(one, ["tk", "j"], "left").join(last, ["tk", "j"], "left"))
    # a gap that repeats as a whole is settled; the first of its rank still speaks for it where others have an edge
    edges = judged.where("whole IS NULL").select("r").distinct().withColumn("edge", F.lit(True))
    bit = lambda c, v: F.when(c, v).otherwise(0)
    mark = F.col("j") * 8 + bit(F.col("one").isNotNull(), PAIR) + bit(F.col("whole").isNotNull(), WHOLE) + bit(F.col("speaks") & F.col("edge").isNotNull(), SPEAKS)
    marks = stored(judged.join(edges, "r", "left").groupBy("tk").agg(F.array_sort(F.collect_list(mark)).alias("marks")))
    dropped(alive, one, two, keys, ranks1, ranks2, ranks3, judged)
    return marks


def _doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the strings that other texts have too, from rows sorted by string, then text. Of a string that only one text is seen to have,
    that text's rows wait."""
    names = ["tk", "pos"]
    known, wait = None, None  # last string, its first text, whether another text has it; its waiting rows
    for b in batches:
        w1, w2, tk, pos = (b.column(c).to_numpy() for c in ("w1", "w2", "tk", "pos"))
        n = len(tk)
        if not n:
            continue
        new = np.ones(n, bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        goes_on = known is not None and (w1[0], w2[0]) == known[:2]
        new[0] = not goes_on
        at = np.flatnonzero(new)
        group = np.cumsum(new)  # 0: the string of the batch before
        firsts = np.concatenate([[known[2] if goes_on else 0], tk[at]])
        other = tk != firsts[group]
        shared = np.zeros(len(at) + 1, bool)
        shared[group[other]] = True
        if goes_on and known[3]:
            shared[0] = True
        if wait is not None and len(wait) and goes_on and shared[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(wait), known[2])), pa.array(wait)], names)
        hit = shared[group]
        yield pa.RecordBatch.from_arrays([pa.array(tk[hit]), pa.array(pos[hit])], names)
        end = group[-1]
        held = pos[(group == end) & ~hit] if not shared[end] else pos[:0]
        wait = np.concatenate([wait, held]) if end == 0 and wait is not None and not shared[0] else held
        known = (w1[-1], w2[-1], firsts[end], bool(shared[end]))


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes kept (``digest``: their SHA-256), for every row.

    A byte of a text's UTF-8 form goes if a string of THRESHOLD bytes that covers it also starts anywhere else: in another row, or at another
    place of the same text; such strings may overlap. All is judged on the input. A null text is empty; a text shorter than the threshold
    loses nothing; rows that repeat a longer text, ids and all, lose everything. Null ids stay null.

    Texts equal as a whole count once. Where many texts share a passage, each adds rows for the two edges of the passage, and no pairs.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select("*", F.xxhash64("text").alias("tk"))
    marks = _marks(base)
    ids = base.select("doc_id", "tk", F.xxhash64("text", F.lit(7)).alias("tk2"))
    texts = stored(ids.groupBy("tk", "tk2").agg(F.count("*").alias("n"), F.min("doc_id").alias("low")))
    copies = ids.join(texts.where("n > 1"), ["tk", "tk2"]).select("doc_id", "tk", F.coalesce(F.col("doc_id") == F.col("low"), F.col("low").isNull()).alias("stands"), F.lit(True).alias("copy")).distinct()
    key = lambda a, b: a["doc_id"].eqNullSafe(b["_d"]) & (a["tk"] == b["_t"])
    renamed = lambda df: df.withColumnsRenamed({"doc_id": "_d", "tk": "_t"})
    a, c = texts.join(marks, "tk").select(F.col("low").alias("doc_id"), "tk", "marks"), renamed(copies)
    notes = a.join(c, key(a, c), "full").select(F.coalesce("doc_id", "_d").alias("_d"), F.coalesce("tk", "_t").alias("_t"), "marks", "copy", "stands")
    noted = base.join(notes, key(base, notes), "left").select("doc_id", "tk", "text", "marks", F.coalesce("copy", F.lit(False)).alias("copy"), F.coalesce("stands", F.lit(True)).alias("stands"))
    schema = _DIGEST if digest else _RESULT
    names = [x.split()[0] for x in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that are settled, and the texts that need more; of equal texts one stands for all."""
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            ids_, copied, stand = (b.column(n).to_pylist() for n in ("doc_id", "copy", "stands"))
            for i, j in slices(offs):
                part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                z, row = _samples(part, o)
                bound = np.searchsorted(row, np.arange(j - i + 1))
                done, late = [], []
                for k in range(j - i):
                    n, listed = int(o[k + 1] - o[k]), b.column("marks")[i + k].is_valid
                    raw = part[o[k] : o[k + 1]]
                    if copied[i + k] and n >= THRESHOLD:
                        done.append((ids_[i + k], n, n, 1, b""))
                    if n >= THRESHOLD and (stand[i + k] or not copied[i + k]):
                        edges = np.concatenate([[-1], z[bound[k] : bound[k + 1]] - o[k]])
                        far = (np.diff(np.append(edges, n - THRESHOLD + 1 + NEAR)) > NEAR + 1).any()
                        if listed or far:
                            late.append(i + k)
                            continue
                    if not (copied[i + k] and n >= THRESHOLD):
                        done.append((ids_[i + k], n, 0, 0, raw.tobytes()))
                if done:
                    none = [pa.nulls(len(done), t) for t in (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.bool_())]
                    yield pa.RecordBatch.from_arrays([*_rows(done, digest), *none], [*names, "tk", "text", "marks", "copy"])
                if late:
                    none = [pa.nulls(len(late), pa.int64()) for _ in range(3)] + [pa.nulls(len(late), pa.string() if digest else pa.binary())]
                    take = [b.column(n).take(pa.array(late)) for n in ("doc_id", "tk", "text", "marks", "copy")]
                    yield pa.RecordBatch.from_arrays([take[0], *none, *take[1:]], [*names, "tk", "text", "marks", "copy"])

    mixed = stored(noted.mapInArrow(parse, f"{schema}, tk long, text string, marks array<int>, copy boolean"))
    dropped(marks, texts)
    done = mixed.where("text IS NULL").select(*names)
    open_ = mixed.where("text IS NOT NULL")

    def text_of(b: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, i: int) -> _Text:
        own = b.column("marks")[i]
        return _Text(data[offs[i] : offs[i + 1]], own.values.to_numpy(zero_copy_only=False).astype(np.int64) if own.is_valid else np.zeros(0, np.int64))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            tk, cols = b.column("tk").to_numpy(), []
            for i in range(len(b)):
                at, key_, first, _ = text_of(b, data, offs, i).compared()
                if len(at):
                    cols.append((np.full(len(first), tk[i]), at[first].astype(np.int32), key_[first, 0].view(np.int64), (key_[first, 1] >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                if cols and (sum(len(c[0]) for c in cols) > 100_000 or i + 1 == len(b)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*cols, strict=True)], ["tk", "pos", "w1", "w2"])
                    cols = []
            if cols:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*cols, strict=True)], ["tk", "pos", "w1", "w2"])

    # equal texts stand here once, so the text's hash names the place. One string is but one of a text's many, so no string has many of the rows
    single = open_.select("tk", "text", "marks").mapInArrow(strings, "tk long, pos int, w1 long, w2 int")
    hits = single.repartition("w1").sortWithinPartitions("w1", "w2", "tk").mapInArrow(_doubles, "tk long, pos int").groupBy(F.col("tk").alias("_t")).agg(F.collect_set("pos").alias("hits"))
    last = open_.where("NOT copy").join(hits, F.col("tk") == F.col("_t"), "left").select("doc_id", "text", "marks", "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            rows = []
            for i in range(len(b)):
                t = text_of(b, data, offs, i)
                at, _, first, which = t.compared()
                hit = np.isin(at[first], np.array(b.column("hits")[i].as_py() or [], np.int64)) | (np.bincount(which, minlength=len(first)) > 1)
                start = at[hit[which]] if len(at) else at
                gone = covered(t.n, np.concatenate([start, t.low[t.whole]]), np.concatenate([start + THRESHOLD, t.high[t.whole] - 1 + THRESHOLD]))
                spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
                rows.append((b.column("doc_id")[i].as_py(), t.n, int(gone.sum()), spans, t.text[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays(_rows(rows, digest), names)

    return done.unionAll(last.mapInArrow(cut, schema))


def op9_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat elsewhere, 400 in a row."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
