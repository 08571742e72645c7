"""Substring dedup by relative Lempel-Ziv parsing over words.

The reference is the corpus itself. It is indexed in two steps. Anchors (of the short word runs inside each window the one with the smallest hash,
so that equal windows hold the same anchor whatever stands around them) tell which windows another text can have at all. Those windows
alone are indexed by their exact hash, with the earliest document that has it and a place in it. Each document is then parsed greedily from the
left: a factor begins at a window that the index has in an earlier document, copies from that place, and goes on as long as the next
window is indexed one word on in the same document. All factors have a window's length at least; where one ends another may overlap it, copying from
elsewhere, so that the words covered are those of all indexed windows, to the word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, covered, slices, stored, text_buffer

WINDOW = 50
#: Words of an anchor.
GRAM = 12
_MOST = np.uint64(2**64 - 1)


def slide(x: np.ndarray, width: int, op, pad) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over the ``width`` values from each place on; ``pad`` stands past the end."""
    y, done = np.concatenate([x, np.full(width, pad, x.dtype)]), 1
    while done * 2 <= width:
        y[:-done] = op(y[:-done], y[done:])
        done *= 2
    if done < width:
        y[: -(width - done)] = op(y[: -(width - done)], y[width - done :])
    return y[: len(x)]


def _window_anchors(w: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word: the smallest gram hash inside the window that starts there (undefined where none does), and whether one does."""
    h = np.full(len(w), _MOST)
    at, x, _ = w.windows(GRAM)
    h[at] = x
    ok = w.left() >= window
    return slide(h, window - GRAM + 1, np.minimum, _MOST), ok


def _runs(candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of every maximal run of candidate windows."""
    d = np.diff(np.concatenate([[0], candidate.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def factors(pos: np.ndarray, doc: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """The greedy parse of a document from its indexed windows (by place): first word and words of each factor, document and place that it copies from."""
    order = np.argsort(pos)
    pos, doc, at = pos[order], doc[order], at[order]
    begins = np.ones(len(pos), bool)
    begins[1:] = (np.diff(pos) != 1) | (np.diff(doc) != 0) | (np.diff(at) != 1)
    first = np.flatnonzero(begins)
    return pos[first], np.diff(np.append(first, len(pos))) + window - 1, doc[first], at[first]


def _kept(data: np.ndarray, w: Words, gone: np.ndarray) -> bytes:
    keep = np.flatnonzero(~gone).tolist()
    raw = data.tobytes()
    s, e = w.start.tolist(), w.end.tolist()
    return b" ".join([raw[s[k] : e[k]] for k in keep])


_FACTOR = pa.struct([("start", pa.int64()), ("words", pa.int64()), ("ref_doc", pa.int64()), ("ref_start", pa.int64())])
_RESULT = "doc_id long, n_words long, n_removed long, kept string, factors array<struct<start: long, words: long, ref_doc: long, ref_start: long>>"
_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _final(kept: bytes, digest: bool) -> str:
    return hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace")


def remove_repeats(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, the words kept, joined by one space, and the factors that went; or, with ``digest``, the SHA-256 of the words kept
    in place of the last two. One row for every row.

    Words are runs of anything but space and 0x09-0x0D. A word goes if one of its windows of ``window`` words also starts in a
    document with a smaller doc_id; all is judged on the input. A null text has no words; a text shorter than a window loses none; a
    null id is neither smaller nor larger than any. Rows that repeat a document are judged alike, and one doc_id never repeats itself.

    Texts equal as a whole are settled by their hashes. Of the others only the windows of factors are shuffled, each by its own
    hash with partial minima, so that a passage which a third of the documents hold adds a row for each place and no pairs.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select("*", F.xxhash64("text").alias("tk"))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            for i, j in slices(offs):
                w = Words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], "space")
                low, ok = _window_anchors(w, window)
                row = np.repeat(np.arange(j - i), np.diff(w.doc))
                new = ok.copy()
                new[1:] &= (low[1:] != low[:-1]) | ~ok[:-1] | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                take = lambda n: b.column(n).slice(i, j - i).take(pa.array(row[at]))
                yield pa.RecordBatch.from_arrays([take("doc_id"), take("tk"), pa.array(low[at].view(np.int64))], ["doc_id", "tk", "anchor"])

    held = stored(base.where("doc_id IS NOT NULL").mapInArrow(anchors, "doc_id long, tk long, anchor long"))
    shared = held.groupBy("anchor").agg(F.min("tk").alias("a"), F.max("tk").alias("b")).where("a <> b").select("anchor")
    lists = held.join(shared, "anchor").groupBy("doc_id", "tk").agg(F.collect_set("anchor").alias("anchors"))
    ids = base.where("doc_id IS NOT NULL").select("doc_id", "tk", F.xxhash64("text", F.lit(7)).alias("tk2"))
    firsts = ids.groupBy("tk", "tk2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("tk", "tk2", "low")
    copies = ids.join(firsts, ["tk", "tk2"]).where("doc_id > low").groupBy("doc_id", "tk").agg(F.min("low").alias("copy_of"))
    notes = lists.join(copies, ["doc_id", "tk"], "full").select(F.col("doc_id").alias("_d"), F.col("tk").alias("_t"), "anchors", "copy_of")
    noted = base.join(notes, (F.col("doc_id") == F.col("_d")) & (F.col("tk") == F.col("_t")), "left").select("doc_id", "tk", "text", "anchors", "copy_of")
    schema = _DIGEST if digest else _RESULT
    names = ["doc_id", "n_words", "n_removed", *(["kept_sha256"] if digest else ["kept", "factors"])]
    extra = [] if digest else [pa.list_(_FACTOR)]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that are settled, and the texts that have factors, with the first and last windows of these."""
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            ids_, tks, copied = b.column("doc_id").to_pylist(), b.column("tk").to_pylist(), b.column("copy_of").to_pylist()
            known = b.column("anchors")
            for i, j in slices(offs):
                part = data[offs[i] : offs[j]]
                w = Words(part, offs[i : j + 1] - offs[i], "space")
                low, ok = _window_anchors(w, window)
                done, late = [], []
                for r in range(j - i):
                    lo, hi = int(w.doc[r]), int(w.doc[r + 1])
                    if copied[i + r] is not None and hi - lo >= window:
                        done.append((ids_[i + r], hi - lo, hi - lo, _final(b"", digest), [(0, hi - lo, copied[i + r], 0)]))
                        continue
                    first = last = ()
                    if known[i + r].is_valid and ok[lo:hi].any():
                        have = known[i + r].values.to_numpy().view(np.uint64)
                        first, last = _runs(ok[lo:hi] & np.isin(low[lo:hi], have))
                    if len(first):
                        late.append((ids_[i + r], tks[i + r], b.column("text")[i + r].as_py(), first.tolist(), last.tolist()))
                    else:
                        raw = part[offs[i + r] - offs[i] : offs[i + r + 1] - offs[i]]
                        kept = b" ".join(raw.tobytes().split())
                        done.append((ids_[i + r], hi - lo, 0, _final(kept, digest), []))
                for rows, is_late in ((done, False), (late, True)):
                    if rows:
                        c = list(zip(*rows, strict=True))
                        no = lambda t, n=len(rows): pa.nulls(n, t)
                        a, i64 = pa.array, pa.int64()
                        runs = pa.list_(pa.int32())
                        if is_late:
                            cols = [a(c[0], i64), no(i64), no(i64), no(pa.string()), *map(no, extra), a(c[1], i64), a(c[2], pa.string()), a(c[3], runs), a(c[4], runs)]
                        else:
                            cols = [a(c[0], i64), a(c[1], i64), a(c[2], i64), a(c[3], pa.string()), *(a(c[4], t) for t in extra), no(i64), no(pa.string()), no(runs), no(runs)]
                        yield pa.RecordBatch.from_arrays(cols, [*names, "tk", "text", "first", "last"])

    mixed = stored(noted.mapInArrow(parse, f"{schema}, tk long, text string, first array<int>, last array<int>"))
    done = mixed.where("text IS NULL").select(*names)
    open_ = mixed.where("text IS NOT NULL").select("doc_id", "tk", "text", "first", "last")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            firsts_, lasts = b.column("first"), b.column("last")
            for i, j in slices(offs):
                w = Words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], "space", two=True)
                at, h1, h2 = w.windows(window)
                on, row = [], []
                for r in range(j - i):
                    for s, e in zip(firsts_[i + r].as_py(), lasts[i + r].as_py(), strict=True):
                        on.append(np.arange(s, e))
                        row.append(np.full(e - s, r))
                pos, row = np.concatenate(on), np.concatenate(row)
                k = np.searchsorted(at, w.doc[row] + pos)
                take = lambda n: b.column(n).slice(i, j - i).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(h1[k].view(np.int64)), pa.array(h2[k].view(np.int64)), take("doc_id"), take("tk"), pa.array(pos.astype(np.int32))], ["w1", "w2", "doc_id", "tk", "pos"])

    all_ = open_.mapInArrow(windows, "w1 long, w2 long, doc_id long, tk long, pos int")
    early = all_.groupBy("w1", "w2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min_by("pos", "doc_id").alias("at")).where("low < high").select("w1", "w2", "low", "at")
    hits = all_.join(early, ["w1", "w2"]).where("doc_id > low").groupBy(F.col("doc_id").alias("_d"), F.col("tk").alias("_t")).agg(F.collect_set(F.struct("pos", "low", "at")).alias("hits"))
    last_ = open_.join(hits, (F.col("doc_id") == F.col("_d")) & (F.col("tk") == F.col("_t")), "left").select("doc_id", "text", "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            rows = []
            for r in range(len(b)):
                part = data[offs[r] : offs[r + 1]]
                w = Words(part, np.array([0, len(part)]), "space")
                hits_ = b.column("hits")[r]
                found = [hits_.values.field(k).to_numpy().astype(np.int64) if hits_.is_valid else np.zeros(0, np.int64) for k in range(3)]
                parsed = factors(*found, window)
                gone = covered(len(w), parsed[0], parsed[0] + parsed[1])
                rows.append((b.column("doc_id")[r].as_py(), len(w), int(gone.sum()), _final(_kept(part, w, gone), digest), list(zip(*(x.tolist() for x in parsed), strict=True))))
            c = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.string()), *(pa.array(c[4], t) for t in extra)], names)

    return done.unionAll(last_.mapInArrow(cut, schema))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every document that an earlier one also has, 50 in a row."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
