"""Benchmark decontamination with spaced seeds and substitution-tolerant checks around the hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, slices, small_batches, text_buffer

#: Fixed masks over consecutive words; words under a 0 are ignored. With any 2 of 13 words replaced, one of them still fits
#: (tests/llm/test_short_items.py tries every case).
MASKS = ("1101010011", "11001111")
#: An overlap is a run of WINDOW words (all of a shorter item), of which SHARE at least agree in place.
WINDOW, SHARE = 13, 0.8
#: Items with fewer words are left out; by default none is.
LEAST = 1
#: The benchmark goes to the tasks in blocks of about so many bytes, one pass over the documents for each.
BLOCK_BYTES = 16_000_000
_FILTER_BITS = 24
_CHUNK = 20_000


def _seeds(h: np.ndarray, left: np.ndarray, span: int, places: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions with ``span`` words left in their text, and the hash of the words at ``places``."""
    at = np.flatnonzero(left >= span)
    x = np.zeros(len(at), np.uint64)
    for n, p in enumerate(places):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[at + p] * np.uint64(2 * n + 3)
    return at, mix(x)


def split_masks(n: int) -> list[list[int]]:
    """Places of the seeds for items of ``n`` words, fewer than WINDOW: one more disjoint part than words may differ, so that one part fits."""
    bear = max(k for k in range(n) if n - k >= SHARE * n)
    return [list(range(k, n, bear + 1)) for k in range(bear + 1)]


class _Index:
    """One block of the benchmark: its words, and the sorted seed hashes of each mask."""

    def __init__(self, rows: list, least: int = LEAST):
        self.ids = np.array([r.item_id for r in rows], np.int64)
        data, offs = text_buffer(pa.array([r.text for r in rows], pa.string()))
        w = Words(data, offs, "alnum")
        self.hash, self.left, self.doc = w.hash, w.left(), w.doc
        self.item = np.repeat(np.arange(len(rows)), np.diff(w.doc))
        size = np.diff(w.doc)[self.item] if len(w) else np.zeros(0, np.int64)
        self.seeds = []
        for mask in MASKS:
            places = [i for i, c in enumerate(mask) if c == "1"]
            at, x = _seeds(self.hash, self.left, len(mask), places)
            long = size[at] >= WINDOW
            self._add(len(mask), places, at[long], x[long])
        for n in range(max(1, least), WINDOW):
            for places in split_masks(n) if (size == n).any() else ():
                at, x = _seeds(self.hash, self.left, n, places)
                whole = size[at] == n
                self._add(n, places, at[whole], x[whole])

    def _add(self, span: int, places: list[int], at: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(x, kind="stable")
        hint = np.zeros(1 << _FILTER_BITS, bool)
        hint[(x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.seeds.append((span, places, x[order], at[order], np.packbits(hint)))


def _overlaps(w: Words, left: np.ndarray, index: _Index) -> tuple[np.ndarray, ...]:
    """Verified overlaps: text, item, first and last word in the text, words that agree."""
    n_docs = len(w.doc) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(w.doc))
    at_doc, at_item = [], []
    for span, places, x, at, hint in index.seeds:
        here, y = _seeds(w.hash, left, span, places)
        bit = (y >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
        maybe = np.flatnonzero(hint[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
        lo, hi = np.searchsorted(x, y[maybe], "left"), np.searchsorted(x, y[maybe], "right")
        n = hi - lo
        start = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else n
        at_doc.append(np.repeat(here[maybe], n))
        at_item.append(at[start + np.arange(n.sum())])
    i, j = np.concatenate(at_doc), np.concatenate(at_item)
    # one check for each diagonal and stretch of WINDOW words
    key = np.unique(np.stack([doc[i], index.item[j], i - j, i // WINDOW]), axis=1, return_index=True)[1] if len(i) else i
    out = []
    reach = np.arange(-2 * WINDOW, 3 * WINDOW)
    for c in range(0, len(key), _CHUNK):
        p, q = i[key[c : c + _CHUNK]], j[key[c : c + _CHUNK]]
        a, b = p[:, None] + reach, q[:, None] + reach
        d, t = doc[p], index.item[q]
        inside = (a >= w.doc[d][:, None]) & (a < w.doc[d + 1][:, None]) & (b >= index.doc[t][:, None]) & (b < index.doc[t + 1][:, None])
        agree = inside & (w.hash[np.where(inside, a, 0)] == index.hash[np.where(inside, b, 0)])
        size = np.minimum(WINDOW, index.doc[t + 1] - index.doc[t])
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            run = lambda m: np.cumsum(np.pad(m[rows], ((0, 0), (1, 0))), axis=1)
            good, full = (z[:, length:] - z[:, :-length] for z in (run(agree), run(inside)))
            r, k = np.nonzero((full == length) & (good >= SHARE * length))
            if len(r):
                first = a[rows[r], k]
                out.append(np.stack([d[rows[r]], t[rows[r]], first, first + length - 1, good[r, k]]))
    return tuple(np.concatenate(out, axis=1)) if out else tuple(np.zeros((5, 0), np.int64))


def _indexes(benchmark: DataFrame, least: int) -> Iterator:
    """The benchmark's index, broadcast in blocks of about BLOCK_BYTES, one made when it is asked for."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    for k in range(blocks):
        yield spark.sparkContext.broadcast(_Index(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect(), least))


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """One row for each document and benchmark item that overlap: doc_id, item_id, first_word, last_word (numbers of
    words in the document, from 0), agreeing (most words that agree within one window).

    Words are runs of letters and digits, case folded. Null texts, and items of fewer than ``least`` words, overlap nothing;
    repeated rows, documents or items, give equal rows once for each item. The benchmark is sent in blocks of about BLOCK_BYTES, so it may be of
    any size; documents are never shuffled by seed, so a passage that a third of them holds costs its checks only.
    """
    small_batches(docs.sparkSession)
    src = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    schema = "doc_id long, item_id long, first_word long, last_word long, agreeing int"
    found = docs.sparkSession.createDataFrame([], schema)
    for shared in _indexes(benchmark, least):

        def check(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column("doc_id")
                data, offs = text_buffer(batch.column("text"))
                for i, j in slices(offs):
                    w = Words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], "alnum")
                    d, t, first, last, n = _overlaps(w, w.left(), index)
                    if not len(d):
                        continue
                    order = np.lexsort((t, d))
                    cut = np.flatnonzero(np.diff(d[order], prepend=-1) | np.diff(t[order], prepend=-1))
                    dd, at = d[order][cut], w.doc[d[order][cut]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.slice(i, j - i).take(pa.array(dd)), pa.array(index.ids[t[order][cut]]),
                            pa.array(np.minimum.reduceat(first[order], cut) - at), pa.array(np.maximum.reduceat(last[order], cut) - at),
                            pa.array(np.maximum.reduceat(n[order], cut).astype(np.int32)),
                        ],
                        ["doc_id", "item_id", "first_word", "last_word", "agreeing"],
                    )

        one = src.mapInArrow(check, schema)
        found = found.unionAll(one)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns. A row is judged by its own text, whatever its id; rows
    with a null text stay. Nothing is shuffled."""
    small_batches(docs.sparkSession)
    out = docs.withColumn("__am_low", F.lower(F.coalesce("text", F.lit(""))))
    for shared in _indexes(benchmark, least):

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                data, offs = text_buffer(batch.column("__am_low"))
                clean = np.ones(len(batch), bool)
                for i, j in slices(offs):
                    w = Words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], "alnum")
                    clean[i + _overlaps(w, w.left(), index)[0]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(keep, out.schema)
    return out.drop("__am_low")


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of the benchmark, with the item and the place."""
    return overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=1)
