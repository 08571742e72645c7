"""Ranked lexical search, reversed: the items' terms form the index, and the documents stream through it.

The index of a block of items (terms, and for each the items that hold it) goes to every task. A first pass counts the documents, their terms and
the documents with each term of the index; a second one scores each document for all items at once and keeps a heap of the best for each item.
The heaps of all tasks are merged in two steps.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, dropped, slices, small_batches, stored, text_buffer

#: Bytes of text of a block of items; a block holds one item at least.
BLOCK_BYTES = 8 << 20
#: Scores that are held at once: documents times items.
CELLS = 1 << 21
#: Terms that stand in more than one in WIDE items of a block are multiplied out; for the others their items are looked up.
WIDE = 16
#: Groups of tasks whose heaps are merged first.
LANES = 64
#: Whole numbers below this are exact as doubles.
_EXACT = 1 << 53
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """For slices of texts: first and last row, and the terms, which are runs of ASCII letters, digits and other characters than ASCII, with A-Z lower-cased."""
    data, offs = text_buffer(texts)
    for i, j in slices(offs):
        yield i, j, Words(_LOWER[data[offs[i] : offs[j]]], offs[i : j + 1] - offs[i], "alnum")


class Index:
    """The terms of a block of items: sorted hashes, and each one's items."""

    def __init__(self, rows: list):
        self.items = np.array(sorted({r.item_id for r in rows}), np.int64)
        place = {x: n for n, x in enumerate(self.items.tolist())}
        own = np.array([place[r.item_id] for r in rows], np.int64)
        found = [(own[i:j].repeat(np.diff(w.doc)), w.hash) for i, j, w in term_hashes(pa.array([r.text for r in rows], pa.large_string()))]
        item = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in found)])
        self.terms, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in found)]), return_inverse=True)
        pair = np.unique(number.astype(np.int64) * len(self.items) + item)
        self.posting = pair % max(1, len(self.items))
        self.first = np.searchsorted(pair // max(1, len(self.items)), np.arange(len(self.terms) + 1))

    def counts(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, term and occurrences of the index's terms in a slice."""
        if not len(self.terms) or not len(w):
            return (np.zeros(0, np.int64),) * 3
        at = np.minimum(np.searchsorted(self.terms, w.hash), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == w.hash)
        doc = np.repeat(np.arange(len(w.doc) - 1), np.diff(w.doc))[hit]
        pair, tf = np.unique(doc * len(self.terms) + at[hit], return_counts=True)
        return pair // len(self.terms), pair % len(self.terms), tf


class Weights:
    """What scores need beside the index: the weight of each term, and how terms are met with items."""

    def __init__(self, index: Index, n_docs: int, n_terms: int, df: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        held = np.diff(index.first)
        total = np.zeros(len(index.items), np.int64)
        np.add.at(total, index.posting, np.repeat(self.w, held))
        wide = np.flatnonzero((held * WIDE > len(index.items)) & (int(total.max(initial=0)) * 1_000_000 < _EXACT))
        self.column = np.full(len(held), -1)
        self.column[wide] = np.arange(len(wide))
        self.matrix = np.zeros((len(wide), len(index.items)))
        for n, t in enumerate(wide.tolist()):
            self.matrix[n, index.posting[index.first[t] : index.first[t + 1]]] = 1

    def scores(self, index: Index, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores of the documents of a slice (rows) for all items (columns)."""
        m = 10 + 90 * sizes * self.n_docs // self.n_terms
        value = self.w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        column = self.column[term]
        wide, rest = np.flatnonzero(column >= 0), np.flatnonzero(column < 0)
        dense = np.zeros((len(sizes), len(self.matrix)))
        dense[doc[wide], column[wide]] = value[wide]
        out = (dense @ self.matrix).astype(np.int64)
        held = np.diff(index.first)[term[rest]]
        at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(index.first[term[rest]], held)
        np.add.at(out, (np.repeat(doc[rest], held), index.posting[at]), np.repeat(value[rest], held))
        return out


class Heaps:
    """The best k of each item so far: score and document, best first, equal scores by the smaller id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score, self.doc = np.zeros((items, k), np.int64), np.zeros((items, k), np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        worst, its = self.score[:, -1], self.doc[:, -1]
        row, item = np.nonzero((scores > worst) | ((scores == worst) & (scores > 0) & (ids[:, None] < its)))
        if not len(row):
            return
        old = np.unique(item)
        kept, column = np.nonzero(self.score[old] > 0)
        owner = np.concatenate([item, old[kept]])
        score = np.concatenate([scores[row, item], self.score[old[kept], column]])
        doc = np.concatenate([ids[row], self.doc[old[kept], column]])
        order = np.lexsort((doc, -score, owner))
        owner, score, doc = owner[order], score[order], doc[order]
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        best = rank < self.k
        self.score[old], self.doc[old] = 0, 0
        self.score[owner[best], rank[best]], self.doc[owner[best], rank[best]] = score[best], doc[best]


def _blocks(items: DataFrame) -> DataFrame:
    """Distinct items with the block of each (``part``, ``no``): running sums of bytes within parts of about BLOCK_BYTES."""
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // BLOCK_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    upto = F.sum(F.octet_length("text")).over(Window.partitionBy("part").orderBy("item_id").rangeBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("no", F.floor(upto / BLOCK_BYTES).cast("long"))


def _best(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """The heaps of all tasks for one block of items, written."""
    index = Index(rows)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        df, n_docs, n_terms = np.zeros(len(index.terms), np.int64), 0, 0
        for b in batches:
            for _, _, w in term_hashes(b.column("text")):
                sizes = np.diff(w.doc)
                n_docs, n_terms = n_docs + int((sizes > 0).sum()), n_terms + int(sizes.sum())
                df += np.bincount(index.counts(w)[1], minlength=len(df))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], at]), pa.int64()), pa.array(np.concatenate([[n_docs, n_terms], df[at]]), pa.int64())], ["term", "n"])

    found = {r.term: r.n for r in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(len(index.terms), np.int64)
    for t, n in found.items():
        if t >= 0:
            df[t] = n
    weights = spark.sparkContext.broadcast(Weights(index, found.get(-1, 0), found.get(-2, 0), df))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, own = shared.value, weights.value
        heaps = Heaps(len(index.items), k)
        most = max(1, CELLS // max(1, len(index.items)))
        for b in batches:
            ids = b.column("doc_id")
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for i, j, w in term_hashes(b.column("text")):
                sizes = np.diff(w.doc)
                doc, term, tf = index.counts(w)
                for a in range(0, j - i, most):
                    z = min(a + most, j - i)
                    lo, hi = np.searchsorted(doc, [a, z])
                    if lo < hi:
                        got = own.scores(index, sizes[a:z], doc[lo:hi] - a, term[lo:hi], tf[lo:hi])
                        heaps.add(ids[i + a : i + z][named[i + a : i + z]], got[named[i + a : i + z]])
        item, rank = np.nonzero(heaps.score)
        lane = np.full(len(item), TaskContext.get().partitionId() % LANES, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(index.items[item]), pa.array(lane), pa.array(heaps.doc[item, rank]), pa.array(heaps.score[item, rank])], ["item_id", "lane", "doc_id", "score"])

    out = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "item_id long, lane int, doc_id long, score long"))
    for held in (shared, weights):
        held.destroy()
    return out


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item, by the contract's integer form of BM25.

    Equal scores go by the smaller doc_id; scores of 0 are left out, so an item may have fewer rows, or none. Rows that share an
    item_id are one item with the terms of all; items whose id or text is null have no rows. Documents with null text or no term count
    for nothing. Each row of ``docs`` is a document of its own: rows that repeat one are ranked each. Those with a null doc_id count in all
    statistics but can't be named, so they are not returned. Other columns are ignored. Terms are told apart by 64-bit hashes, which
    differ for certain between terms of one length of up to 8 bytes.

    A block of items takes two passes over the documents. A task holds k rows an item of one block, however many documents score alike.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = stored(_blocks(items))
    lanes = []
    for b in items.select("part", "no").distinct().orderBy("part", "no").toLocalIterator():
        lanes.append(_best(docs, items.where((F.col("part") == b.part) & (F.col("no") == b.no)).select("item_id", "text").collect(), k))
    dropped(items)
    if not lanes:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = functools.reduce(DataFrame.unionAll, lanes)
    for keys in (["item_id", "lane"], ["item_id"]):
        w = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
        best = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    """Ten best documents of every benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
x AS (SELECT r, doc_id, unnest(ts) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM x GROUP BY ALL),
sizes AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM x GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
s AS (SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (r), total GROUP BY item_id, doc_id, r),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0 AND doc_id IS NOT NULL)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""
