"""Exact top-k inner-product search by distributed histogram selection."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Queries are taken in blocks of this many rows; a block and its thresholds are what goes to every task.
QUERY_BLOCK = 1024
BINS = 256
TILE = 2048
_EXACT, _LONG = 2**53, 2**63


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of every component, x as double. Rows whose id or vector is null, or
    whose vector is empty or holds a null, a NaN or an infinity, are left out."""
    x = F.transform("embedding", lambda e: F.floor(e.cast("double") * scale))
    bad = F.exists("embedding", lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True))).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def _matrix(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: (row numbers, matrix)."""
    sizes = col.value_lengths().to_numpy(zero_copy_only=False)
    flat, at = col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, flat[at[rows][:, None] + np.arange(d)] if d else np.zeros((len(rows), 0), np.int64)))
    return out


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer products; in doubles or longs where those are exact, else in Python's integers."""
    most = max(-int(q.min(initial=0)), int(q.max(initial=0))) * max(-int(c.min(initial=0)), int(c.max(initial=0))) * q.shape[1]
    if most < _LONG:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if most < _EXACT else q @ c.T
    s = q.astype(object) @ c.T.astype(object)
    if s.size and max(-int(s.min()) - 1, int(s.max())) >= _LONG:
        raise OverflowError("a score has no room in a long")
    return s.astype(np.int64)


def _tiles(batches: Iterator[pa.RecordBatch], queries: dict):
    """Scores of each tile of candidates: places of the queries in the block, candidate ids, scores, and which are not a
    row's score with itself. Vectors of different lengths have no score."""
    for b in batches:
        ids, own = b.column("vec_id").to_numpy(), b.column("row").to_numpy()
        for rows, m in _matrix(b.column("v")):
            if m.shape[1] not in queries:
                continue
            at, row, q = queries[m.shape[1]]
            for i in range(0, len(rows), TILE):
                part = rows[i : i + TILE]
                yield at, ids[part], _scores(q, m[i : i + TILE]), row[:, None] != own[part][None, :]


def _block(rows: list) -> dict:
    out = {}
    sizes = np.array([len(r.v) for r in rows])
    ids = np.array([r.row for r in rows], np.int64)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        out[int(d)] = (at, ids[at], np.array([rows[i].v for i in at], np.int64).reshape(len(at), d))
    return out


def _select(cand: DataFrame, rows: list, k: int) -> DataFrame:
    """The k best for one block of queries.

    Each round counts, for every query, the scores that fall in each of BINS equal parts of the range that holds its
    k-th value; the counts of all tasks are added up in Spark and the range narrows to one part. When the range
    is one value, all better scores are in, and of the ties the smallest ids are taken.
    """
    spark = cand.sparkSession
    queries = _block(rows)
    shared = spark.sparkContext.broadcast(queries)
    n = len(rows)
    least, most = cand.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    biggest = max(0, -(least or 0), most or 0)
    bound = np.zeros(n, object)
    for at, _, q in queries.values():
        bound[at] = [sum(abs(x) for x in row) * biggest for row in q.tolist()]
    low = np.array([max(-_LONG, -int(b)) for b in bound], object)
    high = np.array([min(_LONG - 1, int(b)) for b in bound], object)
    above = np.zeros(n, np.int64)
    while True:
        width = np.array([max(1, -(-(int(h) - int(lo) + 1) // BINS)) for lo, h in zip(low, high, strict=True)], np.int64)
        open_ = np.array([lo < h for lo, h in zip(low, high, strict=True)])
        if not open_.any():
            break
        now = spark.sparkContext.broadcast((low.astype(np.int64), high.astype(np.int64), width, open_))

        def count(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            lo, hi, w, going = now.value
            hist = np.zeros((n, BINS), np.int64)
            for at, _, s, other in _tiles(batches, shared.value):
                ok = other & (s >= lo[at][:, None]) & (s <= hi[at][:, None]) & going[at][:, None]
                part = ((s.view(np.uint64) - lo[at].view(np.uint64)[:, None]) // w[at].view(np.uint64)[:, None]).astype(np.int64)  # as differences may pass 63 bits
                hist += np.bincount((at[:, None] * BINS + part)[ok], minlength=n * BINS).reshape(n, BINS)
            q, part = np.nonzero(hist)
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(hist[q, part])], ["q", "part", "n"])

        total = cand.mapInArrow(count, "q int, part int, n long").groupBy("q", "part").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("q").orderBy(F.desc("part"))
        need = spark.createDataFrame([(i, int(k - above[i])) for i in range(n)], "q int, need long")
        seen = total.withColumn("upto", F.sum("n").over(down)).join(F.broadcast(need), "q")
        found = seen.where(F.col("upto") >= F.col("need")).groupBy("q").agg(F.max(F.struct("part", "upto", "n")).alias("s")).select("q", "s.*").collect()
        hit = {r.q: r for r in found}
        for i in np.flatnonzero(open_):
            if i in hit:
                r = hit[i]
                above[i] += r.upto - r.n
                lo = int(low[i]) + int(r.part) * int(width[i])
                low[i], high[i] = lo, min(int(high[i]), lo + int(width[i]) - 1)
            else:  # fewer than k candidates: all take part
                high[i] = low[i]
    final = spark.sparkContext.broadcast(low.astype(np.int64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kth = final.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at, cid, s, other in _tiles(batches, shared.value):
            for n in np.flatnonzero((ok := other & (s >= kth[at][:, None])).any(axis=1)):
                q, sc, c = int(at[n]), s[n][ok[n]], cid[ok[n]]
                if q in best:
                    sc, c = np.concatenate([best[q][0], sc]), np.concatenate([best[q][1], c])
                keep = np.lexsort((c, ~sc))[:k]  # ~ turns the order round, of the least long too
                best[q] = (sc[keep], c[keep])
        for q, (sc, c) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), rows[q].row)), pa.array(np.full(len(c), rows[q].vec_id)), pa.array(c), pa.array(sc)], ["row", "query_id", "vec_id", "score"])

    return cand.mapInArrow(pick, "row long, query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = 10) -> DataFrame:
    """The k highest integer inner products of each query row over all other rows: query_id, rank, vec_id, score.

    Ties go to the smaller id. A task passes on at most k rows a query, so a vector that a third of the table repeats
    costs no more than any other. Queries run in blocks of QUERY_BLOCK; only a block, its histogram of
    BINS parts and its thresholds reach the driver. Rows that share an id are each a candidate and each a query, with ranks of its own; a
    query meets all rows but itself. Scores of any size that a long holds are exact; a greater one is an error (OverflowError). A
    component past a long counts as the largest one. Empty tables give no rows.
    """
    cand = stored(quantised(vectors).withColumn("row", F.monotonically_increasing_id()))
    queries = cand.where(is_query)
    total = queries.count()
    blocks = max(1, -(-total // QUERY_BLOCK))
    parts = []
    for b in range(blocks if total else 0):
        rows = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).collect()
        if rows:
            parts.append(_select(cand, sorted(rows, key=lambda r: r.row), k))
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    w = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return functools.reduce(DataFrame.unionAll, parts).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_k_search(spark, sf_dir: str) -> DataFrame:
    """Ten best of every hundredth vector over all others."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, 10)
