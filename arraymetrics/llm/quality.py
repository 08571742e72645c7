"""A quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, Words, held_out, in_fold, mix, slices, text_buffer

#: Weights of the model; features are hashed into so many.
SIZE = 1 << 18
#: The classifier is fitted on at most so many labelled rows, those with the smallest hash of their id.
SAMPLE = 8_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1e-3
#: Features of a text are scaled to this sum.
GAIN = 24.0


def _features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of the words and word pairs of each text, the text of each, and features per text. Words are
    runs of letters and digits or runs of punctuation. Pairs of equal words, next to each other or one apart, also
    count under one number each, whatever the word."""
    w = Words(data, offs, "runs")
    n = len(offs) - 1
    pairs, h, _ = w.windows(2)
    doc = np.repeat(np.arange(n), np.diff(w.doc))
    same = [np.flatnonzero((w.hash[k:] == w.hash[:-k]) & (doc[k:] == doc[:-k])) for k in (1, 2)]
    row = np.concatenate([doc, doc[pairs], *(doc[i] for i in same)])
    hashed = (np.concatenate([w.hash, mix(h)]) % np.uint64(SIZE)).astype(np.int64)
    feature = np.concatenate([hashed, *(np.full(len(i), k) for k, i in enumerate(same))])
    return feature, row, np.bincount(row, minlength=n)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offs = text_buffer(b.column("text"))
        for i, j in slices(offs):
            f, row, _ = _features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            out_i, out_v = [], []
            key, n = np.unique(row * SIZE + f, return_counts=True)
            cut = np.searchsorted(key, np.arange(j - i + 1) * SIZE)
            for r in range(j - i):
                part = slice(cut[r], cut[r + 1])
                out_i.append((key[part] % SIZE).astype(np.int32))
                out_v.append((n[part] * (GAIN / max(1, n[part].sum()))).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, j - i), b.column("label").slice(i, j - i), pa.array([x.tobytes() for x in out_i], pa.binary()), pa.array([x.tobytes() for x in out_v], pa.binary())],
                ["doc_id", "label", "ids", "values"],
            )


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights, the last of them the bias, from texts and ``labels`` (doc_id, quality).

    The sample is bounded by SAMPLE ids, each with one text (the smallest, where rows repeat an id) and at most SIZE different features, so what reaches
    the driver doesn't grow with the input. Null labels and ids teach nothing; an id with several labels takes the highest. Without any label the weights are 0.
    """
    want = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("label"))
    sample = want.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = rows.mapInArrow(_rows, "doc_id long, label int, ids binary, values binary").collect()
    found.sort(key=lambda r: (np.int64(r.doc_id) * 2654435761 % 2**32, r.doc_id, r.ids))
    z, g2, w = np.zeros(SIZE + 1), np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    for _ in range(EPOCHS):
        for r in found:
            i = np.append(np.frombuffer(r.ids, np.int32), SIZE)
            x = np.append(np.frombuffer(r["values"], np.float32), np.float32(1)).astype(np.float64)
            zi, gi = z[i], g2[i]
            wi = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(gi)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(wi @ x, -30, 30)))
            g = (p - r.label) * x
            z[i] = zi + g - (np.sqrt(gi + g * g) - np.sqrt(gi)) / ALPHA * wi
            g2[i] = gi + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(g2)) / ALPHA + L2))
    return w


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """doc_id, score (0 to 1), predicted (score >= threshold) for each row's whole text; a null or empty text is
    scored by the bias alone. Repeated rows are scored alike."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            for i, j in slices(offs):
                f, row, n = _features(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                s = np.bincount(row, w[f], minlength=j - i) * GAIN / np.maximum(n, 1) + w[SIZE]
                p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, mod: int = 4, rest: int = 2, threshold: float = 0.7) -> DataFrame:
    """Fit outside the held-out fold, then score every row: doc_id, held_out, score, predicted."""
    weights = fit(docs.where(in_fold(F.col("doc_id"), mod, rest)), labels.where(in_fold(F.col("doc_id"), mod, rest)))
    return score(docs, weights, threshold).select("doc_id", held_out(F.col("doc_id"), mod, rest).alias("held_out"), "score", "predicted")


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
