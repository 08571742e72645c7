"""N-gram Jaccard self-join by MinHash banding, with every candidate group verified on whole n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, Words, slices, small_batches, span_keys, stored, text_buffer
from .components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.99
MOST_HASHES = 128
#: Members of one side of a block of a candidate group.
BLOCK = 192
#: Values of an indicator matrix at once.
_DENSE = 16_000_000


def band_shape(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most selective shape of at most ``most`` hashes that finds a pair of just the threshold's
    similarity with the target probability."""
    best = (most, 1)
    for rows in range(1, most + 1):
        hit = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if bands * rows <= most:
            best = (bands, rows)
    return best


def _shingles(w: Words, n_docs: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of every text and where each text's begin; a shorter text with words is one n-gram."""
    first, h, _ = w.windows(n)
    size = np.diff(w.doc)
    short = np.flatnonzero((size > 0) & (size < n))
    row = np.concatenate([np.searchsorted(w.doc, first, side="right") - 1, short])
    h = np.concatenate([h, Rolling(w.hash).windows(w.doc[short], w.doc[short + 1])])
    order = np.argsort(row, kind="stable")
    return h[order], np.searchsorted(row[order], np.arange(n_docs + 1))


def _lowered(docs: DataFrame) -> DataFrame:
    """doc_id, text in lower case, and tk, a hash of the text as it stands."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tk"), F.lower(text).alias("text"))


def _word_keys(data: np.ndarray, w: Words) -> np.ndarray:
    """128-bit hashes of the word sequence of every text."""
    size = w.end - w.start + 1  # each word and a blank
    at = np.concatenate([[0], np.cumsum(size)])
    flat = np.repeat(w.start - at[:-1], size) + np.arange(at[-1])
    plain = np.append(data, np.uint8(32))[np.minimum(flat, len(data))]
    plain[at[1:] - 1] = 32
    return span_keys(plain, at[w.doc[:-1]], at[w.doc[1:]])


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, tk, k1, k2 (hash of the word sequence), n_shingles and, where there are any, one hash for each band."""
    small_batches(docs.sparkSession)
    rng = np.random.default_rng(5)
    mul = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    add = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            for i, j in slices(offs):
                part = data[offs[i] : offs[j]]
                w = Words(part, offs[i : j + 1] - offs[i], "alnum")
                words = _word_keys(part, w).view(np.int64)
                h, at = _shingles(w, j - i, n)
                full = np.flatnonzero(np.diff(at))
                x = (h >> np.uint64(32)).astype(np.uint32)
                keys = np.zeros((len(full), bands), np.int64)
                if len(full):
                    low = np.stack([np.minimum.reduceat(x * a + c, at[full]) for a, c in zip(mul, add, strict=True)], axis=1).astype(np.uint64)
                    for k in range(bands):
                        keys[:, k] = Rolling(np.concatenate([low[:, k * rows : (k + 1) * rows], np.full((len(full), 1), k + 1, np.uint64)], axis=1).ravel()).windows(np.arange(len(full)) * (rows + 1), (np.arange(len(full)) + 1) * (rows + 1)).view(np.int64)
                size = np.zeros(j - i + 1, np.int32)
                size[full + 1] = bands
                listed = pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("doc_id", "tk")), pa.array(words[:, 0].copy()), pa.array(words[:, 1].copy()), pa.array(np.diff(at).astype(np.int32)), listed], ["doc_id", "tk", "k1", "k2", "n_shingles", "bands"])

    return _lowered(docs).mapInArrow(run, "doc_id long, tk long, k1 long, k2 long, n_shingles int, bands array<long>")


def _links(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each member of a block, and the first member of its linked part. ``side``: 0 and 1 for members of two
    blocks, of which only pairs across count; else all 0."""
    m = len(sets)
    which = np.repeat(np.arange(m), [len(s) for s in sets])
    _, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = seen[col] > 1
    cols = (np.cumsum(seen > 1) - 1)[col[common]]
    which, total = which[common], int((seen > 1).sum())
    both = np.zeros((m, m), np.float32)
    step = max(1, _DENSE // max(1, m))
    order = np.argsort(cols, kind="stable")
    cols, which = cols[order], which[order]
    for c in range(0, total, step):
        lo, hi = np.searchsorted(cols, [c, c + step])
        part = np.zeros((m, min(step, total - c)), np.float32)
        part[which[lo:hi], cols[lo:hi] - c] = 1
        both += part @ part.T
    size = np.array([len(s) for s in sets], np.float64)
    near = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(near, False)
    if side.any():
        near &= side[:, None] != side[None, :]
    root = np.arange(m)
    while True:
        low = np.minimum(root, np.where(near, root[None, :], m).min(axis=1))
        low = np.minimum(low, low[low])
        if (low == root).all():
            return near.sum(axis=1), root
        root = low


def _blocks(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (root, a, b): one block of a candidate group after another."""
    key, ids, sets, side = None, [], [], []
    out: list[tuple[int, int, int]] = []

    def close() -> None:
        if len(ids) > 1:
            n, root = _links(sets, np.array(side), threshold)
            out.extend((ids[i], ids[root[i]], int(n[i])) for i in np.flatnonzero(n))

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "n"])
        out.clear()
        return batch

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("root", "a", "b", "id", "side", "shingles")]
        for r, a, b, i, s, x in zip(*cols, strict=True):
            if (r, a, b) != key:
                close()
                key, ids, sets, side = (r, a, b), [], [], []
            ids.append(i)
            sets.append(np.frombuffer(x, np.uint64))
            side.append(s)
        if len(out) > 10_000:
            yield flush()
    close()
    yield flush()


def _judged(docs: DataFrame, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and of every different text (k1, k2) its class (``root``, the class's smallest doc_id ``class_id``, and the class's
    first row ``speaker``: by doc_id, nulls last, then hash of the text), its links and its copies. A text is known by its own key
    all the way, never by an id."""
    bands, rows = band_shape(threshold, recall)
    sig = stored(signatures(docs, n, bands, rows))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk")
    texts = stored(sig.groupBy("k1", "k2").agg(F.col("k1").alias("node"), F.min(row).alias("row"), F.count("*").alias("n_copies"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")))
    members = texts.where("n_shingles > 0").select("node", F.posexplode("bands").alias("band", "hash"))
    roots = members.groupBy("band", "hash").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    stars = members.join(roots, ["band", "hash"]).where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    groups = components(stars)
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    placed = groups.join(sizes, "root").select("id", "root", F.ceil(F.col("size") / BLOCK).alias("of")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            for i, j in slices(offs):
                w = Words(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], "alnum")
                h, at = _shingles(w, j - i, n)
                got = [np.unique(h[at[k] : at[k + 1]]).tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("id", "root", "of", "block")), pa.array(got, pa.binary())], ["id", "root", "of", "block", "shingles"])

    # one row of each text that stands in a candidate group
    placed = placed.join(texts.select("node", "row"), placed["id"] == texts["node"]).select("id", "root", "of", "block", F.col("row.doc_id").alias("_d"), F.col("row.tk").alias("_t"))
    low = _lowered(docs)
    found = low.join(placed, low["doc_id"].eqNullSafe(placed["_d"]) & (low["tk"] == placed["_t"])).select("id", "root", "of", "block", "text").dropDuplicates(["id"])
    sided = found.mapInArrow(sets, "id long, root long, of long, block int, shingles binary").select(
        "id", "root", "shingles", "block", F.explode(F.sequence(F.lit(0), F.col("of").cast("int") - 1)).alias("other")
    )
    spread = sided.select("root", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "id", (F.col("block") > F.col("other")).cast("int").alias("side"), "shingles")
    links = stored(spread.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b").mapInArrow(lambda x: _blocks(x, threshold), "a long, b long, n long"))
    counts = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links"))
    classes = components(links.select("a", "b"))
    judged = texts.join(counts, F.col("node") == counts["id"], "left").join(classes.select(F.col("id").alias("cid"), "root"), F.col("node") == F.col("cid"), "left")
    judged = stored(judged.select("k1", "k2", F.coalesce("root", "node").alias("root"), "row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies"))
    speakers = judged.groupBy("root").agg(F.min("row").alias("speaker"))
    return sig, judged.join(speakers, "root").withColumn("class_id", F.coalesce("speaker.doc_id", "root"))


def near_duplicates(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each row of ``docs``: doc_id, class_id, n_links, n_copies.

    Words are runs of letters and digits, case folded. Texts of the same words are copies; they have one class and their
    links are counted once. ``n_links`` is the number of other texts whose sets of n-word shingles have a Jaccard similarity of the
    threshold or more; linked texts share a class, named after its smallest doc_id (one of null ids only after a hash). A text of fewer than n words is one
    shingle; texts without words, null or empty, are copies of each other and link to nothing. Rows that share an id are judged
    each by its text. Candidates come from MinHash bands (``recall`` is reached at the threshold); every candidate
    group is verified in blocks of bounded size, pairs are not written out, and no group is cut.
    """
    sig, judged = _judged(docs, n, threshold, recall)
    judged = judged.select(F.col("k1").alias("_1"), F.col("k2").alias("_2"), "class_id", "n_links", "n_copies")
    return sig.select("doc_id", "k1", "k2").join(judged, (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2"))).select("doc_id", "class_id", "n_links", "n_copies")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest doc_id (null ids last), and of the smallest
    hash of the text among rows that share it. Rows are judged by their texts, whatever their ids."""
    _, judged = _judged(docs, WORDS, THRESHOLD, RECALL)
    kept = judged.select(F.col("speaker.doc_id").alias("__am_doc"), F.col("speaker.tk").alias("__am_tk")).distinct()
    named = docs.withColumn("__am_id", F.col("doc_id").cast("long")).withColumn("__am_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    out = named.join(kept, named["__am_id"].eqNullSafe(kept["__am_doc"]) & (named["__am_key"] == kept["__am_tk"]), "left_semi")
    return out.dropDuplicates(["__am_id", "__am_key"]).drop("__am_id", "__am_key")


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Class and links of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
