"""Language identification with bit-sliced Bloom filters over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_classes, held_out, in_fold, mix, slices, small_batches, text_buffer

GRAM = 4
SLOTS = 1 << 20
HASHES = 3
#: A language keeps the n-grams that make up this share of its own, so at most 1 / MIN_SHARE of them.
MIN_SHARE = 1e-5
FLUSH = 1_000_000
#: Texts with fewer n-grams (about four words) are too short to be rejected by their score.
ENOUGH = 20


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the n-grams with at most one blank, and the row of each. Case is folded for ASCII before this
    (by Spark's ``lower``); digits, punctuation and blanks all read as one blank."""
    c = np.where((byte_classes("alnum")[data] == 1) & ~((data >= 48) & (data <= 57)), data, 32).astype(np.uint8)
    n = len(c) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, blanks = np.zeros(n, np.int64), np.zeros(n, np.int8)
    for k in range(GRAM):
        part = c[k : k + n]
        key = (key << 8) | part
        blanks += part == 32
    row = np.searchsorted(offs, np.arange(n), side="right") - 1
    keep = (blanks <= 1) & (np.arange(n) + GRAM <= offs[row + 1])
    return key[keep], row[keep]


def _slots(key: np.ndarray) -> list[np.ndarray]:
    h = mix(key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(j) * step) % np.uint64(SLOTS)).astype(np.int64) for j in range(HASHES)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (k, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), lang, np.int32)), pa.array(k), pa.array(n)], ["lang_no", "gram", "n"])
        held.clear()

    for b in batches:
        data, offs = text_buffer(b.column("text"))
        langs = b.column("lang_no").to_numpy(zero_copy_only=False)
        for i, j in slices(offs):
            key, row = _grams(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            of = langs[i:j][row]
            for lang in np.unique(langs[i:j]):
                k, n = np.unique(key[of == lang], return_counts=True)
                if lang in held:
                    k0, n0 = held[lang]
                    k, at = np.unique(np.concatenate([k0, k]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([n0, n])).astype(np.int64)
                held[int(lang)] = (k, n.astype(np.int64))
            if sum(len(k) for k, _ in held.values()) > FLUSH:
                yield from out()
    yield from out()


def fit(docs: DataFrame) -> dict:
    """Learn from every row of ``docs`` (text, lang). Counts cover all rows; what comes to the driver is the
    list of languages and one filter of SLOTS words per 64 languages, whatever the size of the input.

    Rows with a null lang or text teach nothing. Without any language the model is empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.lower("text").alias("text"), "lang")
    langs = sorted(r[0] for r in rows.select("lang").distinct().collect())
    planes = max(1, -(-len(langs) // 64))
    filt, fill = np.zeros((planes, SLOTS), np.uint64), np.zeros(max(1, len(langs)))
    if not langs:
        return {"langs": [], "filter": filt, "fpr": fill}
    numbers = F.broadcast(spark.createDataFrame([(x, i) for i, x in enumerate(langs)], "lang string, lang_no int"))
    counts = (
        rows.join(numbers, "lang")
        .select("lang_no", "text")
        .mapInArrow(_count, "lang_no int, gram long, n long")
        .groupBy("lang_no", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = counts.groupBy("lang_no").agg(F.sum("n").alias("total"))
    kept = counts.join(F.broadcast(totals), "lang_no").where(F.col("n") >= F.col("total") * MIN_SHARE)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = b.column("lang_no").to_numpy()
            bit = np.left_shift(np.uint64(1), (lang % 64).astype(np.uint64)).view(np.int64)
            slots = np.concatenate(_slots(b.column("gram").to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(lang // 64, HASHES).astype(np.int32)), pa.array(slots), pa.array(np.tile(bit, HASHES))], ["plane", "slot", "bits"])

    for r in kept.select("lang_no", "gram").mapInArrow(place, "plane int, slot long, bits long").groupBy("plane", "slot").agg(F.bit_or("bits").alias("bits")).collect():
        filt[r.plane, r.slot] = np.uint64(r.bits & ((1 << 64) - 1))
    for i in range(len(langs)):
        fill[i] = np.mean((filt[i // 64] >> np.uint64(i % 64)) & np.uint64(1)) ** HASHES
    return {"langs": langs, "filter": filt, "fpr": fill}


def _scores(data: np.ndarray, offs: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the best language, its score and the number of n-grams for each text of a slice."""
    key, row = _grams(data, offs)
    n, langs = len(offs) - 1, model["langs"]
    slots, total = _slots(key), np.bincount(row, minlength=n)
    masks = [np.bitwise_and.reduce([plane[s] for s in slots]) for plane in model["filter"]]
    best, most = np.zeros(n, np.int64), np.full(n, -1.0)
    for i in range(len(langs)):
        hit = np.bincount(row, ((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.float64), minlength=n)
        fixed = np.maximum(0.0, (hit - total * model["fpr"][i]) / max(1e-9, 1 - model["fpr"][i]))
        best, most = np.where(fixed > most, i, best), np.maximum(fixed, most)
    return best, np.clip(most / np.maximum(total, 1), 0.0, 1.0), total


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to rows that have ``doc_id`` and ``text``; other columns are dropped.

    The score is the share of a text's n-grams that the language knows, less the filter's expected false
    positives; ties go to the first language by name. A null text, or one without a letter, is ``und`` with
    score 0, as is every text where nothing was learned. Letters without any n-gram give the first language
    and score 0. Repeated rows are judged alike.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    src = docs.select("doc_id", F.coalesce(F.lower("text"), F.lit("")).alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m["langs"], "und"], object)
        for b in batches:
            data, offs = text_buffer(b.column("text"))
            letters = b.column("letters").to_numpy(zero_copy_only=False)
            for i, j in slices(offs):
                best, s, _ = _scores(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], m)
                ok = letters[i:j] & (len(m["langs"]) > 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(names[np.where(ok, best, len(m["langs"]))], pa.string()), pa.array(np.where(ok, s, 0.0))],
                    ["doc_id", "lang_pred", "score"],
                )

    return src.mapInArrow(score, "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: dict, least: float, enough: int = ENOUGH) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not ``und`` and scores ``least`` or more, or has fewer than ``enough``
    n-grams to judge by. Null and letterless texts go; without a learned language all go."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offs = text_buffer(b.column("__am_text"))
            ok = np.zeros(len(b), bool)
            for i, j in slices(offs):
                if shared.value["langs"]:
                    _, s, total = _scores(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], shared.value)
                    ok[i:j] = (s >= least) | (total < enough)
            good = b.filter(pa.array(ok))
            yield good.select([n for n in good.schema.names if n != "__am_text"])

    known = docs.where(F.col("text").rlike(r"\p{L}")).withColumn("__am_text", F.lower("text"))
    return known.mapInArrow(judge, docs.schema)


def identify(docs: DataFrame, mod: int = 5, rest: int = 0) -> DataFrame:
    """Learn from the rows outside the held-out fold, then predict every row: doc_id, held_out, lang_pred, score."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(src.where(in_fold(F.col("doc_id"), mod, rest)))
    return predict(src, model).select("doc_id", held_out(F.col("doc_id"), mod, rest).alias("held_out"), "lang_pred", "score")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
