"""Packing by decomposition into powers of two: each document's ids are cut into pieces of binary length, and each piece is a sequence of its own.

A document of n ids gives as many pieces of the full length as fit, then one piece for each bit of the rest, longest first. No sequence holds ids of two
documents and none is padded. Sequences of equal length share a bucket, from which batches are made.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import default_vocabulary, encode_text, load
from .common import small_batches

#: Longest sequence, and the id that ends a document.
LONGEST, END = 1024, 0
#: Pieces whose rows go back to Spark at once.
ROWS = 512
#: A sequence id holds its bucket, the task that made it and its number there, in these bits.
TASK_BITS, NUMBER_BITS = 24, 33
PIECES = "doc_id long, start long, length long, {} , doc_tokens long, sequence_id long, offset long, bucket int"


def cut(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of ``n`` ids, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, vocabulary: str | None = None, longest: int = LONGEST, digest: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start (ids of its document before it), length, ids (little-endian unsigned 32-bit integers; with
    ``digest`` their CRC-32, ids_crc32, instead), doc_tokens, sequence_id, offset (0, as a piece is its whole sequence) and bucket (the exponent of
    its length).

    A document's ids are those of its whole text and then END; a null or empty text has END alone. Special tokens standing in a text become their
    ids. Each row of ``docs`` is a document, those that share an id too; null ids stay null. Other columns are ignored. ``longest`` must be a power
    of two. Ids of sequences are unique, grow with the bucket, and are the same whenever the same files are read in the same splits; no
    shuffle is needed to give them.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"longest must be a power of two, not {longest}")
    path = vocabulary or default_vocabulary()
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in PIECES.format("ids_crc32 long" if digest else "ids binary").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = load(path)
        task = TaskContext.get().partitionId()
        if task >> TASK_BITS:
            raise ValueError(f"over 2**{TASK_BITS} tasks")
        made = [0] * longest.bit_length()
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = np.append(encode_text(encoding, text.as_py() or ""), np.uint32(END)).astype("<u4")
                start = 0
                for length in cut(len(ids), longest):
                    bucket = length.bit_length() - 1
                    raw = ids[start : start + length].tobytes()
                    name = (bucket << TASK_BITS | task) << NUMBER_BITS | made[bucket]
                    rows.append((doc_id, start, length, zlib.crc32(raw) if digest else raw, len(ids), name, 0, bucket))
                    made[bucket] += 1
                    start += length
                    if len(rows) >= ROWS:
                        yield batch()
        if rows:
            yield batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES.format("ids_crc32 long" if digest else "ids binary"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences in one folder for each length, from which a loader takes batches of one length."""
    packed.write.partitionBy("bucket").parquet(path)


def padding(packed: DataFrame) -> DataFrame:
    """Sequences, ids and padding of each bucket: what decides how batches of the buckets are mixed."""
    whole = packed.groupBy("bucket", "sequence_id").agg(F.sum("length").alias("filled"))
    return whole.groupBy("bucket").agg(F.count("*").alias("sequences"), F.sum("filled").alias("ids"), F.sum(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bucket")) - F.col("filled")).alias("padding"))


def op13_packing(spark, sf_dir: str) -> DataFrame:
    """The pieces of every document."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
