"""Helpers shared by the operators: scratch tables in the cluster's shared folder, and vectorised
hashing of words and byte windows over whole Arrow batches.

A batch is handled in slices of a few MB, so that memory in a task follows the slice (or the longest
single document), not the partition.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1_000_000

#: Bytes of a batch of rows on its way between Spark and a Python worker.
BATCH_BYTES = 4 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_PRIME, _LOW30, _LOW31, _LOW32 = (np.uint64((1 << n) - d) for n, d in ((61, 1), (30, 1), (31, 1), (32, 1)))
_BASES = (0x1E3779B97F4A7C15, 0x16E8FEB86659FD93)
_SEEDS = (11, 23)
#: Bytes of a word beyond which it is hashed on its own.
LONG_WORD = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the one set on the context. Only Spark in one process gets one of its own where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="arraymetrics-")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: the lineage ends there and lost
    executors cost nothing but a reread."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/am-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # the shuffles behind the table are not needed once it stands
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` or ``bucketed`` wrote, once all that was read from them is stored itself."""
    for t in tables:
        spark = t.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if at.getName().startswith("am_"):
                spark.sql(f"DROP TABLE IF EXISTS {at.getName()}")
            if at.getName().startswith(("am-", "am_")):
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """As ``stored``, in as many buckets of ``key`` as there are shuffle partitions: joins on the key don't move the table again."""
    spark = df.sparkSession
    name = f"am_{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.bucketBy(partitions(spark), key).sortBy(key).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.table(name)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable ``checkpoint()`` in the shared folder, for small tables in loops."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def small_batches(spark: SparkSession) -> None:
    """Have texts go to Python in batches of BATCH_BYTES, where the session names no size of its own. Spark's default of 64 MB is held several
    times over in every task: as rows, in Arrow's vectors on both sides of the pipe, and in what comes back. A batch holds one row at least."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, is ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % mod == rest, F.lit(False))


def in_fold(doc_id: Column, mod: int, rest: int) -> Column:
    """Rows to learn from: a non-null id whose remainder is not ``rest``."""
    return doc_id.isNotNull() & ~held_out(doc_id, mod, rest)


# ---------------------------------------------------------------- vectorised text


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and n + 1 offsets into them; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and o[-1] > 0 else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``limit`` bytes, one row at least."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime 2**61 - 1 of numbers below it, by halves that fit 64 bits."""
    a1, a0, b1, b0 = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    mid = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << np.uint64(1)) + (mid >> np.uint64(30)) + ((mid & _LOW30) << np.uint64(31)) + a0 * b0)


class Rolling:
    """Polynomial prefix hashes modulo the prime 2**61 - 1 of a sequence of 64-bit values; any window's hash is then one subtraction and
    one product. A prime modulus has no sequences that collide for every base, as a power of two has (Thue-Morse sequences)."""

    _pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        power, self.inverse = self._powers(n + 1, which)
        term = _times(_reduced(values), power[:n])
        high, low = np.cumsum(term >> np.uint64(32)), np.cumsum(term & _LOW32)  # neither sum passes 64 bits
        high = _reduced(high)
        self.prefix = np.zeros(n + 1, np.uint64)
        self.prefix[1:] = _reduced(((high & np.uint64((1 << 29) - 1)) << np.uint64(32)) + (high >> np.uint64(29)) + low)

    @classmethod
    def _powers(cls, n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._pow.get(which)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            base = _BASES[which] % int(_PRIME)
            pair = []
            for b in (base, pow(base, -1, int(_PRIME))):
                p = np.empty(size, np.uint64)
                p[0] = 1
                done, step = 1, b
                while done < size:
                    take = min(done, size - done)
                    p[done : done + take] = _times(p[:take], np.uint64(step))
                    step = step * step % int(_PRIME)
                    done += take
                pair.append(p)
            have = cls._pow[which] = (pair[0], pair[1])
        return have

    def windows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(_times(_reduced(self.prefix[end] + (_PRIME - self.prefix[start])), self.inverse[start]))


def grams8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one number; none for the last 7 places."""
    if len(data) < 8:
        return np.zeros(0, np.uint64)
    return np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data).data, strides=(1,)).copy()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH3 of byte ranges: an array of 64-bit numbers."""
    view, h = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_64_intdigest
    return np.fromiter((h(view[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))


def span_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit XXH3 of byte ranges: an array of pairs of 64-bit numbers."""
    view, h = memoryview(np.ascontiguousarray(data)), xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([h(view[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]), "<u8").reshape(-1, 2)


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each word: 8 bytes at a time; those of over LONG_WORD bytes by XXH3."""
    size = end - start
    h = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    packed = grams8(np.concatenate([data, np.zeros(8, np.uint8)]))
    rows, k = np.flatnonzero(size <= LONG_WORD), 0
    while len(rows):
        left = size[rows] - k
        shift = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
        h[rows] = mix(h[rows] * np.uint64(0xD6E8FEB86659FD93) + (packed[start[rows] + k] << shift))
        k += 8
        rows = rows[left > 8]
    long = np.flatnonzero(size > LONG_WORD)
    if len(long):
        h[long] = mix(span_hashes(data, start[long], end[long]) + np.uint64(seed))
    return h


#: Classes of bytes. Bytes of 0x80 and up count as letters, so that no UTF-8 character is split.
SPACE, WORD, PUNCT = 0, 1, 2


def byte_classes(kind: str) -> np.ndarray:
    """``space``: all but space and 0x09-0x0D are word bytes. ``alnum``: ASCII letters, digits and bytes of
    0x80 and up are. ``runs``: as alnum, and runs of other visible bytes are words of their own."""
    b = np.arange(256)
    blank = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    if kind == "space":
        return np.where(blank, SPACE, WORD).astype(np.uint8)
    letter = ((b >= 48) & (b <= 57)) | ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122)) | (b >= 128)
    other = PUNCT if kind == "runs" else SPACE
    return np.where(letter, WORD, np.where(blank, SPACE, other)).astype(np.uint8)


class Words:
    """The words of a slice of texts: byte ranges, 64-bit hashes, and the first word of each text."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, kind: str, two: bool = False):
        c = byte_classes(kind)[data]
        edge = np.ones(len(data) + 1, bool)
        if len(data):
            edge[1:-1] = c[1:] != c[:-1]
            edge[offs] = True
        at = np.flatnonzero(edge)
        first, last = at[:-1], at[1:]
        keep = c[first] != SPACE if len(data) else np.zeros(0, bool)
        self.start, self.end = first[keep], last[keep]
        self.doc = np.searchsorted(self.start, offs, side="left")
        self.hash = _word_hashes(data, self.start, self.end, _SEEDS[0])
        self.hash2 = _word_hashes(data, self.start, self.end, _SEEDS[1]) if two else None

    def __len__(self) -> int:
        return len(self.start)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """First word of each run of ``n`` words within one text, and the hashes of the runs."""
        left = self.left()
        first = np.flatnonzero(left >= n)
        h = Rolling(self.hash).windows(first, first + n)
        h2 = Rolling(self.hash2, 1).windows(first, first + n) if self.hash2 is not None else None
        return first, h, h2

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text."""
        stop = np.repeat(self.doc[1:], np.diff(self.doc))
        return stop - np.arange(len(self.start))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the ranges."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0
