"""Archives of binary dumps: listing, decoding, points."""

from __future__ import annotations

import gzip
import io
import json
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import sn_of, utc_date
from .files import opened, reachable
from .scratch import written

#: Fixed layout: 32 bytes check, 4 version, 256 serial number, 41 name, 4 length.
HEADER = 337
#: What reading a damaged, encrypted or unknown kind of archive raises.
_BROKEN = (zipfile.BadZipFile, tarfile.TarError, zlib.error, OSError, EOFError, RuntimeError, NotImplementedError, ValueError)
FILES = "path string, member string, content binary, problem string"
SERIES_BLOCKS = "path string, member string, sn string, block int, start long, step int, resource_id string, element string, metric_id string, data array<int>, reason string, detail string"


def scan_tgz(spark: SparkSession, folder: str | list[str], prefix: str | None = None) -> DataFrame:
    """Every .tgz below a folder, by name prefix if given: path, member (null), content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{prefix or ''}*.tgz").load(folder)
    return files.select("path", F.lit(None).cast("string").alias("member"), "content", F.lit(None).cast("string").alias("problem"))


#: Bytes of archives that one task reads.
TASK_BYTES = 64 << 20
MEMBERS = "path string, member string, at long, packed long, size long, method int, flags int, crc long, problem string"


def zip_directory(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """A2: the .tgz members of every .zip below a folder, from the central directories alone: where each begins, its sizes and how it is packed. A zip
    whose directory can't be read has one row, with null member and ``problem``."""
    names = [x.split()[0] for x in MEMBERS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string()]

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                try:
                    with opened(path) as f, zipfile.ZipFile(f) as z:
                        rows = [(path, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.flag_bits, i.CRC, None) for i in z.infolist() if i.filename.endswith(".tgz")]
                except _BROKEN as e:
                    rows = [(path, None, None, None, None, None, None, None, _text(f"zip: {e}"))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return _zips(spark, folder).select("path").repartition("path").mapInArrow(members, MEMBERS)


def _zips(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(folder)


def _unpacked(f, at: int, packed: int, size: int, method: int, flags: int, crc: int) -> bytes:
    """One member of a zip, from its own bytes. Fixed layout: a local header of 30 bytes, which ends with the lengths of name and extra field, then these."""
    if flags & 1:
        raise _Bad("encrypted")
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise _Bad("zip_method", str(method))
    f.seek(at)
    head = f.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise _Bad("damaged_member", "no local header")
    name, extra = np.frombuffer(head, "<u2", 2, 26).tolist()
    f.seek(at + 30 + name + extra)
    raw = f.read(packed)
    try:
        out = zlib.decompressobj(-15).decompress(raw, size + 1) if method else raw
    except zlib.error as e:
        raise _Bad("damaged_member", str(e)) from e
    if len(out) != size or zlib.crc32(out) != crc:
        raise _Bad("damaged_member", "length or checksum")
    return out


def scan_zip_members(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """A2: the .tgz members of every .zip below a folder, one row each: path, member, content and ``problem``, which tells why a member (or, with null
    member, the zip) can't be read. What is dealt to tasks are the rows of ``zip_directory``; each task then reads the members' own bytes, so
    no content is shuffled and a zip may be of any size. Tasks open the files themselves; of a store that only Spark can open each zip is read whole,
    which Spark bounds at 2 GB."""
    folders = [folder] if isinstance(folder, str) else folder
    if not all(reachable(f) for f in folders):
        return _members_of_whole_zips(spark, folder)

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                content, problem = b"", r["problem"] and f"not_zip: {r['problem']}"
                if not problem:
                    try:
                        with opened(r["path"]) as f:
                            content = _unpacked(f, *(r[k] for k in ("at", "packed", "size", "method", "flags", "crc")))
                    except _Bad as e:
                        problem = f"{e.reason}: {e.detail}"
                    except OSError as e:
                        problem = _text(f"damaged_member: {e}")
                yield _file(r["path"], r["member"], content, problem)

    total = _zips(spark, folder).agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES), min(spark.sparkContext.defaultParallelism, 1 + total // (1 << 20)))
    return zip_directory(spark, folder).repartition(tasks, "path", "member").mapInArrow(contents, FILES)


def _file(path: str, member: str | None, content: bytes, problem: str | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([member], pa.string()), pa.array([content], pa.binary()), pa.array([problem], pa.string())], ["path", "member", "content", "problem"])


def _members_of_whole_zips(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                whole = io.BytesIO(content.as_py() or b"")
                try:
                    with zipfile.ZipFile(whole) as z:
                        found = [i for i in z.infolist() if i.filename.endswith(".tgz")]
                except _BROKEN as e:
                    yield _file(path, None, b"", _text(f"not_zip: {e}"))
                    continue
                for i in found:
                    try:
                        yield _file(path, i.filename, _unpacked(whole, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.flag_bits, i.CRC), None)
                    except _Bad as e:
                        yield _file(path, i.filename, b"", f"{e.reason}: {e.detail}")

    return _zips(spark, folder).select("path", "content").mapInArrow(members, FILES)


def _text(x) -> str:
    """At most 200 characters that any store can hold."""
    return str(x)[:200].encode("utf-8", "replace").decode()


class _Bad(Exception):
    def __init__(self, reason: str, detail: str = ""):
        self.reason, self.detail = reason, _text(detail)


def _dump(content: bytes) -> bytes:
    """A3: the one member of a .tgz. The stream is read to its end first, so that its checksum is verified."""
    if not content:
        raise _Bad("empty")
    try:
        with tarfile.open(fileobj=io.BytesIO(gzip.decompress(content)), mode="r:") as t:
            names = [m for m in t.getmembers() if m.isfile()]
            if len(names) != 1:
                raise _Bad("member_count", str(len(names)))
            return t.extractfile(names[0]).read()
    except _BROKEN as e:
        raise _Bad("not_gzip", str(e)) from e


#: The first second of the year 1 and the last of 9999, and the longest interval.
FIRST, LAST, LONGEST_STEP = -62135596800, 253402300799, (1 << 31) - 1


def _header(raw: bytes, size: int) -> tuple[int, int, int, list[tuple[str, str, str]]]:
    """Start, interval, rows and columns (resource, element, metric) that a block's header declares; ValueError, KeyError or TypeError for what is no header."""
    head = dict(json.loads(raw.decode("utf-8"), object_pairs_hook=list))
    start, end, step = int(head["StartTime"]), int(head["EndTime"]), int(head["Archive"])
    if not (FIRST <= start <= end <= LAST and 0 < step <= LONGEST_STEP):
        raise ValueError(f"times {start} to {end} by {step}")
    layout = [(r, dict(g)) for r, g in head["Map"]]
    kinds = {"Names": str, "DataTypes": (int, str)}
    for r, g in layout:
        for k, t in kinds.items():
            if not isinstance(g[k], list) or any(not isinstance(x, t) or isinstance(x, bool) for x in g[k]):
                raise TypeError(f"{k} of {r}")
    if sum(len(g["Names"]) * len(g["DataTypes"]) for _, g in layout) > size:
        raise ValueError("more columns than bytes")
    columns = [(r, e, str(m)) for r, g in layout for e in g["Names"] for m in g["DataTypes"]]
    for c in columns:
        "".join(c).encode("utf-8")  # half of a surrogate pair has no UTF-8
    return start, step, (end - start) // step, columns


def _blocks(raw: bytes):
    """Serial number, then for each block its header (repeated keys kept in order) and the matrix of whole rows."""
    if len(raw) < HEADER + 8:
        raise _Bad("truncated_header", str(len(raw)))
    sn = raw[36:292].split(b"\0")[0].decode("utf-8", "replace").strip()
    at = HEADER
    while at + 8 <= len(raw):
        kind, size = np.frombuffer(raw, "<i4", 2, at).tolist()
        if kind != 0 or size < 8:
            break
        try:
            start, step, rows, columns = _header(raw[at + 8 : at + size], len(raw))
        except (ValueError, KeyError, TypeError, OverflowError, RecursionError) as e:
            raise _Bad("bad_header", str(e)) from e
        at += size
        width = 4 * len(columns)
        whole = max(0, min(rows, (len(raw) - at) // width if width else 0))
        yield sn, start, step, columns, np.frombuffer(raw, "<i4", whole * len(columns), at).reshape(whole, len(columns))
        if whole < rows:  # a row that ends early ends the file
            return
        at += rows * width


def decode(files: DataFrame, resources=None, metrics=None) -> DataFrame:
    """A4: a row for each block, resource, element and metric with its values, or one row with ``reason`` for a file that can't be read: a file gives either, never
    both, so that one that is read again later leaves nothing twice. Never an exception for what a file holds. A ``problem`` of
    the scan becomes the reason. Ids to keep can be given, as Spark can't filter inside."""
    keep_r, keep_m = set(resources or ()), set(metrics or ())
    names = [x.split()[0] for x in SERIES_BLOCKS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.string()]
    told = "problem" in files.columns

    def rows_of(path, member, content, problem) -> list[tuple]:
        try:
            if problem:
                reason, _, detail = problem.partition(": ")
                raise _Bad(reason, detail)
            found = list(_blocks(_dump(content)))
        except _Bad as e:
            return [(path, member, *[None] * 8, e.reason, e.detail)]
        return [
            (path, member, sn, n, start, step, r, e, i, np.ascontiguousarray(m[:, k]), None, None)
            for n, (sn, start, step, columns, m) in enumerate(found)
            for k, (r, e, i) in enumerate(columns)
            if (not keep_r or r in keep_r) and (not keep_m or i in keep_m)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            problems = b.column("problem").to_pylist() if told else [None] * len(b)
            for path, member, content, problem in zip(b.column("path").to_pylist(), b.column("member").to_pylist(), b.column("content"), problems, strict=True):
                rows = rows_of(path, member, content.as_py(), problem)
                for i in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 500], strict=True), kinds, strict=True)], names)

    return files.mapInArrow(run, SERIES_BLOCKS)


def quarantine(blocks: DataFrame, attempt: int = 1) -> DataFrame:
    """The files that could not be read."""
    return blocks.where("reason IS NOT NULL").select("path", "member", "reason", "detail", F.lit(attempt).alias("attempt"))


def to_points(blocks: DataFrame) -> DataFrame:
    """One row for each value; row k of a block stands at start + k * step. The serial number is the file's own, else what the names of member, archive
    and folder tell."""
    named = F.coalesce(F.nullif("sn", F.lit("")), sn_of(F.coalesce("member", "path"), F.col("path")))
    rows = blocks.where("reason IS NULL").select(named.alias("sn"), "resource_id", "element", "metric_id", "start", "step", F.coalesce("member", "path").alias("source_file"), F.posexplode("data").alias("pos", "v"))
    ts = F.timestamp_seconds(F.col("start") + F.col("pos") * F.col("step"))
    return rows.select("sn", "resource_id", "element", "metric_id", ts.alias("ts"), F.col("v").cast("double").alias("value"), F.col("step").alias("scrape_interval"), "source_file")


def ingest(files: DataFrame, metrics: DataFrame, resources: DataFrame, include_unknown: bool = True) -> tuple[DataFrame, DataFrame]:
    """A4, A5, B1, C1, C2 in one: points in the shape of the store, and the quarantine."""
    return ingested(decode(files), metrics, resources, include_unknown)


def ingested(blocks: DataFrame, metrics: DataFrame, resources: DataFrame, include_unknown: bool = True) -> tuple[DataFrame, DataFrame]:
    """As ``ingest``, from decoded blocks."""
    from ..model import POINTS
    from ..operators.joins import convert_units, resolve_names
    from ..operators.select import select_ids

    kept = select_ids(blocks.where("reason IS NULL"), include_unknown=include_unknown, dims=(resources, metrics))
    points = convert_units(resolve_names(to_points(kept), metrics, resources), metrics).withColumn("dt", utc_date(F.col("ts")))
    return points.select(*(x.split()[0] for x in POINTS.split(", "))), quarantine(blocks)


def batches_in_order(files: DataFrame, most_bytes: int) -> DataFrame:
    """Path, length and ``batch`` of files, by name and then path; a batch begins where the bytes before it pass a multiple of ``most_bytes``, so none holds more than that and
    one file. Running sums are taken within parts of a deal by range and shifted by those of earlier parts."""
    spark = files.sparkSession
    named = files.select("path", "length", F.element_at(F.split("path", "/"), -1).alias("name"))
    dealt = written(named.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "name", "path").withColumn("part", F.spark_partition_id()))
    sums = dealt.groupBy("part").agg(F.sum("length").alias("own"))
    before = sums.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))  # a row for each part
    inside = F.sum("length").over(Window.partitionBy("part").orderBy("name", "path")) - F.col("length")
    return dealt.withColumn("ahead", inside).join(before, "part").select("path", "length", F.floor((F.col("before") + F.col("ahead")) / most_bytes).alias("batch"))


def archives(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """Path and length of the .zip and .tgz files below a folder, no content read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{zip,tgz}").load(folder)
    return found.select("path", "length")
