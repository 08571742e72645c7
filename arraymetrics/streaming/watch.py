"""A directory of dumps as a stream of points."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.archive import FILES, decode, ingested, quarantine, scan_tgz, scan_zip_members
from ..sources.store import read_points, write_points

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def watch(spark: SparkSession, folder: str, prefix: str = "PerfData_", most_files: int = 100, clean: str = "off", archive: str | None = None) -> DataFrame:
    """New .tgz files below a folder, oldest first, each read once (the checkpoint remembers). Empty files wait
    for nothing: they are left out; files should land by rename (``uploads`` waits for files that grow). ``clean``: off, delete or archive."""
    reader = spark.readStream.format("binaryFile").schema(_FILE).option("pathGlobFilter", f"{prefix}*.tgz").option("recursiveFileLookup", True)
    reader = reader.option("maxFilesPerTrigger", most_files).option("latestFirst", False).option("cleanSource", clean)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return reader.load(folder).where("length > 0").select("path", F.lit(None).cast("string").alias("member"), "content", F.lit(None).cast("string").alias("problem"))


def stream_points(files: DataFrame, metrics: DataFrame, resources: DataFrame, out: str, bad: str, checkpoint: str, seconds: float | None = None, totals: str | None = None) -> StreamingQuery:
    """Decode and append to the store ``out``. Each batch is one load under the number of the batch and the name of the checkpoint, which takes the place of
    what the same batch wrote before, so a batch that runs twice leaves one copy; its unreadable files and its counts go to folders named by the batch.
    ``seconds`` None: take what is there, then end. ``totals``: folder of the counts, by default beside the checkpoint."""
    totals = totals or f"{checkpoint.rstrip('/')}-totals"

    def load(batch: DataFrame, number: int) -> None:
        blocks = decode(batch).persist()  # points and lost files come from one decoding
        try:
            points, lost = ingested(blocks, metrics, resources)
            seen = Observation(f"load-{uuid.uuid4().hex}")
            points = points.observe(seen, F.count("*").alias("points"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
            write_points(points, out, source=checkpoint, batch=number)
            lost.write.mode("overwrite").parquet(f"{bad}/batch={number}")
            bound = {k: F.lit(seen.get[k]) for k in ("points", "first_ts", "last_ts")}
            each = blocks.groupBy("path", "member").agg(F.bool_or(F.col("reason").isNotNull()).alias("failed"))
            row = each.agg(F.count_if(~F.col("failed")).alias("processed"), F.count_if("failed").alias("failed"))
            row = row.select("processed", "failed", bound["points"].cast("long").alias("points"), bound["first_ts"].cast("timestamp").alias("first_ts"), bound["last_ts"].cast("timestamp").alias("last_ts"))
            row.coalesce(1).write.mode("overwrite").parquet(f"{totals}/batch={number}")
        finally:
            blocks.unpersist()

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def read_stream_points(spark: SparkSession, out: str) -> DataFrame:
    return read_points(spark, out)


def running_totals(spark: SparkSession, checkpoint: str, totals: str | None = None) -> DataFrame:
    """I8: batches, files processed and failed, points and their extent of a load since it first began, over all restarts."""
    rows = spark.read.schema("processed long, failed long, points long, first_ts timestamp, last_ts timestamp, batch long").parquet(totals or f"{checkpoint.rstrip('/')}-totals")
    return rows.agg(F.count("*").alias("batches"), F.sum("processed").alias("processed"), F.sum("failed").alias("failed"), F.sum("points").alias("points"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def counters(points: DataFrame, lost: DataFrame) -> DataFrame:
    """I8: files processed and failed, points."""
    done = points.agg(F.count_distinct("source_file").alias("processed"), F.count("*").alias("points"))
    return done.withColumn("_", F.lit(1)).join(lost.agg(F.count("*").alias("failed")).withColumn("_", F.lit(1)), "_").drop("_")


def observed(points: DataFrame, name: str = "points") -> DataFrame:
    """I8: the same rows; their number and span come with each batch's progress, at no extra pass."""
    return points.observe(name, F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


class Progress(StreamingQueryListener):
    """I8: running totals of the observed points of all queries of a session."""

    def __init__(self, name: str = "points"):
        self.name, self.batches, self.points = name, 0, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        self.batches += 1
        self.points += row.n if row is not None else 0

    def onQueryTerminated(self, event) -> None:
        pass


def _folders(spark: SparkSession, paths: DataFrame) -> list[str]:
    """The folders that hold ``paths`` and still exist, without those below another one."""
    found: list[str] = []
    for folder in sorted(r[0] for r in paths.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).distinct().collect()):
        at = spark._jvm.org.apache.hadoop.fs.Path(folder or "/")
        if not any(folder.startswith(f"{f}/") for f in found) and at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            found.append(folder)
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", f) or "/" for f in found]


def retry_quarantine(spark: SparkSession, lost: DataFrame, most: int = 3, folders: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """I4: files and zip members of the quarantine read again: their blocks, and the quarantine that is left. In it stand those that still
    fail, with the attempt counted, and unchanged those given up (tried ``most`` times) and those no longer found. A zip that
    couldn't be opened is read again with all its members. ``folders`` are scanned; None: those that hold the files."""
    again = lost.groupBy("path", "member").agg(F.max("attempt").alias("attempt")).where(F.col("attempt") < most)
    again = again.select(F.col("path").alias("_path"), F.col("member").alias("_member"), F.col("attempt").alias("_attempt"))
    folders = _folders(spark, again.select(F.col("_path").alias("path"))) if folders is None else folders
    if not folders:
        return decode(spark.createDataFrame([], FILES)), lost.select("path", "member", "reason", "detail", "attempt")
    meant = (F.col("path") == F.col("_path")) & (F.col("member").eqNullSafe(F.col("_member")) | (F.col("_member").isNull() & F.col("_path").endswith(".zip")))
    files = scan_tgz(spark, folders).unionAll(scan_zip_members(spark, folders)).join(again, meant, "left_semi")
    blocks = decode(files)
    failed = quarantine(blocks).drop("attempt").join(again, meant).groupBy("path", "member", "reason", "detail").agg((F.max("_attempt") + 1).alias("attempt"))
    read = again.join(files.select("path", "member"), meant, "left_semi").drop("_attempt")
    rest = lost.join(read, (F.col("path") == F.col("_path")) & F.col("member").eqNullSafe(F.col("_member")), "left_anti")
    return blocks.where("reason IS NULL"), failed.unionByName(rest.select(*failed.columns))


def rollup(points: DataFrame, late: str = "1 hour", width: str = "5 minutes") -> DataFrame:
    """Statistics of each series by event-time window; windows close when the watermark passes them."""
    keys = ["sn", "resource", "element", "metric"]
    out = points.withWatermark("ts", late).groupBy(*keys, F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.max("value").alias("max"), F.min("value").alias("min"), F.avg("value").alias("avg"))
    return out.select(*keys, F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "n", "max", "min", "avg")
