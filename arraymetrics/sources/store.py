"""The point store: Parquet by day and array, and lists of the files that count.

``data/load=<name>/dt=<day>/sn=<array>/`` holds files that are written once and never changed; ``lists/<name>`` is a table with a row for each live
file; ``commits/<number>`` names the list that holds from that commit on. What a load or a deletion writes counts from its commit,
which is one new file; until then, and after a crash before it, readers see the store as it was.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import utc_date
from ..model import POINTS

LISTED = "file string, dt date, sn string, n_rows long, bytes long, source string, batch long"
_KEYS = ["dt", "sn"]


class Conflict(RuntimeError):
    """Another writer has committed since this one began. Nothing of this one counts; it can be run again."""


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _plain(path: str) -> str:
    """A path to read as it is, not as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _names(spark: SparkSession, path: str) -> list[str]:
    system, at = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def _current(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The number of the last commit, and the list that it names; a commit whose line was not finished doesn't count."""
    numbers = sorted((int(n) for n in _names(spark, f"{path}/commits") if n.isdigit()), reverse=True)
    for n in numbers:
        line = spark.read.text(_plain(f"{path}/commits/{n:012d}"), wholetext=True).first()
        if line is not None and line[0].endswith("\n"):
            return numbers[0], line[0].strip()
    return (numbers[0] if numbers else 0), None


def _files(spark: SparkSession, path: str, name: str | None) -> DataFrame:
    return spark.createDataFrame([], LISTED) if name is None else spark.read.schema(LISTED).parquet(_plain(f"{path}/lists/{name}"))


def files(spark: SparkSession, path: str) -> DataFrame:
    """The files that count: file, dt, sn, n_rows, bytes, and the source and batch of the load, if it had any."""
    return _files(spark, path, _current(spark, path)[1])


def _commit(spark: SparkSession, path: str, listed: DataFrame, seen: int) -> None:
    name = uuid.uuid4().hex
    listed.select(*(x.split()[0] for x in LISTED.split(", "))).coalesce(1).write.parquet(f"{path}/lists/{name}")
    system, at = _at(spark, f"{path}/commits/{seen + 1:012d}")
    try:
        out = system.create(at, False)
    except Exception as e:
        if system.exists(at):
            raise Conflict(f"commit {seen + 1} of {path}") from e
        raise
    out.write(bytearray(f"{name}\n".encode()))
    out.close()


def _written(df: DataFrame, path: str, source: str | None, batch: int | None) -> DataFrame:
    """Write ``df`` to a load of its own: its files. Small days of an array leave one file each, since the rows of a day and array meet; large
    ones are split by bytes as Spark finds them while it runs."""
    spark = df.sparkSession
    load = f"{path}/data/load={uuid.uuid4().hex}"
    df = df.withColumn("dt", utc_date(F.col("ts"))).select(*(x.split()[0] for x in POINTS.split(", ")))
    df.hint("rebalance", "dt", "sn").sortWithinPartitions("dt", "sn", "ts").write.partitionBy("dt", "sn").parquet(load)
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = spark.read.schema(POINTS).parquet(_plain(load)).select(*_KEYS, name.alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return rows.groupBy(*_KEYS, "file", "bytes").agg(F.count("*").alias("n_rows")).withColumn("source", F.lit(source).cast("string")).withColumn("batch", F.lit(batch).cast("long"))


def _without(listed: DataFrame, touched: DataFrame) -> DataFrame:
    t = touched.select(F.col("dt").alias("_dt"), F.col("sn").alias("_sn")).distinct()
    return listed.join(t, F.col("dt").eqNullSafe(F.col("_dt")) & F.col("sn").eqNullSafe(F.col("_sn")), "left_anti")


def _within(listed: DataFrame, touched: DataFrame) -> DataFrame:
    t = touched.select(F.col("dt").alias("_dt"), F.col("sn").alias("_sn")).distinct()
    return listed.join(t, F.col("dt").eqNullSafe(F.col("_dt")) & F.col("sn").eqNullSafe(F.col("_sn")), "left_semi")


def write_points(df: DataFrame, path: str, mode: str = "append", source: str | None = None, batch: int | None = None) -> None:
    """Add points (``append``), or put them in place of the days and arrays that they touch (``overwrite``). With ``source`` and ``batch`` the load takes
    the place of an earlier one of the same names, so that a batch that runs twice leaves one copy."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    spark = df.sparkSession
    seen, name = _current(spark, path)
    new = _written(df, path, source, batch)
    old = _files(spark, path, name)
    if source is not None:
        old = old.where(~(F.col("source").eqNullSafe(F.lit(source)) & F.col("batch").eqNullSafe(F.lit(batch).cast("long"))))
    if mode == "overwrite":
        old = _without(old, new)
    _commit(spark, path, old.unionByName(new), seen)


def _read(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    names = [_plain(r.file) for r in listed.select("file").collect()]
    if not names:
        return spark.createDataFrame([], POINTS)
    return spark.read.schema(POINTS).option("basePath", f"{path}/data").parquet(*names).select(*(x.split()[0] for x in POINTS.split(", ")))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The points of the last commit. Predicates on ``dt`` and ``sn`` leave whole files out."""
    return _read(spark, path, files(spark, path))


def without(df: DataFrame, selector: Column) -> DataFrame:
    """The points that a selector leaves; where it is null they stay."""
    return df.where(~F.coalesce(selector, F.lit(False)))


def delete_points(spark: SparkSession, path: str, sn: str | None = None, selector: Column | None = None) -> None:
    """Delete, in place, the points of an array, of a selector, or those that fit both; of neither, all. Without a selector files only leave the
    list and no data is read. Else the days and arrays that hold such points are found by a scan and only they are written anew."""
    seen, name = _current(spark, path)
    listed = _files(spark, path, name)
    own = listed if sn is None else listed.where(F.col("sn") == sn)
    if selector is None:
        _commit(spark, path, listed.where("false") if sn is None else listed.where(~F.coalesce(F.col("sn") == sn, F.lit(False))), seen)
        return
    touched = _read(spark, path, own).where(selector).select(*_KEYS).distinct()
    parts = spark.createDataFrame(touched.collect(), "dt date, sn string")  # a row for each day and array, as in the list
    new = _written(without(_read(spark, path, _within(own, parts)), selector), path, None, None)
    _commit(spark, path, _without(listed, parts).unionByName(new), seen)


def remove_unlisted(spark: SparkSession, path: str) -> int:
    """Remove the loads none of whose files count any more, and older lists; for times when nothing writes or reads an earlier state. Returns the number
    of loads removed."""
    _, name = _current(spark, path)
    live = {r[0] for r in _files(spark, path, name).select(F.regexp_extract("file", "/data/(load=[^/]+)/", 1)).distinct().collect()}
    gone = [f"data/{n}" for n in _names(spark, f"{path}/data") if n not in live]
    for part in gone + [f"lists/{n}" for n in _names(spark, f"{path}/lists") if n != name]:
        system, at = _at(spark, f"{path}/{part}")
        system.delete(at, True)
    return len(gone)
