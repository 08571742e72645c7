"""Files that are still being written are left alone until they have stopped growing.

Each trigger lists the folder; a stateful operator, keyed by path, holds the size that it saw and since when, and passes a file on once its size has
been the same for a while. Spark's own file source would take a file as it is when it first shows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.archive import FILES
from ..sources.files import opened, resolved

LISTED = "path string, length long, listed timestamp"
#: Milliseconds after which a path that is listed no more is forgotten.
FORGET = 24 * 3600 * 1000


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.prefix = options["path"], options.get("prefix", "")

    def initialOffset(self) -> dict:
        return {"listings": 0}

    def _rows(self) -> Iterator[tuple]:
        system, at = resolved(self.folder)
        head = self.folder[: len(self.folder) - len(at)] or "file:"
        now = dt.datetime.now(dt.timezone.utc)
        for i in system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True)):
            if i.type == fs.FileType.File and i.base_name.startswith(self.prefix) and i.base_name.endswith(".tgz"):
                yield (head + i.path if not i.path.startswith(head) else i.path), i.size, now

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        return iter(list(self._rows())), {"listings": start["listings"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """A batch that runs again lists anew: what is listed then still tells which files have stopped growing."""
        return self._rows()


class Listing(DataSource):
    """The .tgz files below a folder with their sizes, all of them at each trigger."""

    @classmethod
    def name(cls) -> str:
        return "arraymetrics_listing"

    def schema(self) -> str:
        return LISTED

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Reader(self.options)


def listings(spark: SparkSession, folder: str, prefix: str = "PerfData_") -> DataFrame:
    spark.dataSource.register(Listing)
    return spark.readStream.format(Listing.name()).option("prefix", prefix).load(folder)


def settled(listed: DataFrame, seconds: float = 30.0) -> DataFrame:
    """path and length of each file once its size has been the same, and not 0, for ``seconds``; once, unless its size changes later."""
    import pandas as pd

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = pd.concat(list(frames)).sort_values("listed").iloc[-1]
        length, now = int(last["length"]), int(last["listed"].timestamp() * 1000)
        before, since, done = state.get if state.exists else (-1, now, False)
        if before != length:
            since, done = now, False
        elif not done and length > 0 and now - since >= seconds * 1000:
            done = True
            yield pd.DataFrame({"path": [key[0]], "length": [length]})
        state.update((length, since, done))
        state.setTimeoutDuration(FORGET)

    return listed.groupBy("path").applyInPandasWithState(step, "path string, length long", "length long, since long, done boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in FILES.split(", ")]
    for b in batches:
        for path in b.column("path").to_pylist():
            content, problem = b"", None
            try:
                with opened(path) as f:
                    content = f.read()
            except OSError as e:
                problem = f"gone: {str(e)[:150]}"
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([None], pa.string()), pa.array([content], pa.binary()), pa.array([problem], pa.string())], names)


def uploads(spark: SparkSession, folder: str, prefix: str = "PerfData_", seconds: float = 30.0) -> DataFrame:
    """The files below a folder as a stream, each whole, after it has not grown for ``seconds``. Run it with a processing-time trigger, as a file is only
    known to have settled by a later listing."""
    return settled(listings(spark, folder, prefix), seconds).mapInArrow(_contents, FILES)
