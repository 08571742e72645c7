"""Files opened in tasks, for what Spark's readers can't do: reading a part of a file, or asking how large it is now."""

from __future__ import annotations

import io
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs


def resolved(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it (``file:/a b``, ``hdfs://host/a``, ``/a``), and the path in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def reachable(path: str) -> bool:
    """Whether tasks can open files there without Spark."""
    try:
        resolved(path)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


class _Raw(io.RawIOBase):
    """A file of pyarrow with the manners of Python's own."""

    def __init__(self, file):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0, self.file.tell(), self.file.size())[whence]
        if at < 0:
            raise OSError(f"seek to {at}")
        return self.file.seek(at)

    def readinto(self, into) -> int:
        got = self.file.read(len(into))
        into[: len(got)] = got
        return len(got)

    def close(self) -> None:
        self.file.close()
        super().close()


def opened(path: str) -> io.BufferedReader:
    """The file, to seek and read in."""
    system, at = resolved(path)
    return io.BufferedReader(_Raw(system.open_input_file(at)))
