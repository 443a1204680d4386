"""File systems by path, as Spark's readers name files: unescaped, with or without scheme and host."""

import re
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import SparkSession

_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)?$", re.DOTALL)


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the place in it; blanks, ``#`` and ``%`` stand for themselves."""
    found = _URI.match(path)
    if not found:
        return fs.LocalFileSystem(), path
    scheme, host, place = found.groups()
    if scheme == "file":
        return fs.LocalFileSystem(), place or "/"
    return fs.FileSystem.from_uri(f"{scheme}://{host or ''}{quote(place or '/')}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system; without one it is in the cluster's, as for every reader and sink."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a path or pattern names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath().toString() for status in found or []]


def remove(spark: SparkSession, path: str) -> None:
    """A folder and all in it, if it exists."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def put_in_place(store: fs.FileSystem, draft: str, place: str) -> None:
    """Moves a file, over an older one if there is one, also where the store refuses that."""
    try:
        store.move(draft, place)
    except OSError:
        if store.get_file_info(place).type != fs.FileType.File or store.get_file_info(draft).type != fs.FileType.File:
            raise
        store.delete_file(place)
        store.move(draft, place)
