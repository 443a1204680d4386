"""Data sources for folders of files: a listing whose partitions are folders, and a sink of one file per row."""

import fnmatch
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from sleeveworks.sources.places import located, put_in_place

#: Files that one batch of a listing, or of moves, holds.
BATCH = 10_000
#: Moves at a time when a write is committed.
MOVES = 32


def _hidden(name: str) -> bool:
    """What Spark's readers pass over, too."""
    return name.startswith((".", "_"))


@dataclass
class Folders(InputPartition):
    """Folders to list, with all below them or only the files directly in them; ``prefix`` is what paths begin with."""

    prefix: str
    store: str
    whole: list[str]
    flat: list[str]


class Listing(DataSource):
    """``path, length, modified`` of files, also of those without a byte.

    Options: ``roots`` (JSON list of folders or files), ``glob`` (for names), ``partitions`` (how many are aimed
    at). Folders are split into partitions down to the level where there are enough of them; the
    driver sees folder names above that level, and files are listed by the tasks.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return "path string, length long, modified timestamp"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Lister(json.loads(self.options["roots"]), self.options.get("glob", "*"), int(self.options.get("partitions", "64")))


class _Lister(DataSourceReader):
    def __init__(self, roots: list[str], glob: str, wanted: int):
        self.roots, self.glob, self.wanted = roots, glob, wanted

    def partitions(self) -> list[Folders]:
        out: list[Folders] = []
        for root in self.roots:
            store, place = located(root)
            prefix = root[:len(root) - len(place)] if root.endswith(place) else ""
            if store.get_file_info(place).type == fs.FileType.File:
                out.append(Folders(prefix, root, [], [place]))
                continue
            level, flat = [place.rstrip("/") or "/"], []
            # One level deeper as long as there are too few folders to share out.
            while 0 < len(level) < self.wanted:
                below = [f.path for folder in level for f in store.get_file_info(fs.FileSelector(folder))
                         if f.type == fs.FileType.Directory and not _hidden(f.base_name)]
                flat, level = flat + level, below
            out += [Folders(prefix, root, level[i::self.wanted], flat[i::self.wanted]) for i in range(self.wanted)
                    if level[i::self.wanted] or flat[i::self.wanted]]
        return out or [Folders("", "", [], [])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        if not partition.store:
            return
        store, _ = located(partition.store)
        found: list[fs.FileInfo] = []
        folders = [(f, True) for f in partition.whole] + [(f, False) for f in partition.flat]
        while folders:
            folder, deep = folders.pop()
            info = store.get_file_info(folder)
            inside = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(folder))
            for f in inside:
                if _hidden(f.base_name):
                    continue
                if f.type == fs.FileType.Directory:
                    folders += [(f.path, True)] if deep else []
                elif fnmatch.fnmatchcase(f.base_name, self.glob):
                    found.append(f)
            if len(found) >= BATCH:
                yield self._batch(partition.prefix, found)
                found = []
        yield self._batch(partition.prefix, found)

    @staticmethod
    def _batch(prefix: str, files: list[fs.FileInfo]) -> pa.RecordBatch:
        times = pa.array([(f.mtime_ns or 0) // 1000 for f in files], pa.int64()).cast(pa.timestamp("us", "UTC"))
        return pa.RecordBatch.from_arrays([pa.array([prefix + f.path for f in files], pa.string()),
                                           pa.array([f.size for f in files], pa.int64()), times], names=["path", "length", "modified"])


@dataclass
class Drafts(WriterCommitMessage):
    """The folder of one task's drafts."""

    folder: str


class FileSink(DataSource):
    """One file per row, named by the first column, sub-folders included, holding the text of the second.

    A task writes drafts into a hidden folder of its own attempt. When all tasks are done, the drafts of
    those that counted are moved into place and the folder goes, with whatever lost tasks left in it; when the
    write fails, the folder goes and nothing else has changed. Existing files of the same names are replaced.
    """

    @classmethod
    def name(cls) -> str:
        return "file_per_row"

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("files are added or replaced one by one; write with mode append")
        return _Drafter(self.options["path"])


class _Drafter(DataSourceArrowWriter):
    def __init__(self, directory: str):
        self.directory = directory.rstrip("/")
        self.drafts = f"{self.directory}/.drafts-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Drafts:
        folder = f"{self.drafts}/{uuid.uuid4().hex}"
        store, root = located(folder)
        made = {""}
        store.create_dir(root, recursive=True)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not name or any(part in ("", ".", "..") for part in name.split("/")):
                    raise ValueError(f"not a file name: {name!r}")
                below = name.rpartition("/")[0]
                if below not in made:
                    store.create_dir(f"{root}/{below}", recursive=True)
                    made.add(below)
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write((text or "").encode())
        return Drafts(folder)

    def commit(self, messages: list[Drafts | None]) -> None:
        store, target = located(self.directory)
        store.create_dir(target, recursive=True)

        def move(pair: tuple[str, str]) -> None:
            put_in_place(store, *pair)

        with ThreadPoolExecutor(MOVES) as pool:
            for message in filter(None, messages):
                _, root = located(message.folder)
                found = store.get_file_info(fs.FileSelector(root, recursive=True))
                for folder in sorted({f"{target}/{f.path[len(root) + 1:]}" for f in found if f.type == fs.FileType.Directory}):
                    store.create_dir(folder, recursive=True)
                list(pool.map(move, [(f.path, f"{target}/{f.path[len(root) + 1:]}") for f in found if f.type == fs.FileType.File]))
        self._drop()

    def abort(self, messages: list[Drafts | None]) -> None:
        self._drop()

    def _drop(self) -> None:
        store, place = located(self.drafts)
        if store.get_file_info(place).type == fs.FileType.Directory:
            store.delete_dir(place)


def register(spark: SparkSession) -> SparkSession:
    """Makes the sources known to a session by their names."""
    for source in (Listing, FileSink):
        spark.dataSource.register(source)
    return spark
