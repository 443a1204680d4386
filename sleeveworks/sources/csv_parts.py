"""CSV files with line ends inside quotes, each read by many tasks.

Where a range of bytes begins nobody knows whether a line end is inside quotes. So a range is first read as a
function: from each state that it may begin in, to the state it ends in. Bytes are reduced to such
functions pairwise, by a table of their products. The functions of a file's ranges, one number each, are then
applied one after the other, which gives every range its beginning; and a range reads the records
that follow a line end inside it, the last one to its end beyond the range.
"""

import csv
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sleeveworks.functions.scalars import null_spellings
from sleeveworks.sources.manifest import scan_files
from sleeveworks.sources.places import located

#: Bytes of a range, bytes looked through at a time for a record's end, and rows of a batch.
PART, LOOK, ROWS = 1 << 24, 1 << 16, 10_000

# States: at the beginning of a field, in a plain field, in a quoted one, and after a quote in a quoted one.
START, PLAIN, QUOTED, AFTER = range(4)
# Where a byte leads from each state: any other byte, a quote, a comma, a line end.
_STEPS = [(PLAIN, PLAIN, QUOTED, PLAIN), (QUOTED, PLAIN, AFTER, QUOTED), (START, START, QUOTED, START), (START, START, QUOTED, START)]
_KIND = np.zeros(256, np.uint8)
_KIND[ord('"')], _KIND[ord(",")], _KIND[ord("\n")] = 1, 2, 3


def _products() -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All functions that sequences of bytes have, the steps first, and the table of their products."""
    found = [*dict.fromkeys([*_STEPS, (0, 1, 2, 3)])]
    for f in found:
        for g in _STEPS:
            both = tuple(g[s] for s in f)
            if both not in found:
                found.append(both)
    place = {f: i for i, f in enumerate(found)}
    return found, np.array([[place[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8)


FUNCTIONS, _PRODUCT = _products()
_FIRST = np.array([FUNCTIONS.index(_STEPS[k]) for k in _KIND], np.uint8)


def effect(data: bytes) -> int:
    """Number of the function of a stretch of bytes."""
    parts = _FIRST[np.frombuffer(data, np.uint8)]
    if not len(parts):
        return FUNCTIONS.index((0, 1, 2, 3))
    while len(parts) > 1:
        even = len(parts) // 2 * 2
        joined = _PRODUCT[parts[0:even:2], parts[1:even:2]]
        parts = np.append(joined, parts[even:])
    return int(parts[0])


def _line_end(file, at: int, state: int, size: int) -> int:
    """Place after the first line end outside quotes from a place on; the file's size if there is none."""
    while at < size:
        file.seek(at)
        data = file.read(min(LOOK, size - at))
        # Up to the first line end, and from one to the next, the function of what lies between decides.
        before = 0
        for spot in np.flatnonzero(np.frombuffer(data, np.uint8) == ord("\n")).tolist():
            state = FUNCTIONS[effect(data[before:spot])][state]
            if state != QUOTED:
                return at + spot + 1
            before = spot
        state = FUNCTIONS[effect(data[before:])][state]
        at += len(data)
    return size


def _records(body: bytes) -> Iterator[list[str]]:
    csv.field_size_limit(2**31 - 1)
    for record in csv.reader(io.StringIO(body.decode("utf-8", "replace"), newline="")):
        if record:
            yield record


def _header(path: str) -> list[str]:
    store, place = located(path)
    with store.open_input_file(place) as file:
        end = _line_end(file, 0, START, file.size())
        file.seek(0)
        return next(_records(file.read(end).removeprefix(b"\xef\xbb\xbf")), [])


_EFFECT = pa.schema([("path", pa.string()), ("length", pa.int64()), ("part", pa.int64()), ("effect", pa.int32())])


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (path, length, part, size): path, length, part, and the function of its bytes."""
    for batch in batches:
        for row in batch.to_pylist():
            store, place = located(row["path"])
            with store.open_input_file(place) as file:
                file.seek(row["part"] * row["size"])
                found = effect(file.read(min(row["size"], row["length"] - row["part"] * row["size"])))
            yield pa.RecordBatch.from_pylist([{"path": row["path"], "length": row["length"], "part": row["part"], "effect": found}], schema=_EFFECT)


def _beginnings(rows: pd.DataFrame) -> pd.DataFrame:
    """The state in which each range of a file begins and ends; a row per range."""
    rows = rows.sort_values("part")
    states = [START]
    for f in rows["effect"]:
        states.append(FUNCTIONS[f][states[-1]])
    return rows.assign(first=states[:-1], last=states[1:])[["path", "length", "part", "first", "last"]]


def read_csv_in_parts(spark: SparkSession, directory: str, schema: T.StructType, part: int = PART) -> DataFrame:
    """What ``read_csv`` reads, with ranges of ``part`` bytes as the unit of work in place of files.

    Quotes are doubled inside quotes; line ends are ``\\n`` or ``\\r\\n``. A quote inside a plain field stands for
    itself; text after a closing quote, which no writer makes, is joined to the field. The order of rows is
    not kept. All files must have the header of the first.
    """
    files = scan_files(spark, directory, "*.csv").where("length > 0")
    first = files.agg(F.min("path")).first()[0]
    names = _header(first) if first else []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {part}"))).alias("part"),
                          F.lit(part).cast("long").alias("size"))
    effects = ranges.repartition(parts).mapInArrow(_effects, "path string, length long, part long, effect int")
    known = effects.groupBy("path").applyInPandas(_beginnings, "path string, length long, part long, first int, last int")
    fields = pa.schema([(f"c{i}", pa.string()) for i in range(len(names))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size, begin = row["length"], row["part"] * part
                end = min(begin + part, size)
                store, place = located(row["path"])
                with store.open_input_file(place) as file:
                    start = _line_end(file, begin, row["first"], size)
                    if not begin and _header(row["path"]) != names:
                        raise ValueError(f"{row['path']} has another header than {first}")
                    if start >= end and start >= size:
                        continue
                    # A record that follows a line end of the next range is that range's.
                    stop = _line_end(file, end, row["last"], size) if end < size else size
                    if start > end or start >= stop:
                        continue
                    file.seek(start)
                    records = _records(file.read(stop - start))
                held: list[list[str]] = []
                for record in records:
                    held.append(record)
                    if len(held) >= ROWS:
                        yield columns(held)
                        held = []
                if held:
                    yield columns(held)

    def columns(records: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] if i < len(r) else None for r in records], pa.string()) for i in range(len(names))], schema=fields)

    rows = known.repartition(parts).mapInArrow(read, T.StructType([T.StructField(f.name, T.StringType()) for f in fields]))
    place = {n: f"c{i}" for i, n in reversed([*enumerate(names)])}
    return rows.select(*[
        (null_spellings(F.col(place[f.name])) if f.name in place else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema.fields])
