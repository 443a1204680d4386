"""Running an injected function (recognition, language model, audio header) over rows.

The caller supplies the function; the library supplies partitioning, clients, error isolation, a window of calls
in flight, a quota that all callers share, and a ledger that keeps every answer as soon as it is there.
"""

import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sleeveworks.operators.calls import Ledger, Slots, Window
from sleeveworks.sources.places import located, qualified


def on_contents(make_function: Callable[[], Callable[[bytes], Any]]) -> Callable[[], Callable[[str], Any]]:
    """For ``enrich`` over a column of paths: the function gets the bytes of the file instead.

    A file is read by the worker that calls the function, through the file system its path names, so
    contents are never shuffled.
    """
    def make() -> Callable[[str], Any]:
        function = make_function()

        def call(path: str) -> Any:
            store, place = located(path)
            with store.open_input_stream(place) as source:
                return function(source.readall())

        return call

    return make


def _pace(workers: int, calls_per_minute: float) -> Callable[[], Any]:
    """For a barrier task: waits for the task's next turn. All tasks begin to count at one time."""
    context = BarrierTaskContext.get()
    begin = max(float(t) for t in context.allGather(repr(time.time())))
    return Slots(calls_per_minute, context.partitionId(), workers, begin).wait


def enrich(df: DataFrame, make_function: Callable[[], Callable[[Any], Any]], calls: dict[str, str],
           result_type: T.DataType = T.StringType(), workers: int | None = None,
           calls_per_minute: float | None = None, in_flight: int = 1, timeout: float | None = None,
           ledger: str | None = None) -> DataFrame:
    """Add, for each ``calls`` entry {new column: input column}, the result and ``<new>_error``.

    ``make_function`` runs in the task and returns the function to call with one value; with ``in_flight`` calls
    at a time it runs for each of them. A null input is not called. A call that raises, or takes longer
    than ``timeout`` seconds, gives a null result and the error text; the task goes on. Rows stay in order.

    ``workers`` is the number of partitions, hence callers. With ``calls_per_minute`` they run as one barrier stage
    and take turns, so that no minute has more calls, those in flight and those of repeated tasks included;
    that needs a core for each, and fails at once where the cluster has fewer.

    ``ledger`` names a folder that all executors reach: answers are kept there one by one, and what has an answer is not
    asked again, by this run or a later one, until the folder is removed. Results must be JSON values then.
    """
    spark = df.sparkSession
    if calls_per_minute is not None:
        if workers is None:
            raise ValueError("calls_per_minute needs workers")
        if workers > spark.sparkContext.defaultParallelism:
            raise ValueError(f"{workers} callers need as many cores; there are {spark.sparkContext.defaultParallelism}")
    folder = qualified(spark, ledger) if ledger else None
    value_type = to_arrow_type(result_type)
    schema = T.StructType(list(df.schema.fields))
    for name in calls:
        schema = schema.add(name, result_type).add(f"{name}_error", T.StringType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = _pace(workers, calls_per_minute) if calls_per_minute else None
        window = Window(make_function, in_flight, timeout, before, Ledger(folder) if folder else None,
                        lambda x: pa.scalar(x, value_type).as_py())
        for batch in batches:
            columns = list(batch.columns)
            for source in calls.values():
                answers = list(window.answers(batch.column(source).to_pylist()))
                columns += [pa.array([r for r, _ in answers], value_type), pa.array([e for _, e in answers], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    spread = df if workers is None else df.repartition(workers)
    return spread.mapInArrow(run, schema, barrier=calls_per_minute is not None)
