"""Tables laid out by key: bucketed and sorted, so that what is looked up again and again is not shuffled again."""

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sleeveworks.sources.places import located, qualified

#: Names the layout inside the table's folder; readers pass over it.
_NOTE = "_layout.json"


def _name(path: str) -> str:
    """The session's name for the table of a folder."""
    return f"laid_out_{hashlib.md5(path.encode()).hexdigest()}"


def write_laid_out(df: DataFrame, directory: str, keys: list[str], buckets: int, append: bool = False) -> None:
    """A Parquet table whose rows lie in ``buckets`` by ``keys``, sorted by them inside each file.

    Rows are dealt to the buckets before they are written, so each write adds one file a bucket. What is
    appended must have the layout the table has.
    """
    spark = df.sparkSession
    path = qualified(spark, directory)
    if append and _layout(path) is not None:
        known = _layout(path)
        if (known["keys"], known["buckets"]) != (keys, buckets):
            raise ValueError(f"the table is laid out by {known['keys']} in {known['buckets']} buckets")
        _declare(spark, path, known)
        df.select(*T.StructType.fromJson(known["schema"]).names).repartition(buckets, *keys).write.insertInto(_name(path))
        return
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", path).saveAsTable(_name(path))
    store, place = located(f"{path}/{_NOTE}")
    with store.open_output_stream(place) as out:
        out.write(json.dumps({"keys": keys, "buckets": buckets, "schema": df.schema.jsonValue()}).encode())


def _layout(path: str) -> dict | None:
    store, place = located(f"{path}/{_NOTE}")
    try:
        with store.open_input_stream(place) as source:
            return json.loads(source.readall())
    except FileNotFoundError:
        return None


def _declare(spark: SparkSession, path: str, layout: dict) -> None:
    def quoted(names: list[str]) -> str:
        return ", ".join("`" + n.replace("`", "``") + "`" for n in names)

    schema = T.StructType.fromJson(layout["schema"])
    columns = ", ".join(f"{quoted([f.name])} {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet CLUSTERED BY ({quoted(layout['keys'])}) "
              f"SORTED BY ({quoted(layout['keys'])}) INTO {layout['buckets']} BUCKETS LOCATION '{place}'")


def read_laid_out(spark: SparkSession, directory: str) -> DataFrame:
    """A table that was written laid out, by this session or another. A join or a grouping by its keys doesn't shuffle it."""
    path = qualified(spark, directory)
    layout = _layout(path)
    if layout is None:
        raise ValueError(f"{path} is not laid out")
    _declare(spark, path, layout)
    spark.sql(f"REFRESH TABLE {_name(path)}")
    return spark.table(_name(path))
