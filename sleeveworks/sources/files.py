"""Reading recognised texts, extraction documents and CSV tables."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sleeveworks.functions.scalars import base_name, lp_id_of_file, null_spellings
from sleeveworks.operators.extract import parse_documents
from sleeveworks.sources.manifest import scan_files
from sleeveworks.sources.places import qualified


def path_below(spark: SparkSession, path: Column, directory: str) -> Column:
    """A file's path below the folder that was read. Where ``directory`` is the file, its name; where it is a
    pattern, the whole path without file system and host."""
    root = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "", qualified(spark, directory)).strip("/")
    bare = F.regexp_replace(path, "^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?/+", "")
    inside = F.substr(bare, F.lit(len(root) + 2 if root else 1))
    return F.when(bare == root, base_name(bare)).when(bare.startswith(f"{root}/" if root else ""), inside).otherwise(bare)


def read_whole_files(spark: SparkSession, directory: str, name_glob: str, column: str) -> DataFrame:
    """One row per file: ``lp_id, file_name`` and the whole text. ``file_name`` has the sub-folders: files of one
    name in two of them are two files."""
    # wholetext must be an argument: .text() overrides the option of the same name.
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name_glob).text(
        directory, wholetext=True)
    texts = files.select(path_below(spark, F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), directory).alias("file_name"),
                         F.col("value").alias(column))
    # The reader gives no row for a file without a byte; the listing has it.
    empty = scan_files(spark, directory, name_glob).where("length = 0").select(
        path_below(spark, F.col("path"), directory).alias("file_name"), F.lit("").alias(column))
    rows = texts.unionByName(empty)
    return rows.select(lp_id_of_file(base_name(F.col("file_name"))).alias("lp_id"), "file_name", column)


def read_texts(spark: SparkSession, directory: str) -> DataFrame:
    """Recognised texts, one ``<album>_combined.txt`` per album."""
    return read_whole_files(spark, directory, "*_combined.txt", "combined_text")


def read_documents(spark: SparkSession, directory: str) -> DataFrame:
    """Extraction documents, one JSON file each, parsed; bad ones carry their ``status``."""
    return parse_documents(read_whole_files(spark, directory, "*.json", "response"), how="whole")


def read_document_lines(spark: SparkSession, directory: str, name: str = "file_name") -> DataFrame:
    """Extraction documents kept many to a file: a table of file name and JSON text, parsed."""
    rows = spark.read.parquet(directory)
    return parse_documents(rows.withColumn("lp_id", lp_id_of_file(F.col(name))), how="whole")


def read_csv(spark: SparkSession, directory: str, schema: T.StructType) -> DataFrame:
    """The declared columns of a CSV table, found by name in its header; absent ones are null, and so are
    texts that spell "no value". Files of one folder must have one header."""
    rows = spark.read.csv(directory, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)

    def column(field: T.StructField) -> Column:
        text = null_spellings(F.col(f"`{field.name}`")) if field.name in rows.columns else F.lit(None)
        return text.try_cast(field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in schema.fields])
