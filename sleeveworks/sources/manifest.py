"""File manifests: which albums exist and which files they have."""

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sleeveworks.functions.scalars import base_name
from sleeveworks.sources.datasources import register
from sleeveworks.sources.places import matching


def scan_files(spark: SparkSession, base_dir: str, name_glob: str = "*") -> DataFrame:
    """``path, length, modified`` of all files below a folder, also of those without a byte. File contents are not read.

    Folders are listed by the tasks. ``base_dir`` may be a pattern. Where the storage has an inventory table of its
    own, it can be passed to ``manifest`` instead.
    """
    register(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism
    return spark.read.format("folder_listing").options(
        roots=json.dumps(matching(spark, base_dir)), glob=name_glob, partitions=tasks).load()


def manifest(files: DataFrame, base_dir: str, prefix: str = "LP") -> DataFrame:
    """Files inside album folders, with ``lp_id`` (the folder), ``file_name`` and ``depth``.

    Album folders are direct sub-folders of ``base_dir`` whose name starts with ``prefix``;
    ``depth`` 1 is a file directly in one.
    """
    # Listings may name the file system and its host where ``base_dir`` does not, or the other way round.
    place = r"(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"
    root = re.sub(f"^{place}", "", base_dir).strip("/")
    pattern = rf"^{place}/*\Q{root}\E/+(\Q{prefix}\E[^/]*)/+(.+)$"
    inside = F.regexp_extract("path", pattern, 2)
    return (
        files.withColumn("lp_id", F.regexp_extract("path", pattern, 1))
        .where("lp_id <> ''")
        .withColumn("file_name", base_name(F.col("path")))
        .withColumn("depth", F.size(F.split(inside, "/")))
    )


def audio_files(files: DataFrame, recursive: bool = False) -> DataFrame:
    """MP3 files of a manifest; by default only those directly in the album folder."""
    audio = files.where(F.col("file_name").endswith(".mp3"))
    return audio if recursive else audio.where("depth = 1")
