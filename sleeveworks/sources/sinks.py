"""Writing tables, CSV and one-file-per-album exports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeveworks.sources.datasources import register
from sleeveworks.sources.places import qualified

# Rows per CSV file. A CSV file with line breaks in values is read by one task.
CSV_ROWS_PER_FILE = 1_000_000


def write_csv(df: DataFrame, directory: str, rows_per_file: int = CSV_ROWS_PER_FILE) -> None:
    """A folder of CSV files with header; values keep their outer blanks."""
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .csv(directory, header=True, quote='"', escape='"',
             ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )


def append_table(df: DataFrame, directory: str) -> None:
    """Add rows to a Parquet table. Use for results of paid calls, as soon as they exist."""
    df.write.mode("append").parquet(directory)


def write_table(df: DataFrame, directory: str) -> None:
    df.write.mode("overwrite").parquet(directory)


def export_files(df: DataFrame, directory: str, name: str, body: str) -> None:
    """One file per row, named by column ``name``, sub-folders included, holding the text in ``body``.

    For hand-over to tools that expect one file per album. ``directory`` must be reachable by
    all executors. Either all files are put in place, or, if the write fails, none.
    """
    spark = register(df.sparkSession)
    df.select(F.col(name).cast("string").alias("name"), F.col(body).cast("string").alias("body")).write.format("file_per_row").option(
        "path", qualified(spark, directory)).mode("append").save()
