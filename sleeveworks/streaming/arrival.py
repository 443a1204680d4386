"""Incremental arrival: process what is new, then stop. The transforms are those of the batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sleeveworks.functions.scalars import lp_id_of_file
from sleeveworks.operators import extract


def arriving_files(spark: SparkSession, directory: str, name_glob: str, column: str,
                   files_per_batch: int = 100_000) -> DataFrame:
    """Stream of whole text files: ``lp_id, file_name`` and the text."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
    )
    name = F.col("_metadata.file_name")
    return files.select(lp_id_of_file(name).alias("lp_id"), name.alias("file_name"), F.col("value").alias(column))


def arriving_table(spark: SparkSession, directory: str, schema: T.StructType,
                   files_per_batch: int = 100_000) -> DataFrame:
    """Stream of the Parquet files that are added to a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(directory)


def process_new(arriving: DataFrame, transform: Callable[[DataFrame], DataFrame], output: str,
                checkpoint: str) -> None:
    """Run ``transform`` over everything not seen under ``checkpoint`` yet; append to ``output``.

    The file source remembers what it has read and the file sink commits each batch once, so a
    repeated or interrupted run neither loses nor doubles rows.
    """
    (
        transform(arriving).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(output)
        .awaitTermination()
    )


def process_split(arriving: DataFrame, rows: Callable[[DataFrame], DataFrame], output: str, quarantine: str,
                  checkpoint: str, how: str = "greedy", per_task: int | None = None, keep_text: bool = True) -> None:
    """Documents of everything not seen under ``checkpoint`` yet: ``rows`` of the usable ones to ``output``, the unusable
    ones with their reason to ``quarantine``.

    Every batch is decoded once and written to a folder named by its number in either table, which replaces
    what an earlier try of that batch left. So a batch that is repeated neither loses nor doubles rows.

    ``per_task``: documents are dealt out anew before they are decoded, so many to a task at most and over all cores;
    files are split by bytes, which says little of the work in them. ``keep_text=False``: where ``rows`` needs no
    text of usable documents, only the others' is held meanwhile.
    """
    def write(batch: DataFrame, number: int) -> None:
        if per_task is not None:
            cores = batch.sparkSession.sparkContext.defaultParallelism
            batch = batch.repartition(max(cores, -(-batch.count() // per_task)))
        parsed = extract.parse_documents(batch, how=how)
        if not keep_text:
            parsed = parsed.withColumn("response", F.when(~extract.usable(), F.col("response")))
        parsed = parsed.persist()
        try:
            rows(parsed).write.mode("overwrite").parquet(f"{output}/batch={number}")
            extract.quarantine(parsed).write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        finally:
            parsed.unpersist()

    (
        arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )
