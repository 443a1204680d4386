"""Shards that all carry the same mixture of sources: proportional stratified interleaving.

Rows of a source are shuffled by a seeded hash and ranked; row r of n gets the fractional rank
(r - 1/2) / n. All sources are merged by fractional rank, and the merged order is cut into shards
whose row counts differ by one at most (the ``rows`` law).

No source and no shard is ever ordered in one task. Rows fall into hash buckets of a source, whose
sizes give the ranks' offsets, then into buckets of fractional rank; how many rows of a source lie
below such a bucket follows from the source's size alone, so the second step needs no counting pass.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows that one task orders at a time, about.
BUCKET_ROWS = 50_000


def _buckets(docs: DataFrame, rows: int) -> int:
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(rows // BUCKET_ROWS, 4 * parts)


def _below(n: Column, bucket: Column, buckets: int) -> Column:
    """Of n rows with ranks (r - 1/2) / n, those below bucket / buckets."""
    return F.expr("CAST(((2 * _n * _b + {0} - 1) DIV {0}) DIV 2 AS BIGINT)".format(buckets))


def interleave(docs: DataFrame, shards: int = 40, seed: int = 17, id: str = "doc_id", text: str = "text",
               stratum: str = "source") -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs``.

    ``size``: UTF-8 bytes of the text, plus 16. ``slot`` counts from 0 in each shard. A null text is
    empty, a null stratum is a stratum of its own, a null id is an id like any other. Repeated rows
    keep a slot each. ``grown_shard`` is null: another shard count deals all rows anew. Other
    columns are ignored. An empty table gives no rows.
    """
    rows = docs.count()
    buckets = _buckets(docs, rows)
    body = F.coalesce(F.col(text), F.lit(""))
    row = docs.select(
        F.col(id).alias("_id"),
        F.struct(F.col(stratum).alias("s")).alias("_stratum"),
        (F.octet_length(body).cast("long") + 16).alias("_size"),
        F.crc32(body.cast("binary")).alias("_crc"),
    )
    row = row.withColumn("_hash", F.xxhash64(F.lit(seed), "_id", "_crc", "_size"))
    bucket = F.least(F.floor((F.col("_hash") / F.lit(2.0**64) + 0.5) * buckets), F.lit(buckets - 1))
    row = row.withColumn("_bucket", bucket)

    sizes = row.groupBy("_stratum", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy("_stratum").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_stratum", "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(W.partitionBy("_stratum")).alias("_n"),
    )
    within = W.partitionBy("_stratum", "_bucket").orderBy("_hash", "_id", "_crc", "_size")
    ranked = row.join(offsets, ["_stratum", "_bucket"]).withColumn("_r", F.col("_before") + F.row_number().over(within))
    # The fractional rank and its bucket; the bucket in whole numbers, so that it agrees with _below.
    ranked = ranked.select(
        "_id", "_size", "_crc", "_stratum", "_hash",
        ((2 * F.col("_r") - 1) / (2 * F.col("_n"))).alias("_fraction"),
        F.expr(f"((2 * _r - 1) * {buckets}) DIV (2 * _n)").alias("_b"),
    )
    strata = sizes.groupBy("_stratum").agg(F.sum("_rows").alias("_n"))
    starts = (
        strata.select("_n", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_b"))
        .groupBy(F.col("_b").cast("long").alias("_b"))
        .agg(F.sum(_below(F.col("_n"), F.col("_b"), buckets)).alias("_start"))
    )
    order = W.partitionBy("_b").orderBy("_fraction", "_stratum", "_hash", "_id", "_crc", "_size")
    position = F.col("_start") + F.row_number().over(order) - 1
    placed = ranked.join(starts, "_b").withColumn("_position", position)
    shard = F.expr(f"(_position * {shards}) DIV {max(rows, 1)}")
    first = F.expr(f"(_shard * {rows} + {shards} - 1) DIV {shards}")
    return placed.withColumn("_shard", shard).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
        (F.col("_position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("_stratum.s").alias("source"),
    )
