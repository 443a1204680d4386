"""Key lookups that stay balanced when single keys hold a large share of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than a partition's share of the rows divided by this. So there are
# at most HOT_PER_PARTITION * partitions hot keys, whatever the data.
HOT_PER_PARTITION = 4
# Counters of a frequency sketch per hot key that can exist; its error is then a fraction of the share.
COUNTERS_PER_KEY = 8
# Spark's own limit on the counters of a sketch. With more partitions than it allows for, a key's count is known
# less exactly, by a share of the rows that is still below a partition's.
MOST_COUNTERS = 1_000_000
# Sketches of the tasks are merged in this many groups first, so that no task merges all of them.
SKETCH_GROUPS = 256


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, on: list[str], partitions: int | None = None) -> DataFrame:
    """``_hot, _salts``: hashes of the keys that would make a partition uneven, and over how many
    sub-keys each is to be spread; the salts of all keys add up to twice the bound on keys at most.

    All rows are counted, by one sketch per task over the key columns. It only decides how rows are
    spread, never which rows a result has.
    """
    partitions = partitions or _partitions(rows)
    bound = min(HOT_PER_PARTITION * partitions, MOST_COUNTERS)
    counters = min(COUNTERS_PER_KEY * bound, MOST_COUNTERS)
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    keys = rows.select(group, F.xxhash64(*on).alias("_key"))
    sketches = keys.groupBy("_group").agg(
        F.expr(f"approx_top_k_accumulate(_key, {counters})").alias("_sketch"), F.count(F.lit(1)).alias("_n"))
    # Grouped by a constant: without a group, an empty partition would have to give an empty sketch,
    # which this aggregate cannot write.
    merged = sketches.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_combine(_sketch, {counters})").alias("_sketch"), F.sum("_n").alias("_n"))
    found = merged.select("_n", F.explode(F.expr(f"approx_top_k_estimate(_sketch, {bound})")).alias("_top"))
    shares = F.ceil(F.col("_top.count") * F.lit(bound) / F.col("_n"))
    return found.select(F.col("_top.item").alias("_hot"), shares.cast("int").alias("_salts")).where("_salts > 1")


def _row_digest(df: DataFrame) -> Column:
    """A number that is the same when a task is repeated, and differs between input splits."""
    plain = [f.name for f in df.schema.fields
             if not isinstance(f.dataType, (T.MapType, T.VariantType, T.ArrayType, T.StructType))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain], F.spark_partition_id())


def lookup(rows: DataFrame, facts: DataFrame, on: list[str], how: str = "left", hot: DataFrame | None = None,
           unique: bool = False) -> DataFrame:
    """Join many rows to ``facts``, which must hold at most one row per key.

    Rows of hot keys are spread over sub-keys, as many as their share asks for, and rows whose key has a
    null, so that it matches nothing, over all partitions. Only the facts of hot keys are repeated,
    once per sub-key. ``unique`` says that ``rows``, too, has at most one row per key: then no key
    can be hot and a plain join does. Small ``facts`` are broadcast by Spark's own size check.
    """
    if unique:
        return rows.join(facts, on, how)
    salts = _partitions(rows)
    hot = F.broadcast(hot_keys(rows, on) if hot is None else hot)
    key = F.xxhash64(*on)
    empty = F.lit(False)
    for c in on:
        empty = empty | F.col(c).isNull()
    spread = F.when(empty, F.lit(salts)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = (
        rows.join(hot, key == F.col("_hot"), "left")
        .withColumn("_salt", F.pmod(_row_digest(rows), spread).cast("int"))
        .drop("_hot", "_salts")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = facts.join(hot, key == F.col("_hot"), "left").withColumn("_salt", F.explode(copies)).drop("_hot", "_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
