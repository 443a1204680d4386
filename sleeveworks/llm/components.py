"""Connected components of links, by alternating large and small stars.

Every round ties each node to the least neighbour it knows, which roughly halves the distances. Only
partial minima and joins are used, so a node with very many links is never gathered in one place. Each
round is written to the shared folder, which cuts the lineage.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeveworks.session import new_shared_path


#: Shuffle files go when the query that made them ends; what it wrote is all that is needed of it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again; nothing else stays of the query."""
    spark = df.sparkSession
    path, before = new_shared_path(spark, name), spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v), u > v, replaced by links to the least neighbour."""
    back = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = links.unionByName(back) if large else links
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        made = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
    return made.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` of every node with a link to another; ``component`` is the least node of it.

    Links may come repeated, in either direction, or from a node to itself. Links to null are ignored.
    """
    state = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    state, last = stored(state, "links"), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark[0] == 0 or mark == last:
            break
        last = mark
        state = stored(_star(_star(state, True), False), "links")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
