import pytest
from pyspark.sql import functions as F

from sleeveworks.functions import scalars as S
from sleeveworks.operators import covers, match
from sleeveworks.operators.skew import HOT_PER_PARTITION, hot_keys, lookup


def tracks(spark, *rows_):
    df = spark.createDataFrame(list(rows_), "LP_ID string, Face string, raw string")
    return df.withColumn("track_no", S.track_number(F.col("raw")))


def audio(spark, *rows_):
    return spark.createDataFrame(list(rows_), "lp_id string, file_name string, seconds double")


def test_exact_match(spark, rows):
    t = tracks(spark, ("LP1", "A", "1"), ("LP1", "B", "1"), ("LP1", "A", "x"), ("LP2", "A", "1"))
    a = audio(spark, ("LP1", "LP1_1z1_A01.mp3", 185.9))
    name, length = "`Track Filename`", "`Track Length`"
    assert rows(match.match_exact(t, a), "LP_ID", "Face", "raw", name, length) == [
        ("LP1", "A", "1", "LP1_1z1_A01.mp3", "3'05"), ("LP1", "A", "x", None, "missing"),
        ("LP1", "B", "1", "LP1_1z1_B01.mp3", "missing"), ("LP2", "A", "1", "LP2_1z1_A01.mp3", "missing")]
    assert rows(match.match_exact(t, a, parity=True).where("raw = 'x'"), name, length) == [("LP1_1z1_ANone.mp3", "missing")]


def test_unreadable_file_is_missing(spark, rows):
    t, a = tracks(spark, ("LP1", "A", "1")), audio(spark, ("LP1", "LP1_1z1_A01.mp3", None))
    assert rows(match.match_exact(t, a), "`Track Length`") == [("missing",)]


def test_fallback_match(spark, rows):
    t = tracks(spark, ("LP1", "A", "1"), ("LP1", "A", "5"), ("LP2", "A", "1"), ("LP3", "A", "1"))
    a = audio(spark, ("LP1", "LP1_A1.mp3", 60.0), ("LP1", "LP1_B2.mp3", 61.0), ("LP2", "x.mp3", 62.0))
    assert rows(match.match_with_fallback(t, a), "LP_ID", "raw", "File_Name", "Track_Length") == [
        ("LP1", "1", "LP1_A1.mp3", "1'00"), ("LP1", "5", "LP1_A1.mp3", "1'00"),
        ("LP2", "1", "x.mp3", "1'02"), ("LP3", "1", "missing", "missing")]


def test_slot_grid(spark, rows):
    a = audio(spark, ("LP1", "LP1_1z1_A01.mp3", 60.0), ("LP1", "LP1_1z1_A03.mp3", 61.0), ("LP1", "LP1_1z1_B01.mp3", 62.0),
              ("LP1", "LP1_1z1_A07.mp3", 63.0), ("LP1", "LP1_1z1_C01.mp3", 64.0))
    albums = spark.createDataFrame([("LP1",), ("LP2",)], "lp_id string")
    grid = match.slot_grid(a, albums)
    assert grid.count() == 24
    assert rows(grid.where("file_name is not null")) == [
        ("LP1", "A", 1, "LP1_1z1_A01.mp3", "1'00"), ("LP1", "A", 3, "LP1_1z1_A03.mp3", "1'01"),
        ("LP1", "B", 1, "LP1_1z1_B01.mp3", "1'02")]
    nested = match.nested_slots(a.withColumn("lp_id", F.lit("LP1_1z1"))).first()
    assert nested["cote"] == "LP1-1/1" and len(nested["slots"]) == 12


def test_support_count(spark, rows):
    albums = spark.createDataFrame([("LP1",), ("LP2",), ("LP3",)], "LP_ID string")
    t = tracks(spark, *[("LP1", "A", "1")] * 3, ("LP2", "A", "1"))
    assert rows(match.with_support_count(albums, t)) == [("LP1", 3), ("LP2", 1), ("LP3", 1)]


def test_not_done(spark, rows):
    inputs = spark.createDataFrame([("LP1",), ("LP2",), ("LP3",), (None,)], "lp_id string")
    done = spark.createDataFrame([("LP2",), ("LP2",)], "lp_id string")
    assert rows(match.not_done(inputs, done, ["lp_id"])) == [("LP1",), ("LP3",), (None,)]


def test_cover_pairs(spark, rows):
    paths = [("LP1", "/l/LP1/b_cover01.jpg", 1), ("LP1", "/l/LP1/a_cover01.jpg", 1), ("LP1", "/l/LP1/a_cover02.jpg", 1),
             ("LP2", "/l/LP2/a_cover01.jpg", 1), ("LP2", "/l/LP2/in/a_cover02.jpg", 2), ("LP2", "/l/LP2/a_cover02.JPG", 1)]
    pairs = covers.cover_pairs(spark.createDataFrame(paths, "lp_id string, path string, depth int"))
    assert rows(pairs) == [("LP1", "/l/LP1/a_cover01.jpg", "/l/LP1/a_cover02.jpg"), ("LP2", "/l/LP2/a_cover01.jpg", None)]
    assert rows(covers.complete_pairs(pairs), "lp_id") == [("LP1",)]
    assert covers.image_rows(pairs).count() == 4


# --- Skew -------------------------------------------------------------------------------------


def skewed(spark):
    """A third of the rows on one key, a third without key, the rest spread; many exact copies."""
    return spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE 'k' || (id % 500) END AS k", "id % 10 AS v")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("threshold", ["-1", "10m"], ids=["shuffled", "broadcast"])
def test_lookup_equals_a_plain_join(spark, rows, how, threshold):
    left = skewed(spark)
    facts = spark.createDataFrame([("hot", 1), ("k5", 2), ("k8", 3), ("other", 4), (None, 5)], "k string, fact int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = lookup(left, facts, ["k"], how, hot=hot_keys(left, ["k"], 16))
        assert rows(got) == rows(left.join(facts, "k", how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_spread(spark):
    """The fullest partition of the shuffled side holds far less than the hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(90000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id END AS k", "id AS v")
        facts = spark.range(90000).selectExpr("'k' || id AS k", "id AS fact")
        def fullest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert fullest(left.join(facts, "k", "left")) > 30000
        assert fullest(lookup(left, facts, ["k"], hot=hot_keys(left, ["k"]))) < 15000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_keys_are_found_and_bounded(spark):
    left = spark.range(60000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id END AS k").repartition(7)
    found = hot_keys(left, ["k"], 8).collect()
    assert [r["_hot"] for r in found] == [spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]]
    # A third of the rows over a third of all sub-keys.
    assert 10 <= found[0]["_salts"] <= 12
    even = spark.range(60000).selectExpr("'k' || id % 20 AS k")
    assert hot_keys(even, ["k"], 50).count() == 20 and hot_keys(even, ["k"], 2).count() <= HOT_PER_PARTITION * 2


def test_many_equally_heavy_keys(spark):
    """400 keys, each far above a partition's share: the fullest task stays near the mean."""
    for key, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "1000",
                       "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 400_000, 1, 8).selectExpr("'k' || id % 400 AS k", "id AS v")
        facts = spark.range(400).selectExpr("'k' || id AS k", "id AS fact")
        sizes = [r[0] for r in lookup(left, facts, ["k"]).groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == 400_000 and max(sizes) < 5 * 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
