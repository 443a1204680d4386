import pytest
from pyspark.sql import functions as F

from sleeveworks.operators import covers, enrich, extract, select
from sleeveworks.schema import CLEAN_GENERAL, CLEAN_TRACK, RAW_TRACK, strings
from sleeveworks.sources import files, manifest, sinks


def touch(path, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_manifest(spark, rows, tmp_path):
    for name in ["LP2/LP2_cover01.jpg", "LP2/LP2_cover02.jpg", "LP2/LP2_1z1_A01.mp3", "LP2/more/LP2_1z1_A02.mp3",
                 "LP10/LP10_cover01.jpg", "XX1/LP3/LP3_cover01.jpg", "LP9.jpg"]:
        touch(tmp_path / name)
    found = manifest.manifest(manifest.scan_files(spark, str(tmp_path)), str(tmp_path))
    assert rows(found, "lp_id", "file_name", "depth") == [
        ("LP10", "LP10_cover01.jpg", 1), ("LP2", "LP2_1z1_A01.mp3", 1), ("LP2", "LP2_1z1_A02.mp3", 2),
        ("LP2", "LP2_cover01.jpg", 1), ("LP2", "LP2_cover02.jpg", 1)]
    assert [r[0] for r in select.natural_sort(select.album_names(found)).collect()] == ["LP2", "LP10"]
    assert rows(covers.complete_pairs(covers.cover_pairs(found)), "lp_id") == [("LP2",)]
    assert manifest.audio_files(found).count() == 1
    assert manifest.audio_files(found, recursive=True).count() == 2


def test_listings_name_the_file_system(spark, rows):
    paths = ["hdfs://nn:8020/archive/albums/LP1/a.mp3", "hdfs:/archive/albums/LP2/a.mp3", "/archive/albums/LP3/a.mp3", "s3a://bucket/archive/albums/LP4/a.mp3",
             "hdfs://nn:8020/other/LP5/a.mp3"]
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    for base in ("/archive/albums", "hdfs://nn:8020/archive/albums/"):
        assert rows(manifest.manifest(listed, base), "lp_id") == [("LP1",), ("LP2",), ("LP3",), ("LP4",)]


def test_csv_is_read_by_name(spark, rows, tmp_path):
    touch(tmp_path / "c" / "a.csv", "Title,LP_ID,Country,More\nMy Title,LP1,NaN,x\n")
    schema = strings(["LP_ID", "Country", "Title", "Notes"])
    assert rows(files.read_csv(spark, str(tmp_path / "c"), schema)) == [("LP1", None, "My Title", None)]


def test_empty_documents_are_reported(spark, rows, tmp_path):
    touch(tmp_path / "LP1_ai_output.json", "")
    touch(tmp_path / "LP2_ai_output.json", "{}")
    touch(tmp_path / "LP3 x_ai_output.json", "")
    docs = files.read_documents(spark, str(tmp_path))
    assert rows(extract.quarantine(docs), "file_name", "reason") == [
        ("LP1_ai_output.json", "no_json"), ("LP3 x_ai_output.json", "no_json")]


def test_scan_reads_no_contents(spark, tmp_path):
    touch(tmp_path / "LP1" / "a.jpg")
    assert manifest.scan_files(spark, str(tmp_path)).dtypes == [("path", "string"), ("length", "bigint"), ("modified", "timestamp")]


def test_texts_and_documents(spark, rows, tmp_path):
    touch(tmp_path / "t" / "LP1_combined.txt", "line 1\nline 2")
    touch(tmp_path / "t" / "other.txt")
    assert rows(files.read_texts(spark, str(tmp_path / "t"))) == [("LP1", "LP1_combined.txt", "line 1\nline 2")]
    touch(tmp_path / "j" / "LP1_ai_output.json", '{"Track Info": [{"Face": "A"}]}')
    touch(tmp_path / "j" / "deep" / "LP2_ai_output.json", '{"Track Info": [{"Face": "B"}]}')
    touch(tmp_path / "j" / "LP3_ai_output.json", '{"Track Info": [')
    touch(tmp_path / "j" / "LP4_ai_output.json", "[1]")
    docs = files.read_documents(spark, str(tmp_path / "j"))
    assert rows(extract.track_rows(docs), "LP_ID", "Face") == [("LP1", "A"), ("LP2", "B")]
    assert rows(extract.quarantine(docs), "lp_id", "reason") == [("LP3", "invalid_json"), ("LP4", "not_object")]


def test_export_one_file_per_album(spark, tmp_path):
    df = spark.createDataFrame([("LP1_combined.txt", "é\n1"), ("LP2_combined.txt", None)], "name string, body string")
    for _ in range(2):
        sinks.export_files(df, str(tmp_path / "out"), "name", "body")
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {"LP1_combined.txt": "é\n1", "LP2_combined.txt": ""}
    assert sorted(map(tuple, files.read_texts(spark, str(tmp_path / "out")).collect())) == [
        ("LP1", "LP1_combined.txt", "é\n1"), ("LP2", "LP2_combined.txt", "")]


def test_csv_round_trip(spark, rows, tmp_path):
    schema = strings(["LP_ID", "Genre, occasion", "Côte générale"])
    data = [("LP1", ' a "q", b ', "x\ny"), ("LP2", "NaN", ""), ("LP3", None, "missing"), ("LP4", "back\\slash", "0")]
    sinks.write_csv(spark.createDataFrame(data, schema), str(tmp_path / "csv"), rows_per_file=1)
    back = files.read_csv(spark, str(tmp_path / "csv"), schema)
    assert rows(back) == [("LP1", ' a "q", b ', "x\ny"), ("LP2", None, None), ("LP3", None, "missing"),
                          ("LP4", "back\\slash", "0")]


def test_table_schemas():
    assert len(CLEAN_GENERAL) == 43 and len(CLEAN_TRACK) == 8 and len(RAW_TRACK) == 8
    assert CLEAN_GENERAL["copyrights"].dataType.typeName() == "long"


# --- Injected functions -----------------------------------------------------------------------


def test_one_bad_row_does_not_stop_the_others(spark, rows):
    def make():
        def upper(text):
            if text == "bad":
                raise ValueError("no")
            return text.upper()
        return upper

    df = spark.createDataFrame([(2**60 + 1, "a"), (2, "bad"), (None, None)], "n bigint, t string")
    assert rows(enrich.enrich(df, make, {"out": "t"})) == [
        (2**60 + 1, "a", "A", None), (2, "bad", None, "ValueError: no"), (None, None, None, None)]


def test_an_answer_of_the_wrong_type_is_the_rows_error(spark, rows):
    from pyspark.sql import types as T

    def make():
        return lambda text: float(text) if text.isdigit() else text

    df = spark.createDataFrame([("1",), ("x",)], "t string")
    got = enrich.enrich(df, make, {"out": "t"}, T.DoubleType()).withColumn("failed", F.col("out_error").isNotNull())
    assert rows(got, "t", "out", "failed") == [("1", 1.0, False), ("x", None, True)]


def test_workers_limit_the_callers(spark):
    def make():
        client = object()
        return lambda _: str(id(client))

    df = spark.range(100).select(F.col("id").cast("string").alias("t"))
    out = enrich.enrich(df, make, {"out": "t"}, workers=2)
    assert out.rdd.getNumPartitions() == 2
    per_partition = out.select(F.spark_partition_id().alias("p"), "out").distinct().groupBy("p").count().collect()
    assert [r["count"] for r in per_partition] == [1, 1]


def test_calls_are_spaced(spark):
    def make():
        import time
        return lambda _: time.time()

    from pyspark.sql import types as T
    df = spark.range(4).select(F.col("id").cast("string").alias("t")).coalesce(1)
    out = enrich.enrich(df, make, {"at": "t"}, T.DoubleType(), workers=1, calls_per_minute=300)
    at = sorted(r["at"] for r in out.collect())
    assert all(b - a >= 0.15 for a, b in zip(at, at[1:]))


def test_listing_takes_any_folder(spark, rows, tmp_path):
    """Files at every depth, without a byte too; hidden ones are passed over, folders are shared out."""
    names = ["top.jpg", "LP1/a.jpg", "LP1/in/b.jpg", "LP2 #%20/c.jpg", "LP2 #%20/deep/er/d.jpg", "LP3/e.txt"]
    for n in names:
        touch(tmp_path / "base" / n, "" if "b.jpg" in n else n)
    for n in (".hidden", "_temporary/x.jpg", "LP1/.x.jpg", "LP1/_y.jpg"):
        touch(tmp_path / "base" / n, "x")
    (tmp_path / "base" / "empty").mkdir()
    base = str(tmp_path / "base")
    got = manifest.scan_files(spark, base, "*.jpg")
    assert rows(got, "path", "length") == sorted((f"file:{base}/{n}", 0 if "b.jpg" in n else len(n)) for n in names if n.endswith("jpg"))
    assert got.rdd.getNumPartitions() > 1 and got.where("modified IS NULL OR modified < '2020-01-01'").isEmpty()
    assert manifest.scan_files(spark, f"{base}/empty").collect() == []
    assert manifest.scan_files(spark, f"{base}/nowhere").collect() == []
    assert rows(manifest.scan_files(spark, f"{base}/LP1/a.jpg"), "length") == [(9,)]
    assert rows(manifest.scan_files(spark, f"{base}/LP[13]"), "length") == [(0,), (9,), (9,)]


def everything(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file()) if path.exists() else []


def test_a_failing_task_leaves_no_file(spark, tmp_path):
    """What lost tasks drafted goes, and what was there before stays."""
    out = tmp_path / "out put#"
    sinks.export_files(spark.createDataFrame([("a", "old"), ("s/b", "old")], "n string, t string"), str(out), "n", "t")
    assert everything(out) == ["a", "s/b"]
    bad = spark.range(0, 40, 1, 4).selectExpr("concat('f', id) AS n", "CASE WHEN id = 33 THEN raise_error('lost') ELSE 'new' END AS t")
    with pytest.raises(Exception, match="lost"):
        sinks.export_files(bad.unionByName(spark.createDataFrame([("a", "new")], "n string, t string")), str(out), "n", "t")
    assert everything(out) == ["a", "s/b"] and (out / "a").read_text() == "old"
    sinks.export_files(bad.where("n <> 'f33'"), str(out), "n", "t")
    assert len(everything(out)) == 41 and not list(out.glob(".drafts*"))
    for name in ("", "..", "x/../y", "/x"):
        with pytest.raises(Exception, match="not a file name"):
            sinks.export_files(spark.createDataFrame([(name, "t")], "n string, t string"), str(out), "n", "t")


def test_export_replaces_and_repeats(spark, tmp_path):
    out = tmp_path / "o"
    for text in ("one", "two"):
        sinks.export_files(spark.createDataFrame([("d/é x.txt", text), ("n", None)], "n string, t string").repartition(2), str(out), "n", "t")
    assert everything(out) == ["d/é x.txt", "n"] and (out / "d" / "é x.txt").read_text() == "two" and (out / "n").read_text() == ""
