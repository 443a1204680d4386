"""Loose blocks, track numbers, breaches, undeclared members, and limits of the session."""

import os
import random
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sleeveworks import session
from sleeveworks.operators import checks, covers, extract, select, skew

BLOCKS = "image_path string, x int, y int, seq int, text string"


def test_texts_of_loose_blocks(spark, rows):
    draw = random.Random(1)
    blocks = [("i1", 0, 30, 0, "c"), ("i1", 0, 10, 1, "a"), ("i1", 5, 10, 2, "b"), ("i2", 0, 0, 0, None), (None, 0, 0, 0, "lost"), ("i3", 0, 1, 0, "")]
    hot = [("hot", 0, y, s, f"{y}.{s}é") for y in range(400) for s in range(2)]
    blocks += hot
    draw.shuffle(blocks)
    df = spark.createDataFrame(blocks, BLOCKS).repartition(7)
    want = [("hot", "\n".join(t for *_, t in hot)), ("i1", "a\nb\nc"), ("i3", "")]
    assert rows(covers.texts_of_blocks(df)) == want
    # The hot image lies in several tasks; with very short chunks in many pieces.
    assert covers.texts_of_blocks(df.limit(0)).collect() == []


def test_chunks_of_one_image(spark, rows, monkeypatch):
    monkeypatch.setattr(covers, "CHUNK", 10)
    df = spark.createDataFrame([("i", 0, n, 0, f"line {n}") for n in range(50)], BLOCKS)
    assert rows(covers.texts_of_blocks(df), "text") == [("\n".join(f"line {n}" for n in range(50)),)]


def _gather(*batches):
    schema = pa.schema({"image": pa.string(), "text": pa.string()})
    made = covers._gathered("path")(pa.RecordBatch.from_pylist([{"image": i, "text": t} for i, t in b], schema) for b in batches)
    return [[(r["path"], r["text"]) for r in b.to_pylist()] for b in made if b.validate(full=True) is None]


def test_chunks_are_gathered(monkeypatch):
    monkeypatch.setattr(covers, "SENT", 8)
    assert _gather([("a", ""), ("b", "é")], [("b", ""), ("c", "x")]) == [[("a", ""), ("b", "é\n"), ("c", "x")]]
    assert _gather([("a", "1234"), ("b", "567890"), ("c", "x")]) == [[("a", "1234"), ("b", "567890")], [("c", "x")]]
    # A long text goes alone, also if it grows over batches.
    assert _gather([("a", "1234"), ("b", "56789012"), ("c", "x")]) == [[("a", "1234")], [("b", "56789012")], [("c", "x")]]
    assert _gather([("a", "1"), ("b", "2345")], [("b", "6789")], [("b", ""), ("c", "x")]) == [[("a", "1")], [("b", "2345\n6789\n")], [("c", "x")]]
    assert _gather([], []) == []
    monkeypatch.setattr(covers, "LONGEST", 9)
    assert _gather([("a", "1234"), ("a", "5678"), ("b", "")]) == [[("a", "1234\n5678")], [("b", "")]]
    with pytest.raises(ValueError, match="'a' has more than 9 bytes"):
        _gather([("a", "1234"), ("a", "56789")])


#: An image of 102 MB among small ones, in a heap that has no room for several copies of it.
LONG_IMAGE = """
from sleeveworks.operators import covers
from sleeveworks.session import local_session
spark = local_session("2", 8, "800m")
blocks = spark.range(104_000).selectExpr("if(id < 4000, 'image ' || id, 'hot') AS image_path", "id AS y", "0 AS seq", "repeat(md5(string(id)), 32) AS text")
print(*covers.texts_of_blocks(blocks).selectExpr("count(*)", "sum(length(text))").first())
"""


def test_long_text_in_a_small_heap(tmp_path):
    run = subprocess.run([sys.executable, "-c", LONG_IMAGE], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(Path(__file__).parent.parent)},
                         capture_output=True, text=True, timeout=300)
    assert run.stdout.split() == ["4001", str(104_000 * 1024 + 99_999)], run.stderr[-2000:]


TRACKS = "LP_ID string, Face string, track_no string"


def test_runs_and_gaps(spark, rows):
    numbers = {("LP1", "A"): ["01", "02", "02", "05", None, "x"], ("LP1", "B"): ["03"], ("LP2", None): ["01", "00"], ("LP3", "A"): [None]}
    df = spark.createDataFrame([(*side, n) for side, ns in numbers.items() for n in ns], TRACKS)
    assert rows(checks.track_runs(df)) == sorted([("LP1", "A", 1, 2), ("LP1", "A", 5, 5), ("LP1", "B", 3, 3), ("LP2", None, 1, 1)], key=str)
    assert rows(checks.track_gaps(df)) == [("LP1", "A", 3, 4), ("LP1", "B", 1, 2)]
    assert checks.track_gaps(df.limit(0)).collect() == []


def test_violations(spark, rows):
    albums = spark.createDataFrame([("LP1234", "AB 12"), ("LP1", None)], "LP_ID string, `Label Number` string")
    tracks = spark.createDataFrame([("LP1", 0, "A", "1"), ("LP1", 1, "C", "1."), ("LP1", 2, None, "9")],
                                   "LP_ID string, seq int, Face string, `Track Number` string")
    assert rows(checks.violations(albums, tracks)) == sorted([
        ("LP1", None, "lp_id_format", "LP1"), ("LP1", None, "label_number_format", None), ("LP1", 1, "face_known", "C"),
        ("LP1", 1, "track_number_whole", "1."), ("LP1", 1, "slot_in_grid", "1."), ("LP1", 2, "face_known", None),
        ("LP1", 2, "slot_in_grid", "9")], key=str)


def test_members_become_columns(spark, rows):
    docs = ['{"General Information": {"Title": "a", "n": 1, "f": 1, "t": true, "mix": 3, "o": {"k": 1}, "nil": null, "LP_ID": "x"}}',
            '{"General Information": {"n": 2, "f": 2.5, "t": false, "mix": "y", "o": [1], "odd \\"name\\" (g).`": "q"}}',
            '{"General Information": {}}', '{"Track Info": []}', "no"]
    df = spark.createDataFrame([(f"LP{i}", d) for i, d in enumerate(docs)], "lp_id string, response string")
    parsed = extract.parse_documents(df, how="whole")
    schema = extract.member_schema(parsed)
    assert dict(rows(schema)) == {"Title": "string", "n": "bigint", "f": "double", "t": "boolean", "mix": "string", "o": "string",
                                  "nil": "string", "LP_ID": "string", 'odd "name" (g).`': "string"}
    got = [r.asDict() for r in extract.wide_rows(parsed, schema).orderBy("LP_ID").collect()]
    assert got == [
        {"LP_ID": "LP0", "Title": "a", "f": 1.0, "mix": "3", "n": 1, "nil": None, "o": '{"k":1}', 'odd "name" (g).`': None, "t": True},
        {"LP_ID": "LP1", "Title": None, "f": 2.5, "mix": "y", "n": 2, "nil": None, "o": "[1]", 'odd "name" (g).`': "q", "t": False}]
    assert extract.member_schema(parsed.limit(0)).collect() == []


@pytest.mark.parametrize("what", ["first-7", "last-7", "5-9", "90-200", "9-5", "0", "last-99"])
def test_selection_by_either_way(spark, rows, monkeypatch, what):
    albums = spark.createDataFrame([(f"LP{i * 37 % 101}",) for i in range(95)] + [("LPx",), ("LP7b",)], "lp_id string")
    short = [r[0] for r in select.select_positions(albums, what).collect()]
    monkeypatch.setattr(select, "TOP", 0)
    assert short == [r[0] for r in select.select_positions(albums, what).collect()]


def test_hot_keys_of_very_many_partitions(spark, rows):
    """The sketch stays below what Spark takes, and still finds a key that holds most rows."""
    df = spark.range(3000).selectExpr("CASE WHEN id < 2000 THEN 'hot' ELSE concat('k', id) END AS k")
    found = skew.hot_keys(df, ["k"], partitions=200_000).orderBy(F.desc("_salts")).first()
    assert found["_hot"] == df.where("k = 'hot'").select(F.xxhash64("k")).first()[0] and found["_salts"] > 1000


def test_a_disk_of_the_driver_is_no_shared_folder():
    class Conf(dict):
        pass

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, **conf):
            self.conf, self.sparkContext = Conf(conf), Context(master)

    local = {"spark.sql.warehouse.dir": "file:/home/x/warehouse"}
    assert session.shared_dir(Session("local[4]", **local)) == "file:/home/x/warehouse/_shared"
    assert session.shared_dir(Session("yarn", **{"spark.sql.warehouse.dir": "hdfs://h/w/"})) == "hdfs://h/w/_shared"
    assert session.shared_dir(Session("yarn", **local, **{"spark.checkpoint.dir": "hdfs://h/c/"})) == "hdfs://h/c"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_dir(Session(master, **local))
