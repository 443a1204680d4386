import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sleeveworks.operators import checks, extract


def parsed(spark, texts, how="greedy"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "lp_id int, response string")
    rows = extract.parse_documents(df, how=how).selectExpr("lp_id", "to_json(doc) AS doc", "status").orderBy("lp_id").collect()
    return [(None if r["doc"] is None else json.loads(r["doc"]), r["status"]) for r in rows]


GREEDY = [
    ('{"a":1}', {"a": 1}, "ok"),
    ('```json\n{"a":{"b":1}}\n```', {"a": {"b": 1}}, "ok"),
    ('Sure: {"a":1} done', {"a": 1}, "ok"),
    ('{"a":1} and {"b":2}', None, "invalid_json"),
    ('{"a":1},{"b":2}', None, "invalid_json"),
    ('{"a":1}], [{"b":2}', None, "invalid_json"),
    ('{"a":1},5], [{"b":2}', None, "invalid_json"),
    ('{"a":{}', None, "invalid_json"),
    ("{'a':1}", None, "invalid_json"),
    ('{"a":1,}', None, "invalid_json"),
    ('{"a":"x\ny"}', None, "invalid_json"),
    ('{"a":1,"a":2}', {"a": 2}, "ok"),
    ("}{", None, "no_json"),
    ("abc", None, "no_json"),
    ("", None, "no_json"),
    (None, None, "no_json"),
    ("{}", {}, "empty"),
]


def test_greedy_extraction_is_strict(spark):
    assert parsed(spark, [t for t, _, _ in GREEDY]) == [(d, s) for _, d, s in GREEDY]


def test_fenced_extraction(spark):
    texts = ['{"a":1}', '```json\n{"a":{"b":1}}\n```', 'x ```json{"a":1}``` y ```json{"b":2}```', "```json\n[1]\n```"]
    assert [d for d, _ in parsed(spark, texts, "fenced")] == [None, {"a": {"b": 1}}, {"a": 1}, None]


def test_whole_files_must_be_objects(spark):
    assert [s for _, s in parsed(spark, ["[1]", "5", ' {"a":1}\n', "null", '"x"'], "whole")] == [
        "not_object", "not_object", "ok", "not_object", "not_object"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet='{}[],:"a1 ', max_size=12), min_size=50, max_size=200))
def test_greedy_agrees_with_a_strict_parser(spark, texts):
    def expected(text):
        start, end = text.find("{"), text.rfind("}")
        try:
            return json.loads(text[start:end + 1]) if start >= 0 else None
        except json.JSONDecodeError:
            return None

    assert [d for d, _ in parsed(spark, texts)] == [expected(t) for t in texts]


@pytest.mark.parametrize("doc, status", [
    ({"General Information": [1]}, "general_not_object"),
    ({"General Information": "text"}, "general_not_object"),
    ({"Track Info": {"a": 1}}, "tracks_not_array"),
    ({"Track Info": [{"Face": "A"}, "b"]}, "track_not_object"),
    ({"General Information": {}, "Track Info": []}, "ok"),
    ({"General Information": None, "Track Info": {}}, "ok"),
    ({"Track Info": [{}]}, "ok"),
])
def test_misplaced_sections(spark, doc, status):
    assert parsed(spark, [json.dumps(doc)])[0][1] == status


def documents(spark, *docs):
    df = spark.createDataFrame([(f"LP{i}", json.dumps(d)) for i, d in enumerate(docs, 1)], "lp_id string, response string")
    return extract.parse_documents(df)


def test_quarantine_and_found(spark, rows):
    df = documents(spark, {"a": 1}, [1], {})
    assert rows(extract.quarantine(df), "lp_id", "reason") == [("LP2", "no_json")]
    assert rows(extract.found_documents(df), "lp_id", "doc_json") == [("LP1", '{"a":1}')]


def test_general_rows(spark, rows):
    df = documents(spark, {"General Information": {"LP_ID": "LP9", "Title": "T", "Genre/Style": "G", "Publishing Year": 1970}},
                   {"General Information": {}}, {"Track Info": []}, {"General Information": {"Country": None}})
    got = extract.general_rows(df)
    assert rows(got, "LP_ID", "Title", "`Genre/Style`", "`Publishing Year`", "Subtitle") == [
        ("LP1", "T", "G", "1970", None), ("LP4", None, None, None, None)]
    assert rows(extract.general_rows(df, defaults={"Country": "missing"}), "LP_ID", "Country") == [
        ("LP1", "missing"), ("LP4", None)]


def test_track_defaults_only_where_the_key_is_absent(spark, rows):
    df = documents(spark, {"Track Info": [{}, {"Track_Name": None}, {"Track_Name": "N", "Track_Composer": "C"}]})
    assert rows(extract.track_rows(df), "seq", "Track_Name", "Track_Composer") == [
        (0, "missing", "missing"), (1, None, "missing"), (2, "N", "C")]


def test_track_numbers_given_as_numbers(spark, rows):
    df = documents(spark, {"Track Info": [{"Track_Number": 1}, {"Track_Number": "2."}, {"Track Number": "3", "Track_Number": "4"}]})
    assert [r[1:] for r in rows(extract.track_rows(df), "seq", "`Track Number`", "track_no")] == [
        ("1", "01"), ("2.", "02"), ("3", "03")]
    assert [r[1] for r in rows(extract.track_rows(df, coerce_numbers=False), "seq", "track_no")] == [None, "02", "03"]


def test_tracks_that_are_no_objects_are_left_out(spark, rows):
    df = documents(spark, {"Track Info": ["x", {"Face": "A"}, 5]})
    assert rows(extract.track_rows(df), "seq", "Face") == [(1, "A")]


def test_array_rows(spark, rows):
    df = spark.createDataFrame([("t", ["a", "b"], [1])], "title string, names array<string>, lengths array<int>")
    assert rows(extract.rows_from_array(df.select("title", "names"), "names", "name")) == [("t", "a"), ("t", "b")]
    zipped = extract.rows_from_parallel_arrays(df, {"names": "name", "lengths": "length"})
    assert rows(zipped) == [("t", 0, "a", 1), ("t", 1, "b", None)]


def test_colliding_album_ids(spark, rows):
    albums = spark.createDataFrame([("LP0001", "AB1"), ("LP0001", "AB1"), ("LP0002", "AB1")], "LP_ID string, `Label Number` string")
    tracks = spark.createDataFrame([("LP0001", "A", "1"), ("LP0001", "A", "7"), ("LP0001", "C", "1"), ("LP0002", "A", None)],
                                   "LP_ID string, Face string, `Track Number` string")
    got = {r["rule"]: (r["checked"], r["violations"]) for r in checks.contract_report(albums, tracks).collect()}
    assert got["album_id_unique"] == (3, 2) and got["slot_in_grid"] == (4, 3)
