import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sleeveworks.functions import scalars as S
from sleeveworks.functions import text as X
from sleeveworks.operators.label import with_continent
from sleeveworks.schema import NA_SPELLINGS


def values(spark, column, inputs, kind="string"):
    """``column`` of each input, in input order."""
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_track_number(spark):
    given_ = ["1", " 1.a", "12", "123", "A", "", "  ", None, "4 3 6 N"]
    assert values(spark, S.track_number(F.col("x")), given_) == ["01", "01", "12", "123", None, None, None, None, "04"]


def test_track_number_refuses_what_was_no_text(spark):
    assert values(spark, S.track_number(F.col("x"), F.lit(False)), ["1"]) == [None]


def test_duration_text(spark):
    seconds = [0.0, 59.99, 60.0, 185.9, 3600.0, None, 179.99999999999997]
    assert values(spark, S.duration_text(F.col("x")), seconds, "double") == [
        "0'00", "0'59", "1'00", "3'05", "60'00", "missing", "2'59"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(0, 1e7), min_size=1, max_size=200))
def test_duration_text_rounds_down_as_integer_division(spark, seconds):
    expected = [f"{int(s // 60)}'{int(s % 60):02d}" for s in seconds]
    assert values(spark, S.duration_text(F.col("x")), seconds, "double") == expected


def test_capitalise_is_not_word_by_word(spark):
    assert values(spark, S.capitalise(F.col("x")), ["costa RICA", "URUGUAY", "éire", "", None]) == [
        "Costa rica", "Uruguay", "Éire", "", None]


def test_continents(spark):
    df = spark.createDataFrame([(c,) for c in ["Spain", "URUGUAY", "Mexique", "bolivia", None]], "Country string")
    got = {r["Country"]: (r["continent"], r["sub_continent"]) for r in with_continent(df).collect()}
    assert got == {
        "Spain": ("Europe", "Europe méridionale"), "URUGUAY": ("Amérique", "Amérique du Sud"),
        "Mexique": ("Amérique", "Amérique centrale"), "bolivia": (None, None), None: (None, None)}


def test_names_and_shelfmarks(spark):
    assert values(spark, S.lp_id_of_file(F.col("x")), ["LP2836_ai_output.json", "LP12_x_ai_output.json"]) == ["LP2836", "LP12"]
    assert values(spark, S.shelfmark(F.col("x")), ["LP2836", None]) == ["LP2836-1/1", None]
    assert values(spark, S.shelfmark_of_folder(F.col("x")), ["LP2836_1z1"]) == ["LP2836-1/1"]
    assert values(spark, S.output_name(F.col("x")), ["LP1_combined.txt"]) == ["LP1_ai_output.json"]


def test_name_and_composer(spark):
    none = F.lit(None).cast("string")
    assert values(spark, S.name_and_composer(F.col("x"), none), ["Negrita"]) == ["Negrita"]
    assert values(spark, S.name_and_composer(F.col("x"), none, parity=True), ["Negrita"]) == ["Negrita-nan"]


def test_dates(spark):
    day = F.lit(dt.date(2024, 9, 5))
    assert values(spark, S.full_date(day), ["x"]) == ["05.09.2024"]
    assert values(spark, S.curation_comment("Done.", "A. B", day), ["x"]) == ["Done. (A. B 09.2024)"]


def test_null_spellings(spark):
    assert len(NA_SPELLINGS) == 19
    assert values(spark, S.null_spellings(F.col("x")), NA_SPELLINGS + ["missing", "0"]) == [None] * 19 + ["missing", "0"]


def test_audio_slots(spark):
    code = S.slot_code(F.col("x"))
    names = ["LP1_1z1_A01.mp3", "LP1_B12.mp3", "A3.mp3", "LP1_1z1_A0x.mp3", "cover.mp3"]
    assert values(spark, F.struct(S.code_face(code), S.code_number(code)), names) == [
        ("A", "01"), ("B", "12"), ("A", "3"), (None, None), (None, None)]
    code = S.legacy_slot_code(F.lit("LP1"), F.col("x"))
    assert values(spark, code, ["LP1_A1.mp3", "LP1_B12.mp3", "LP1_1z1_A01.mp3", "LP11_A1.mp3", "LP1_C1.mp3"]) == [
        "A1", "B12", None, None, None]


def test_data_url_has_no_line_ends(spark):
    url = values(spark, S.data_url(F.encode("x", "UTF-8")), ["a" * 300])[0]
    assert url.startswith("data:image/jpeg;base64,YWFh") and "\n" not in url and "\r" not in url


def test_blocks_keep_detection_order_at_equal_height(spark):
    df = spark.createDataFrame(
        [([(0, 30, 0, "c"), (5, 10, 1, "a"), (1, 10, 2, "b")],)],
        "blocks array<struct<x:int,y:int,seq:int,text:string>>")
    assert df.select(X.blocks_in_reading_order(F.col("blocks"))).first()[0] == "a\nb\nc"


def test_cover_text_and_chunks(spark):
    none = F.lit(None).cast("string")
    assert values(spark, X.cover_text(F.col("x"), none), ["f"]) == ["Front Cover:\nf\nBack Cover:\n"]
    assert values(spark, X.join_chunks(F.split("x", ",")), ["a,b,c"]) == ["abc"]


@pytest.mark.parametrize("text, body, bare", [
    ("```json\n [1, 2] \n```", "[1, 2]", "\n [1, 2] \n"),
    ("no fence", None, "no fence"),
])
def test_fences(spark, text, body, bare):
    assert values(spark, X.fenced_body(F.col("x")), [text]) == [body]
    assert values(spark, X.drop_fences(F.col("x")), [text]) == [bare]
