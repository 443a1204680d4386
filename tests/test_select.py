import pytest

from sleeveworks.operators import select


@pytest.fixture
def albums(spark):
    return spark.createDataFrame([(f"LP{i}",) for i in (7, 12, 1, 3, 10, 2, 11, 4, 9, 5, 8, 6)], "lp_id string")


def names(*numbers):
    return [f"LP{n}" for n in numbers]


@pytest.mark.parametrize("text, expected", [
    ("all", range(1, 13)), ("3", (1, 2, 3)), ("first-3", (1, 2, 3)), ("last-2", (11, 12)), ("9-11", (9, 10, 11)),
    ("11-9", ()), ("0", ()), ("last-99", range(1, 13)), ("last-0", ()), ("11-40", (11, 12)),
])
def test_selection(albums, text, expected):
    got = select.select_positions(albums, text)
    assert [r[0] for r in got.collect()] == names(*expected)


def test_last_zero_was_everything(albums):
    assert select.select_positions(albums, "last-0", parity=True).count() == 12


@pytest.mark.parametrize("text", ["foo", "first-", "1-2-3", "a-b", "-3", "0-2", "", "١"])
def test_bad_selections(text):
    with pytest.raises(ValueError, match="not a selection"):
        select.parse_selection(text)


def test_natural_order(spark):
    df = spark.createDataFrame([(n,) for n in ["LPx", "LP10", "LP9b", "LP100", "LP9"]], "lp_id string")
    assert [r[0] for r in select.natural_sort(df).collect()] == ["LP9", "LP9b", "LP10", "LP100", "LPx"]
    assert [r[0] for r in select.select_positions(df, "last-2").collect()] == ["LP100", "LPx"]


def test_album_names(spark, rows):
    df = spark.createDataFrame([("LP1",), ("XX2",), ("LP1",), ("lp3",)], "lp_id string")
    assert rows(select.album_names(df)) == [("LP1",)]


def test_positions_over_many_partitions(spark):
    df = spark.range(5000).selectExpr("'LP' || id * 7 AS lp_id").repartition(13)
    got = {r["lp_id"]: r["position"] for r in select.with_position(df).collect()}
    assert got == {f"LP{i * 7}": i + 1 for i in range(5000)}
