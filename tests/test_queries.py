"""Every query against its expected result in another engine, and the shape of the plans."""

import re

import duckdb
import pytest

from sleeveworks.plans.oracles import ORACLES
from sleeveworks.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def other():
    db = duckdb.connect()
    for name in TABLES.split():
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    expected = other.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(other.sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall(), key=str)
    have = sorted((tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()), key=str)
    assert have == want and have


IN_PYTHON = {"enrich_text", "recognise_covers", "enrich_audio", "enrich_capped", "calls_in_flight", "loose_blocks", "csv_in_parts"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"incremental_arrival", "extraction_store", "csv_tracks"}))
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    python = re.search(r"MapInArrow|PythonMapInArrow|PythonUDF|ArrowEvalPython|BatchEvalPython", plan)
    assert bool(python) == (name in IN_PYTHON)
    # A response is decoded once per use of it, never again in a pushed-down filter.
    assert not re.search(r"Filter [^\n]*parseJson", plan)


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["support_count"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {"p_partkey:bigint", "l_partkey:bigint"}


@pytest.mark.parametrize("name", ["resume_laid_out", "audio_laid_out"])
def test_what_is_laid_out_is_not_shuffled(spark, name):
    """Neither its distinct keys nor the join exchange the stored side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = QUERIES[name](spark, SF_DIR)
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    stored = next(line for line in final.split("\n") if "laid_out_" in line and "Scan" in line)
    above = final.split("\n")[:final.split("\n").index(stored)]
    depth = len(stored) - len(stored.lstrip(" :+-"))
    # Operators between the scan and the join: each line above that is less deep than what came below it.
    chain = []
    for line in reversed(above):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < depth:
            chain.append(line)
            depth = here
    below_join = []
    for line in chain:
        if "Join" in line:
            break
        below_join.append(line)
    assert any("Join" in line for line in chain) and not any("Exchange" in line or "ShuffleQueryStage" in line for line in below_join), final
    assert "Bucketed: true" in stored
