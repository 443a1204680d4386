"""The registered queries against their SQL, and the pipeline stage by stage."""

import re
from collections import Counter

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from sleeveworks.llm.oracles import ORACLES, mixture, quality
from sleeveworks.llm.queries import QUERIES, TOKENIZERS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def other():
    db = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, other, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = other.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", ["op4_raking", "op6_quality_rules", "op7_url_filter", "op13_merkle_manifest"])
def test_native(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before, columns = docs.count(), docs.dtypes
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.dtypes == columns
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= {r.doc_id for r in docs.select("doc_id").collect()} and 0 < len(kept) <= before
        docs, before = out, len(kept)
    assert docs.where("NOT round_trip").isEmpty()


def firsts(texts, size, percent):
    """Least id of every group of texts whose sets of word shingles are similar."""
    sets = {}
    for i, t in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[i] = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()
    group = {i: i for i in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            shared = len(sets[a] & sets[b]) if a < b else 0
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return {i for i, g in group.items() if i == g}


def without_repeats(texts, length=200):
    bodies = {i: t.encode() for i, t in texts.items()}
    seen = Counter(body[k:k + length] for body in bodies.values() for k in range(len(body) - length + 1))
    out = {}
    for i, body in bodies.items():
        gone = set()
        for k in range(len(body) - length + 1):
            if seen[body[k:k + length]] > 1:
                gone.update(range(k, k + length))
        out[i] = bytes(b for k, b in enumerate(body) if k not in gone).decode("utf-8", "ignore")
    return out


def test_pipeline_against_plain(spark, other):
    """Every stage's whole result, from what the plain version of the stage before it left."""
    run = {name: (lambda docs, stage=stage: stage(spark, docs, SF_DIR)) for name, stage in corpus_pipeline.STAGES}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")

    docs = spark.createDataFrame(run["quality rules"](docs).collect(), docs.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts == dict(other.sql(f"SELECT doc_id, clean FROM ({quality()}) WHERE kept").fetchall())
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs = spark.createDataFrame(run["n-gram Jaccard join"](docs).collect(), docs.schema)
    stay = firsts(texts, 5, 80)
    texts = {i: t for i, t in texts.items() if i in stay}
    assert {r.doc_id: r.text for r in docs.collect()} == texts

    docs = spark.createDataFrame(run["suffix-array dedup"](docs).collect(), docs.schema)
    texts = without_repeats(texts)
    assert {r.doc_id: r.text for r in docs.collect()} == texts

    left = docs.toPandas()
    other.register("left_docs", left)
    docs = spark.createDataFrame(run["mixing to target weights"](docs).collect(), docs.schema)
    drawn = {i for i, in other.sql(f"SELECT doc_id FROM ({mixture('left_docs')}) WHERE kept").fetchall()}
    assert {r.doc_id for r in docs.collect()} == drawn and 0 < len(drawn) < len(texts)

    own = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    for r in run["SentencePiece encoding"](docs).collect():
        assert list(r.ids) == own.encode(texts[r.doc_id])
