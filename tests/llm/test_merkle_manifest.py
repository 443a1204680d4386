"""The Merkle manifest against a plain tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sleeveworks.llm import merkle_manifest as M


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_paths(leaves, fanout):
    """Root, and per leaf the siblings left and right of its way, level by level."""
    level, ways, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i:i + fanout] for i in range(0, len(level), fanout)]
        for k, place in enumerate(at):
            run, nth = runs[place // fanout], place % fanout
            ways[k].append(("".join(run[:nth]), "".join(run[nth + 1:])))
            at[k] = place // fanout
        level = [h(*run) for run in runs]
    return level[0], ways


def plain(rows, fanout=2):
    """rows of (lang, id, leaf): multiset of (lang, id, leaf, subroot, root, path)."""
    groups = {}
    for lang, i, leaf in rows:
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf, i))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: plain_paths([r[2] for r in sorted(groups[lang], key=lambda r: r[:3])], fanout) for lang in langs}
    root, upper = plain_paths([trees[lang][0] for lang in langs], fanout)
    return sorted(((lang, r[3], r[2], trees[lang][0], root, tuple(way + above)) for lang, above in zip(langs, upper)
                   for r, way in zip(sorted(groups[lang], key=lambda r: r[:3]), trees[lang][1])), key=str)


def found(df):
    return sorted(((r.lang, r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in df.collect()), key=str)


@pytest.mark.parametrize("fanout", [2, 3, 20])
def test_trees(spark, documents, fanout):
    # Sizes on both sides of a block's width; null ids and repeated rows; a lone leaf; a null group.
    langs = ["en"] * 70 + ["de"] * 16 + ["fr"] * 17 + ["it"] + [None] * 3 + ["é"] * 33
    ids = [None if i % 40 == 7 else i // 2 for i in range(len(langs))]
    rows = [(lang, i, h(str(i), lang or "")) for lang, i in zip(langs, ids)]
    got = M.manifest(spark.createDataFrame(rows, "lang string, doc_id long, leaf string").repartition(5), fanout=fanout)
    assert found(got) == plain(rows, fanout)
    assert got.where(M.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
    assert got.where(M.fold(F.lit(h("other")), F.col("path")) == F.col("root")).isEmpty()
    assert sorted(r.position for r in got.where("lang = 'en'").collect()) == list(range(70))


def test_rows(spark, documents):
    """Nulls in any column, an empty and a very long text, byte counts, and names that the operator uses."""
    docs = documents(["", "é ñ", None, "x " * 500_000, "same", "same"], ids=[0, 1, 2, None, 5, 5])
    docs = docs.withColumn("grp", F.lit("g")).withColumn("path", F.lit("p")).withColumn("hash", F.lit("q")).withColumn("pos", F.lit(1))
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    got = M.manifest(docs.withColumn("leaf", M.row_hash(parts)))
    want = plain([(r.lang, r.doc_id, plain_leaf([r.doc_id, r.source, r.lang, r.n_chars, r.text])) for r in docs.collect()])
    assert found(got) == want
    assert {(r.grp, r.hash, r.pos) for r in got.collect()} == {("g", "q", 1)}


def test_small_tables(spark):
    none = spark.createDataFrame([], "lang string, doc_id long, leaf string")
    assert M.manifest(none).collect() == []
    one = M.manifest(spark.createDataFrame([("en", 1, None)], none.schema)).collect()
    assert [(r.root, r.subroot, r.path, r.position) for r in one] == [("", "", [], 0)]
    with pytest.raises(ValueError):
        M.manifest(none, fanout=1)
