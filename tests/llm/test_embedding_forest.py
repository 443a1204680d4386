import numpy as np
import pytest

from sleeveworks.llm import embedding_forest
from sleeveworks.llm.embedding_forest import _grow, _unit, near_vectors


def plain(rows, threshold):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, least = [0] * len(rows), [r[0] for r in rows]
    near = []
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a != b and rows[a][2] == rows[b][2] and len(x) == len(y) and x @ y >= threshold * np.linalg.norm(x) * np.linalg.norm(y):
                links[a] += 1
                near.append((a, b))
    for _ in rows:
        for a, b in near:
            least[a] = min(least[a], least[b])
    return sorted((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, least))


@pytest.fixture
def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for c in range(60):
        centre = draw.standard_normal(16)
        for _ in range(int(draw.integers(1, 12))):
            rows.append((len(rows), [float(x) for x in centre + draw.standard_normal(16) * draw.choice([0.0, 0.02, 0.15])], c % 4))
    rows += [(1000 + i, v, label) for i, (v, label) in enumerate([
        (None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([1.0, None] * 8, 1), ([float("inf")] * 16, 1), ([1.0] * 16, None), ([1.0] * 3, 1)])]
    return rows


# Small leaves and blocks force splits, rounds, and dense leaves in several blocks.
@pytest.mark.parametrize("leaf, sample, block", [(2048, 4000, 2048), (20, 40, 7)])
def test_against_plain(spark, vectors, leaf, sample, block, monkeypatch):
    monkeypatch.setattr(embedding_forest, "SHARE", leaf // 2)
    table = spark.createDataFrame([(*r, "x") for r in vectors], "vec_id long, embedding array<float>, label int, leaf string").repartition(3)
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = near_vectors(table, leaf=leaf, sample=sample, block=block, trees=6).collect()
    assert sorted(map(tuple, got)) == plain(rows, 0.98)


def test_nothing_and_repeats(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (3, [2.0, 4.0], 1)]
    got = near_vectors(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, 2, 3, False), (5, 2, 3, False), (None, 0, None, None), (3, 2, 3, True)], key=str)


def test_a_dense_cluster_keeps_the_splits_around_it():
    """Spread vectors and one cluster above leaf size: only the cluster's node stays whole."""
    random = np.random.default_rng(5)
    spread = random.standard_normal((3600, 64))
    cluster = random.standard_normal(64) + 0.01 * random.standard_normal((400, 64))
    unit = _unit(np.concatenate([spread, cluster]))
    for seed in range(5):
        splits = _grow(unit, 50.0, 2048, np.random.default_rng(seed))
        links = [x for s in splits for x in s[1:3]]
        nodes = {s[0] for s in splits}
        assert sum(x < 0 for x in links) > 20
        # Every child is a leaf of its own number or a split, and every split but the root is some node's child.
        assert nodes == {0, *(x for x in links if x > 0)} and len(set(links)) == len(links)


def test_recall_with_the_registered_constants(spark):
    """Planted pairs on both sides of the threshold, in a label of several leaves."""
    draw = np.random.default_rng(11)
    base = draw.standard_normal((4000, 64))
    unit = _unit(base)
    near = unit[:1500] + draw.uniform(0.005, 0.03, (1500, 1)) * draw.standard_normal((1500, 64))
    whole = np.concatenate([unit, near]).astype(np.float32)
    exact = _unit(whole.astype(np.float64))
    links = (exact @ exact.T >= 0.98).sum(axis=1) - 1
    rows = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(whole)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in near_vectors(rows.repartition(4)).collect()}
    found = np.array([got[i] for i in range(len(whole))])
    assert links.sum() > 1000 and (found <= links).all() and found.sum() >= 0.999 * links.sum()
