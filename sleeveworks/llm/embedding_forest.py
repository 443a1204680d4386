"""Near-duplicate embeddings by a forest of random-projection trees.

Only vectors with the same label (and length) are compared, so each label starts as one node of each
tree. A node with too many vectors is split by random directions at the median of a bounded sample;
vectors near a split go to both sides. Nodes that are still too large are split again in the next round.
Vectors are compared within leaves, with exact cosines. Near pairs differ little along any direction,
so a split with overlap rarely parts them, and several trees make a loss in all of them very unlikely.

A pair may meet in several leaves; it counts in the first leaf that both are in, which each vector's
list of leaves tells. So links are counted where they are found and never listed pair by pair: a leaf
returns one count and one tie per vector. A leaf that no direction splits (a dense cluster) is compared
block by block, each pair of blocks on its own.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeveworks.llm.components import components, stored

#: Trees, vectors in a leaf, sampled vectors from which a node's subtree is made.
TREES, LEAF, SAMPLE = 4, 2048, 4000
#: Half the width of a split's overlap; near pairs at 0.98 differ by 0.2 in all, along 64 random
#: dimensions by 0.025 (one standard deviation).
OVERLAP = 0.03
#: A split that leaves more than this share of its vectors on one side is not worth its copies.
WORST = 0.8
#: Vectors in a block of a dense leaf, and about how many of a node a task sends down its subtree.
BLOCK, SHARE = 2048, 50_000


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _grow(unit: np.ndarray, scale: float, leaf: int, random: np.random.Generator) -> list[tuple]:
    """Splits (node, left, right, threshold, direction) of a subtree over a sample that stands for
    ``scale`` vectors each; node 0 is its root, a child below 0 is a leaf."""
    splits, work, made, leaves, whole = [], [(0, np.arange(len(unit)))], 1, 0, {}
    while work:
        node, members = work.pop()
        best = None
        for _ in range(3):
            direction = random.standard_normal(unit.shape[1])
            direction /= np.linalg.norm(direction)
            along = unit[members] @ direction
            threshold = float(np.median(along))
            sides = [members[along <= threshold + OVERLAP], members[along >= threshold - OVERLAP]]
            worst = max(len(s) for s in sides) / len(members)
            if best is None or worst < best[0]:
                best = worst, threshold, direction, sides
        if best[0] > WORST:
            # A root stays one leaf; below it the splits made so far hold, and only this node is a leaf.
            if node == 0:
                return []
            leaves += 1
            whole[node] = -leaves
            continue
        children = []
        for side in best[3]:
            small = len(side) * scale <= leaf or len(side) < 16
            if not small:
                # A cluster so dense that a split's overlap would hold most of it stays whole.
                probe = unit[side] @ _unit(random.standard_normal((3, unit.shape[1]))).T
                small = bool((probe.std(axis=0) < OVERLAP).all())
            if small:
                leaves += 1
                children.append(-leaves)
            else:
                children.append(made)
                work.append((made, side))
                made += 1
        splits.append((node, children[0], children[1], best[1], best[2]))
    return [(node, whole.get(left, left), whole.get(right, right), *cut) for node, left, right, *cut in splits]


def _fit(leaf: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Subtree of a node from its sampled vectors."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        node, n = int(rows["node"].iloc[0]), int(rows["n"].iloc[0])
        unit = _unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        splits = _grow(unit, n / len(unit), leaf, np.random.default_rng(node & (2**63 - 1)))
        return pd.DataFrame({
            "node": [node], "n": [n], "links": [[int(x) for s in splits for x in s[:3]]], "thresholds": [[s[3] for s in splits]],
            "directions": [[float(x) for s in splits for x in s[4]]],
        })
    return run


_TREE = "node long, n long, links array<long>, thresholds array<double>, directions array<double>"
_CUTS = ["links", "thresholds", "directions"]


class _Subtree:
    """The splits of one node."""

    def __init__(self, row: dict):
        self.links = np.array(row["links"], np.int64).reshape(-1, 3)
        self.thresholds = row["thresholds"]
        self.directions = np.array(row["directions"]).reshape(len(self.links), -1)
        self.place = {int(s[0]): i for i, s in enumerate(self.links)}

    def route(self, vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Which vectors go to a leaf, and to which; a vector near a split goes to several."""
        unit = _unit(np.stack(vectors.to_numpy()).astype(np.float64))
        work, taken, child = [(0, np.arange(len(unit)))], [], []
        while work:
            here, members = work.pop()
            i = self.place[here]
            along = unit[members] @ self.directions[i]
            for down, side in ((self.links[i][1], along <= self.thresholds[i] + OVERLAP), (self.links[i][2], along >= self.thresholds[i] - OVERLAP)):
                if down < 0:
                    taken.append(members[side])
                    child.append(np.full(int(side.sum()), down, np.int64))
                elif side.any():
                    work.append((int(down), members[side]))
        return np.concatenate(taken), np.concatenate(child)


def _descend(batches):
    """From rows in order of node and share, each share's subtree ahead of its vectors: vectors with the leaf they go to."""
    subtree = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        heads = np.flatnonzero(rows["kind"].to_numpy() == 0)
        for start, stop in zip([0, *heads], [*heads, len(rows)]):
            if start < len(rows) and start in heads:
                subtree = _Subtree(rows.select(_CUTS).slice(int(start), 1).to_pylist()[0])
                start += 1
            part = rows.slice(int(start), int(stop - start))
            if len(part):
                taken, child = subtree.route(part["vector"])
                kept = part.select(["label", "id", "copies", "vector", "node", "tree"]).take(pa.array(taken))
                yield from kept.append_column("child", pa.array(child)).to_batches()


def _in_leaf(threshold: float) -> Callable[[pa.Table], pa.Table]:
    """From the vectors of one leaf, or of two blocks of it: links and a tie per vector."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
        here, first, second = (rows[c][0].as_py() for c in ("leaf", "first", "second"))
        side = rows["block"].to_numpy()
        unit = _unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        # Leaves before this one, padded; a pair that shares one of them was counted there.
        lists = [[x for x in leaves if x < here] for leaves in rows["leaves"].to_pylist()]
        width = max(map(len, lists))
        early = np.zeros((len(ids), width), np.int64)
        for i, leaves in enumerate(lists):
            early[i, :len(leaves)] = leaves
            early[i, len(leaves):] = here
        links, pairs = np.zeros(len(ids), np.int64), []
        step = max(1, (1 << 21) // len(ids))
        for start in range(0, len(ids), step):
            near = unit[start:start + step] @ unit.T >= threshold
            if first != second:
                near &= side[start:start + step, None] != side[None, :]
            near[np.arange(near.shape[0]), start + np.arange(near.shape[0])] = False
            a, b = np.nonzero(near)
            a += start
            pairs.append(np.stack([a, b]).astype(np.int32))
            for k in range(0, len(a), 1 << 16):
                x, y = a[k:k + (1 << 16)], b[k:k + (1 << 16)]
                met = np.zeros(len(x), bool)
                for i in range(width):
                    mine = early[x, i]
                    met |= ((early[y] == mine[:, None]).any(axis=1)) & (mine != here)
                np.add.at(links, x[~met], copies[y[~met]])
        a, b = np.concatenate(pairs, axis=1)
        tie = np.arange(len(ids))
        while len(a):
            lower = tie.copy()
            np.minimum.at(lower, a, tie[b])
            lower = lower[lower]
            if (lower == tie).all():
                break
            tie = lower
        return pa.table({"id": pa.array(ids), "links": pa.array(links), "tie": pa.array(ids[tie])})
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id: str = "vec_id", vector: str = "embedding",
                 label: str = "label", trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE,
                 block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Two vectors are linked if their labels are equal and not null and their cosine, in double
    precision, is ``threshold`` or more. Vectors that are null, empty, zero or have a null or
    non-finite component link with nothing, and so do rows without an id. Equal vectors are linked;
    they are compared as one and count with their number. Rows that repeat an id count each. Other
    columns are ignored; an empty table gives no rows. ``leaf``, ``sample`` and ``trees`` change the
    work and the chance of a loss, never which links are right.
    """
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
                          F.col(label).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = rows.where(usable)
    same = good.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    same = same.withColumn("id", F.xxhash64("label", "vector"))
    same = stored(same, "vectors")

    state = same.drop("least").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "node", F.xxhash64("tree", "label", F.size("vector")))
    done = None
    while True:
        sizes = state.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        large = sizes.where(F.col("n") > leaf)
        share = F.pmod(F.xxhash64("id", "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = state.join(large, "node").where(share * F.col("n") < sample).select("node", "n", "id", "vector")
        subtrees = stored(drawn.groupBy("node").applyInPandas(_fit(leaf), _TREE), "subtrees")
        split = subtrees.where(F.size("thresholds") > 0)
        still = state.join(split.select("node"), "node", "left_anti")
        done = still if done is None else done.unionByName(still)
        if split.isEmpty():
            break
        # A subtree goes ahead of its node's vectors, once per share of them, and not with each.
        shares = F.ceil(F.col("n") / F.lit(SHARE))
        heads = split.select("*", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share"), F.lit(0).alias("kind")).drop("n")
        below = state.join(split.select("node", shares.alias("shares")), "node").withColumn(
            "share", F.pmod(F.xxhash64("id"), F.col("shares"))).drop("shares").withColumn("kind", F.lit(1))
        parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows_in = below.unionByName(heads, allowMissingColumns=True).repartition(parts, "node", "share").sortWithinPartitions("node", "share", "kind")
        deeper = rows_in.mapInArrow(
            _descend, "label {0}, id long, copies long, vector array<double>, node long, tree int, child long".format(
                state.schema["label"].dataType.simpleString()))
        deeper = deeper.withColumn("node", F.xxhash64("node", "child")).drop("child")
        state = stored(deeper.select(*done.columns), "nodes")

    members = done.withColumnRenamed("node", "leaf").select("id", "copies", "vector", "leaf")
    lists = members.groupBy("id").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    counts = members.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    placed = members.join(counts, "leaf").join(lists, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # Every pair of blocks meets once; a leaf of one block meets itself.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    met = placed.groupBy("leaf", "first", "second").applyInArrow(_in_leaf(threshold), "id long, links long, tie long")
    met = stored(met, "met")
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(met.select("id", "tie"), "id", "tie").withColumnRenamed("node", "id")
    tied = same.select("label", "vector", "id", "copies", "least").join(links, "id", "left").join(found, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    least = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    result = tied.join(least, "component").select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = good.join(result, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
