"""A Merkle manifest of a table: a leaf per row, a tree per group, a tree over the groups' roots, and for
every row the proof that leads from its leaf to the root.

Every ``fanout`` consecutive nodes become their hash, a shorter last run too, until one is left. Nodes
are not paired with neighbours by joins: conditional aggregates spread a parent's children into columns,
one per slot. The columns joined together are what is hashed; the same columns without a row's own slot are
its siblings. A block of columns spans as many levels as fit into ``COLUMNS`` slots, so a table of n rows
takes log n / log COLUMNS shuffles, each of a sixteenth of the rows before it.

Positions come from one range sort, whose partitions are counted; no task sees a whole group. Proofs
go down the tree block by block, so only the last step handles a row per leaf.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sleeveworks.llm.components import stored

#: Slots of a block at most, unless the fanout itself is larger.
COLUMNS = 16

_NONE = "CAST(array() AS array<struct<left:string,right:string>>)"


def digest(*parts: Column) -> Column:
    """SHA-256 of the inputs put together, in hex."""
    return F.sha2(F.concat_ws("", *parts), 256)


def row_hash(fields: Sequence[Column]) -> Column:
    """Leaf of a row: every field as byte count, ``:`` and value, or ``-`` for a null."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))


def siblings(path: Column) -> Column:
    """All siblings along a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def _placed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (grp, place, hash, row) with ``pos`` within the group by place, and the group's size ``n``; and
    the size of the largest group."""
    ordered = rows.withColumn("tie", F.monotonically_increasing_id()).orderBy("grp", "place", "hash", "tie")
    table = stored(ordered.select("grp", "hash", "row", F.spark_partition_id().alias("part"),
                                  F.monotonically_increasing_id().alias("at")), "leaves")
    sizes = table.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("many"), F.min("at").alias("first"))
    # One row per group and partition of the sort.
    within = W.partitionBy("grp")
    before = F.sum("many").over(within.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("grp", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("many").over(within).alias("n"))
    sizes = stored(sizes, "sizes")
    placed = table.join(sizes, ["grp", "part"]).selectExpr("grp", "at - first + before AS pos", "n", "hash", "row")
    return placed, sizes.agg(F.max("n")).first()[0] or 0


class _Shape:
    """Fanout, levels of a block, and the columns of a block."""

    def __init__(self, fanout: int):
        if fanout < 2:
            raise ValueError("a fanout below 2 never ends")
        self.fanout, self.span = fanout, 1
        while fanout ** (self.span + 1) <= COLUMNS:
            self.span += 1
        self.width = fanout ** self.span

    def _applies(self, done: int) -> str:
        """Whether more than one node of the group is left after ``done`` levels."""
        return f"n > {self.fanout ** done}D" if self.fanout ** done >= 2**63 else f"n > {self.fanout ** done}L"

    def blocks(self, nodes: DataFrame, done: int) -> DataFrame:
        """One row per block of nodes: the nodes of each of its levels, and what remains of it."""
        columns = [f"slot{i}" for i in range(self.width)]
        wide = nodes.groupBy("grp", F.expr(f"pos div {self.width}").alias("block")).agg(F.max("n").alias("n"), *[
            F.expr(f"max(CASE WHEN pos % {self.width} = {i} THEN hash END)").alias(c) for i, c in enumerate(columns)])
        ready = ["grp", "block", "n"]
        for level in range(self.span):
            parents = []
            for i in range(0, len(columns), self.fanout):
                run = columns[i:i + self.fanout]
                # Beyond the group's last level the lone node stays as it is.
                parents.append(f"CASE WHEN NOT {self._applies(done + level)} THEN {run[0]} "
                               f"WHEN {run[0]} IS NOT NULL THEN sha2(concat_ws('', {', '.join(run)}), 256) END AS up{level}_{len(parents)}")
            wide = wide.selectExpr(*ready, f"array({', '.join(columns)}) AS level{level}", *parents)
            ready, columns = [*ready, f"level{level}"], [f"up{level}_{i}" for i in range(len(parents))]
        return wide.selectExpr(*ready, f"{columns[0]} AS hash")

    def steps(self, slot: str, done: int) -> str:
        """Siblings of a slot inside its block, left and right of it, for every level that applies."""
        parts = []
        for level in range(self.span):
            own = f"CAST({slot} div {self.fanout ** level} AS INT)"
            nth = f"({own} % {self.fanout})"
            left = f"array_join(slice(level{level}, {own} - {nth} + 1, {nth}), '')"
            right = f"array_join(slice(level{level}, {own} + 2, {self.fanout - 1} - {nth}), '')"
            parts.append(f"CASE WHEN {self._applies(done + level)} THEN array(struct({left} AS left, {right} AS right)) ELSE {_NONE} END")
        return f"concat({', '.join(parts)}, rest)"


def _grow(leaves: DataFrame, largest: int, shape: _Shape) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, written down, and the root of every group."""
    rounds, nodes = [], leaves.select("grp", "pos", "n", "hash")
    while shape.width ** len(rounds) < largest:
        rounds.append(stored(shape.blocks(nodes, len(rounds) * shape.span), "blocks"))
        nodes = rounds[-1].selectExpr("grp", "block AS pos", "n", "hash")
    return rounds, nodes.select("grp", "hash")


def _descend(rounds: list[DataFrame], leaves: DataFrame, above: DataFrame, shape: _Shape) -> DataFrame:
    """``leaves`` with ``path`` to the root; ``above`` has the rest of each group's path (grp, rest, ...)."""
    state = above.selectExpr("*", "0L AS block")
    kept = [c for c in above.columns if c not in ("grp", "rest")]
    for i in reversed(range(len(rounds))):
        state = rounds[i].drop("hash").join(state, ["grp", "block"])
        if i:
            state = state.selectExpr("*", "posexplode(filter(level0, h -> h IS NOT NULL)) AS (pos, hash)").selectExpr(
                "grp", f"block * {shape.width} + pos AS block", f"{shape.steps('pos', i * shape.span)} AS rest", *kept)
    width = shape.width if rounds else 1
    joined = leaves.selectExpr("grp", "row", "pos", f"pos div {width} AS block").join(state, ["grp", "block"])
    return joined.selectExpr("row", "pos", *kept, f"{shape.steps(f'(pos % {width})', 0)} AS path" if rounds else "rest AS path")


def manifest(rows: DataFrame, leaf: str = "leaf", group: str = "lang", order: str = "doc_id", fanout: int = 2) -> DataFrame:
    """``rows`` with ``position`` in the group, ``subroot`` of the group, ``root`` of all, and ``path``: from
    the leaf's level up, the siblings left and right of the way to the root (``fold``, ``siblings``).

    Leaves of a group ascend by ``order``, nulls first, ties by leaf; equal leaves with equal order take
    neighbouring places, whose proofs differ. A null group is a group of its own and comes first. A null leaf is
    hashed as an empty text. Columns of ``rows`` with a new column's name are replaced; an empty table gives
    no rows.
    """
    shape, new = _Shape(fanout), ("position", "subroot", "root", "path")
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in new])
    # A null group sorts before all others, whose keys start with "=".
    grp = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    # Written down before it is sorted: the sort reads its rows twice, and the table's texts should be hashed once.
    leaves, largest = _placed(stored(rows.select(grp.alias("grp"), F.col(f"`{order}`").alias("place"),
                                          F.coalesce(F.col(f"`{leaf}`"), F.lit("")).alias("hash"), row.alias("row")), "rows"))
    rounds, roots = _grow(leaves, largest, shape)
    tops, groups = _placed(roots.selectExpr("'' AS grp", "grp AS place", "hash", "struct(grp, hash) AS row"))
    upper, top = _grow(tops, groups, shape)
    above = top.selectExpr("grp", f"{_NONE} AS rest", "hash AS root")
    over = _descend(upper, tops, above, shape).selectExpr("row.grp AS grp", "path AS rest", "row.hash AS subroot", "root")
    return _descend(rounds, leaves, over, shape).selectExpr("row.*", "pos AS position", "subroot", "root", "path")
