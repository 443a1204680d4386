"""Documents whose sets of word shingles have a Jaccard similarity above a threshold, by PartEnum.

Sets of like size share a size band. In a band, similar sets differ in at most k shingles. The domain of
shingles is cut into n1 parts, each into n2 sub-parts; as k < n1 * 2, some part holds at most one
difference, so the two sets agree on all of its sub-parts but one. A set's signatures are the hashes
of its shingles in each part less one sub-part, for its own band and the next: similar sets share one.

Sets that share only emptiness would crowd one bucket, so covers without a shingle are left out. With two
sub-parts, similar sets agree on at least 2 * n1 - k covers; n1 is somewhat larger than it need be, so
that a set rarely has as many empty covers, and one that isn't empty is left for the match. A set that
does have too many empty covers also gets the signatures of a second cut, its empty ones included: a
pair that the first cut can miss meets there, as both its sets have too many.

Sets that share a signature meet by its hash and are named after the least of them; sets that met
under the same least one form a group. A group is compared as a whole, a large one block by block, each
pair of blocks on its own, and returns only as many links as connect its members. So pairs are never
rows, and no pair that shares a signature is left out. Links become components (``components``).

Equal sets are one node. Signatures that a task meets in very many sets are sent on by signature and
set, and only the least set comes to them by a join, so no task gets all members of a bucket.
"""

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeveworks.llm.components import components, stored
from sleeveworks.llm.flatbytes import flat, mix, pieces
from sleeveworks.llm.words import shingles

#: Bytes of text worked on at a time, and between settlings of a task's signatures.
BLOCK, SETTLE = 1 << 21, 1 << 26
#: Sets of one signature that a task sends to the signature's own partition.
SENT = 16
#: Bands of sets up to this size use three sub-parts (longer covers, half as many signatures again).
SMALL = 256
#: Sets of a group that are compared at a time.
GROUP = 512

PLAIN, CROWDED, ASIDE = 0, 1, 2


def bands(percent: int, largest: int) -> np.ndarray:
    """Upper ends of the size bands: sets similar to one in a band are in it or in the next."""
    ends = [0]
    while ends[-1] < largest:
        ends.append((ends[-1] + 1) * 100 // percent)
    return np.array([*ends[1:], (ends[-1] + 1) * 100 // percent], np.int64)


def _cover_sums(sets: np.ndarray, owner: np.ndarray, n1: np.ndarray, n2: np.ndarray, tag: np.ndarray, cut: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every set: hashes of its covers, how many shingles each holds, and which set it is of."""
    slots = n1 * n2
    base = np.cumsum(slots) - slots
    salted = mix(sets + np.uint64(0x9E3779B97F4A7C15 * (cut + 1) & (2**64 - 1)))
    part = (salted >> np.uint64(33)).astype(np.int64) % n1[owner]
    sub = (salted & np.uint64(0xFFFFFFFF)).astype(np.int64) % n2[owner]
    slot = base[owner] + part * n2[owner] + sub
    total = int(slots.sum())
    sums, counts = np.zeros(total, np.uint64), np.bincount(slot, minlength=total)
    np.add.at(sums, slot, mix(sets))
    of = np.repeat(np.arange(len(n1)), slots)
    place = np.arange(total) - base[of]
    # A cover is a part without one sub-part: the sum over the part, less that sub-part.
    part_of = place // n2[of]
    starts = np.flatnonzero(place % n2[of] == 0)
    whole = np.repeat(np.add.reduceat(sums, starts) if total else sums, n2[of[starts]])
    held = np.repeat(np.add.reduceat(counts, starts) if total else counts, n2[of[starts]])
    label = (tag[of].astype(np.uint64) << np.uint64(32)) + (part_of * 4 + place % n2[of]).astype(np.uint64) * np.uint64(4) + np.uint64(cut)
    return mix(mix(whole - sums) + mix(label)), held - counts, of


def _parts(differ: np.ndarray, n2: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parts for a number of differences, and how many empty covers a set can have with them and still
    share one that isn't empty. ``least``: the smallest size of the band, where covers are emptiest."""
    covers = differ + 1.0
    expected = covers * np.exp(-least / covers)
    spare = np.where(n2 == 2, np.ceil(1.3 * expected + 4 * np.sqrt(expected)) + 1, 0).astype(np.int64)
    n1 = np.where(n2 == 2, (differ + 1 + spare + 1) // 2, differ // 2 + 1)
    return n1, np.where(n2 == 2, 2 * n1 - differ - 1, 0)


def signatures(sets: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets in a flat array, and the set each belongs to."""
    size = np.diff(at)
    ends = bands(percent, int(size.max(initial=1)))
    band = np.searchsorted(ends, size, "left")
    found, owners = [], []
    for step in (0, 1):
        tag = band + step
        differ = 2 * ends[tag] * (100 - percent) // (100 + percent)
        # Where no difference is allowed, only equal sets are similar, and those are one already.
        some = np.flatnonzero((size > 0) & (differ > 0))
        n2 = np.where(ends[tag[some]] <= SMALL, 3, 2)
        n1, spare = _parts(differ[some], n2, ends[np.maximum(tag[some] - 2, 0)] + 1)
        members = np.repeat(np.arange(len(some)), size[some])
        before = np.cumsum(size[some]) - size[some]
        elements = sets[np.arange(len(members)) - before[members] + at[:-1][some][members]]
        sign, held, of = _cover_sums(elements, members, n1, n2, tag[some], 0)
        full = held > 0
        found.append(sign[full])
        owners.append(some[of[full]])
        again = np.flatnonzero(np.bincount(of[~full], minlength=len(some)) > spare)
        if len(again):
            chosen = np.isin(members, again)
            sign, _, of = _cover_sums(elements[chosen], np.searchsorted(again, members[chosen]), n1[again], n2[again], tag[some][again], 1)
            found.append(sign)
            owners.append(some[again][of])
    return np.concatenate(found), np.concatenate(owners)


def _set_keys(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = b"".join(hashlib.md5(sets[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return np.frombuffer(found, ">i8").astype(np.int64).reshape(-1, 2)


def _describe(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (doc_id, text): doc_id, key of the set (two numbers), size of the set."""
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in pieces(batches, 1, BLOCK):
            sets, at = shingles(*flat(batch.column(1)), size)
            keys = _set_keys(sets, at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(np.diff(at))], schema=schema)
    return run


_SIGNED = pa.schema([("sign", pa.int64()), ("node", pa.int64()), ("kind", pa.int8())])


def _settle(parts: list[np.ndarray], sent: int) -> Iterator[pa.RecordBatch]:
    rows = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int64)
    if rows.shape[1]:
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        first = np.append(True, rows[0][1:] != rows[0][:-1])
        start = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        nth = np.arange(len(group)) - start[group]
        crowded = np.bincount(group)[group] > sent
        kind = np.where(crowded, np.where(nth < sent, CROWDED, ASIDE), PLAIN).astype(np.int8)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.array(kind)], schema=_SIGNED)


def _sign(size: int, percent: int, sent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (text): signatures of the different sets."""
    def run(batches):
        parts, total, seen = [], 0, set()
        for batch in pieces(batches, 0, BLOCK):
            data, at = flat(batch.column(0))
            sets, offsets = shingles(data, at, size)
            node = _set_keys(sets, offsets)[:, 0]
            fresh = np.zeros(len(node), bool)
            for i, key in enumerate(node.tolist()):
                fresh[i] = key not in seen
                seen.add(key)
            sign, owner = signatures(sets, offsets, percent)
            keep = fresh[owner]
            parts.append(np.stack([sign[keep].view(np.int64), node[owner[keep]]]))
            total += len(data)
            if total >= SETTLE:
                yield from _settle(parts, sent)
                parts, total, seen = [], 0, set()
        yield from _settle(parts, sent)
    return run


_MET = pa.schema([("crowd", pa.int64()), ("pivot", pa.int64()), ("node", pa.int64()), ("kind", pa.int8())])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From signatures in order: each set with the least one it met. ``crowd`` names meetings that
    tasks sent rows aside for; those rows don't know the least one yet."""
    held = np.zeros((3, 0), np.int64)

    def met(rows: np.ndarray) -> pa.RecordBatch:
        aside = rows[2] == ASIDE
        lone = rows[:, aside]
        rows = rows[:, ~aside]
        new = np.append(True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))[:rows.shape[1]]
        crowded_sign = rows[0][rows[2] == CROWDED]
        rows = rows[:, new]
        first = np.append(True, rows[0][1:] != rows[0][:-1])[:rows.shape[1]]
        group = np.cumsum(first) - 1
        pivot = rows[1][np.flatnonzero(first)][group]
        crowded = np.isin(rows[0], crowded_sign)
        name = np.where(crowded, rows[0], 0)
        keep = ~first
        columns = [np.append(name[keep], lone[0]), np.append(pivot[keep], np.zeros(lone.shape[1], np.int64)),
                   np.append(rows[1][keep], lone[1]),
                   np.append(np.where(crowded[keep], CROWDED, PLAIN), np.full(lone.shape[1], ASIDE)).astype(np.int8)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_MET)

    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
        rows = np.concatenate([held, rows], axis=1)
        stop = int(np.searchsorted(rows[0], rows[0][-1], "left")) if rows.shape[1] else 0
        # Sets of one signature are held together; there are at most SENT of them a task and settling.
        if stop:
            yield met(rows[:, :stop])
        held = rows[:, stop:]
    if held.shape[1]:
        yield met(held)


def _fetch(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (node, doc, text): the text, compressed, where it has that set; it is shorter than the set."""
    schema = pa.schema([("node", pa.int64()), ("doc", pa.int64()), ("body", pa.binary())])

    def run(batches):
        for batch in pieces(batches, 2, BLOCK):
            sets, at = shingles(*flat(batch.column(2)), size)
            right = pa.array(_set_keys(sets, at)[:, 0] == batch.column(0).to_numpy())
            body = [zlib.compress(t.as_buffer(), 1) for t in batch.column(2)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(body, pa.binary())], schema=schema)
            yield out.filter(right)
    return run


class _Ties:
    """Which members of a group are known to be connected."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def tie(self, a: int, b: int) -> bool:
        x, y = self.of[a], self.of[b]
        if x == y:
            return False
        self.of[self.of == max(x, y)] = min(x, y)
        return True


def _shared(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many elements each two of the sets share, by products of their incidence matrices."""
    n = len(sets)
    elements, of = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(elements, kind="stable")
    elements, of = elements[order], of[order]
    new = np.append(True, elements[1:] != elements[:-1])[:len(elements)]
    column = np.cumsum(new) - 1
    # What only one set has is shared by none.
    several = np.bincount(column)[column] > 1
    _, column = np.unique(column[several], return_inverse=True)
    of = of[several]
    total = np.zeros((n, n), np.float32)
    for low in range(0, int(column.max(initial=-1)) + 1, columns):
        start, stop = np.searchsorted(column, [low, low + columns])
        part = np.zeros((n, columns), np.float32)
        part[of[start:stop], column[start:stop] - low] = 1
        total += part @ part.T
    return total


def _tied(docs: list[int], blocks: list[int], sets: list[np.ndarray], across: bool, percent: int) -> list[tuple[int, int]]:
    """Enough similar pairs to connect all members of a group that are; ``across``: pairs of different blocks only."""
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        merged = np.sort(np.concatenate(sets), kind="stable")
        shared = np.array([[0, (merged[1:] == merged[:-1]).sum()], [0, 0]])
    else:
        shared = np.triu(_shared(sets), 1)
    near = (shared > 0) & (100 * shared >= percent * (size[:, None] + size[None, :] - shared))
    if across:
        near &= np.array(blocks)[:, None] != np.array(blocks)[None, :]
    ties = _Ties(len(sets))
    return [(docs[a], docs[b]) for a, b in np.argwhere(near).tolist() if ties.tie(a, b)]


def _compare(percent: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (pivot, first, second, block, doc, body) in order of the first three: similar documents."""
    schema = pa.schema([("doc_a", pa.int64()), ("doc_b", pa.int64())])

    def run(batches):
        key, docs, blocks, sets, out = None, [], [], [], []
        for batch in batches:
            heads = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            columns = (batch.column(i).to_pylist() for i in (3, 4, 5))
            for head, block, doc, body in zip(heads, *columns, strict=True):
                if head != key:
                    if len(sets) > 1:
                        out += _tied(docs, blocks, sets, key[1] != key[2], percent)
                    key, docs, blocks, sets = head, [], [], []
                docs.append(doc)
                blocks.append(block)
                text = np.frombuffer(zlib.decompress(body), np.uint8)
                sets.append(shingles(text, np.array([0, len(text)]), size)[0])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                out = []
        if len(sets) > 1 and (out := _tied(docs, blocks, sets, key[1] != key[2], percent)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
    return run


def _links(rows: DataFrame, nodes: DataFrame, size: int, percent: int, sent: int, block: int) -> DataFrame:
    """``doc_a, doc_b`` of similar sets, enough to connect all that are connected."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.when(F.col("kind") == ASIDE, F.xxhash64("sign", "node")).otherwise(F.col("sign"))
    signed = rows.select("text").mapInArrow(_sign(size, percent, sent), "sign long, node long, kind byte")
    met = signed.repartition(parts, key).sortWithinPartitions("sign", "node").mapInArrow(
        _meet, "crowd long, pivot long, node long, kind byte")
    met = stored(met, "met")
    pivots = met.where(F.col("kind") == CROWDED).groupBy("crowd").agg(F.min("pivot").alias("pivot"))
    asides = met.where(F.col("kind") == ASIDE).select("crowd", "node").join(pivots, "crowd")
    pairs = met.where(F.col("kind") != ASIDE).select("pivot", "node").unionByName(asides.select("pivot", "node"))
    pairs = pairs.where("pivot != node").distinct()
    groups = stored(pairs.unionByName(pairs.select("pivot", F.col("pivot").alias("node")).distinct()), "groups")

    wanted = groups.select("node").distinct()
    named = nodes.select(F.col("k1").alias("node"), F.col("rep").alias("doc")).join(wanted, "node")
    texts = named.join(rows.select(F.col("doc_id").alias("doc"), "text"), "doc").select("node", "doc", "text")
    sets = texts.mapInArrow(_fetch(size), "node long, doc long, body binary")
    sets = stored(sets.groupBy("node", "doc").agg(F.min("body").alias("body")), "bodies")

    counts = groups.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks"))
    placed = groups.join(counts, "pivot").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # Every pair of blocks meets once; a group of one block meets itself.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "pivot", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "node")
    met_sets = placed.join(sets, "node").select("pivot", "first", "second", "block", "doc", "body")
    return met_sets.repartition(parts, "pivot", "first", "second").sortWithinPartitions("pivot", "first", "second", "doc").mapInArrow(
        _compare(percent, size), "doc_a long, doc_b long")


def similar_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90,
                   sent: int = SENT, block: int = GROUP) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: size of its set, least id reachable by links.

    Two documents are linked when ``100 * shared >= percent * all`` of their distinct shingles of
    ``size`` words; a shorter text is one shingle, a null text or one without words is linked with
    nothing. Rows with the same id are one document; a null id can't be named, so it is linked with
    nothing and has a null component. Other columns are ignored, an empty table gives no rows.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    light = stored(rows.mapInArrow(_describe(size), "doc_id long, k1 long, k2 long, n long"), "sets")
    named = light.where("n > 0 AND doc_id IS NOT NULL")
    nodes = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    links = _links(rows.where("doc_id IS NOT NULL"), nodes, size, percent, sent, block)
    # Equal sets are linked through the least id among them, very many of them in two steps.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = named.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    firsts = named.groupBy("k1", "k2", "share").agg(F.min("doc_id").alias("first"))
    equal = [named.join(firsts, ["k1", "k2", "share"]).select(F.col("doc_id").alias("doc_a"), F.col("first").alias("doc_b")),
             firsts.join(nodes, ["k1", "k2"]).select(F.col("first").alias("doc_a"), F.col("rep").alias("doc_b"))]
    equal = equal[0].unionByName(equal[1]).where("doc_a != doc_b")
    found = components(stored(links, "similar").unionByName(equal), "doc_a", "doc_b")
    return light.join(found, light.doc_id == found.node, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of similar ones: that with the least id. Rows without
    an id stay; of rows that repeat an id, the one stays whose JSON has the least digest."""
    groups = similar_groups(docs, id, text, size, percent).where("doc_id = component_id").select("doc_id").distinct()
    # The row travels as one, whatever its columns' names.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), row.alias("row"))
    stay = rows.join(groups, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    return stay.select("row.*").unionByName(docs.where(F.col(id).isNull()))
