"""Removal of passages that occur more than once: every byte inside a 200-byte string that also starts
elsewhere in the corpus, found with a hash-compared suffix sort.

Not every suffix is sorted. Each 200-byte window picks an anchor, the 64-byte string with the least
hash in it, so equal windows have equal anchors at equal places. Neighbouring windows with one anchor
form a piece. Pieces are sent by their anchor's hash; most anchors occur once and are done with.

* Equal pieces: all their windows repeat. Equal pieces of one task are settled there, so that a
  passage in very many documents costs one row a task.
* Different pieces around equal anchors: their bytes are fetched and the texts right and left of the
  anchors are sorted as suffixes (``suffix_sort``). Two windows are equal exactly if they start
  equally far left of their anchors, the left contexts agree that far, and so do the right ones.
* Anchors with very many different pieces (the edges of a passage that very many documents share)
  would make one task sort them all. A task that meets many of them sends each on its own way, and
  such anchors are resolved window by window, by the hash of the window, over all tasks.

Texts are known by their MD5, so copies of a whole text are one text with a count. The text itself is
shuffled once; both joins with it read the same exchange.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeveworks.llm.flatbytes import Hashes, flat, mix, pieces, ranges
from sleeveworks.llm.suffix_sort import sort_suffixes
from sleeveworks.session import new_shared_path

#: Bytes of the anchor string.
ANCHOR = 64
#: Bytes hashed at a time, and bytes between settlings of equal pieces within a task.
BLOCK, SETTLE = 1 << 21, 1 << 26
#: Different pieces of one anchor that a task sends to the anchor's own partition, and how many of
#: them are sorted together; with more, the anchor is resolved by windows.
SENT, SORTED = 16, 4096
#: Pieces sorted in one call.
BATCH = 30_000

# A place in a text, packed: start << 24 | windows << 16 | anchor's distance << 8 | flags.
SETTLED, TWICE, CROWDED, ASIDE = 1, 2, 4, 8

_PIECE = "akey long, pkey long, t1 long, t2 long, place long"
_ARROW = pa.schema([(c, pa.int64()) for c in ("akey", "pkey", "t1", "t2", "place")])


def _text_key(text: Column) -> list[Column]:
    """MD5 of a text as two numbers."""
    digest = F.md5(text.cast("binary"))
    half = [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]
    return [half[0].alias("t1"), half[1].alias("t2")]


def _keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = b"".join(hashlib.md5(data[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return np.frombuffer(found, ">i8").astype(np.int64).reshape(-1, 2)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, size = keys, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[:len(out) - (width - size)], out[width - size:]) if size < width else out


def _cut(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Pieces of the texts in a flat array: text, first window, windows, anchor's distance, both hashes."""
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(data) < length:
        return none
    hashes = Hashes(data, 0)
    anchors = mix(hashes.all(ANCHOR))
    low = np.uint64((1 << (len(data).bit_length())) - 1)
    least = _least(anchors & ~low | np.arange(len(anchors), dtype=np.uint64), length - ANCHOR + 1)
    anchor = (least & low).astype(np.int64)
    edges = np.zeros(len(anchor) + 1, np.int64)
    long = np.flatnonzero(np.diff(at) >= length)
    edges[at[long]] += 1
    edges[at[long + 1] - length + 1] -= 1
    window = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
    if not len(window):
        return none
    chosen = anchor[window]
    new = np.ones(len(window), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)
    # Texts that follow each other without a gap of windows can't share an anchor: it lies in the window.
    begin = np.flatnonzero(new)
    start = window[begin]
    count = np.diff(np.append(begin, len(window)))
    spot = chosen[begin]
    whole = Hashes(data, 1).at(start, count + length - 1)
    whole = mix(whole ^ mix((count * 256 + spot - start).astype(np.uint64)))
    text = np.searchsorted(at, start, "right") - 1
    return text, start - at[text], count, spot - start, anchors[spot].view(np.int64), whole.view(np.int64)


def _settle(parts: list[np.ndarray], sent: int = SENT) -> pa.RecordBatch | None:
    """Rows of a task's pieces (akey, pkey, t1, t2, place), equal ones settled: the first goes on as
    a row that counts twice, the others come back as settled. Crowded anchors send rows aside."""
    rows = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
    if not rows.shape[1]:
        return None
    rows = rows[:, np.lexsort((rows[4], rows[3], rows[2], rows[1], rows[0]))]
    akey, pkey = rows[0], rows[1]
    new_a = np.append(True, akey[1:] != akey[:-1])
    new_p = new_a | np.append(True, pkey[1:] != pkey[:-1])
    last_p = np.append(new_p[1:], True)
    flags = np.where(new_p, np.where(last_p, 0, TWICE), SETTLED)
    group = np.cumsum(new_a) - 1
    kinds = np.cumsum(new_p)
    nth = kinds - kinds[np.flatnonzero(new_a)][group]
    crowded = np.bincount(group, new_p)[group] > sent
    flags |= np.where(crowded & (flags != SETTLED), np.where(nth < sent, CROWDED, ASIDE), 0)
    rows[4] |= flags
    return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], schema=_ARROW)


def _find_pieces(length: int, sent: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        parts, size, seen = [], 0, set()
        for batch in pieces(batches, 0, block):
            data, at = flat(batch.column(0))
            keys = _keys(data, at)
            fresh = np.zeros(len(keys), bool)
            for i, key in enumerate(map(tuple, keys.tolist())):
                fresh[i] = key not in seen
                seen.add(key)
            # A text longer than a block is cut into overlapping ones, which splits pieces but loses none.
            for first in range(0, max(len(data) - length + 1, 1), block) if len(keys) == 1 else [0]:
                end = min(first + block + length - 1, len(data)) if len(keys) == 1 else len(data)
                part = np.array([0, end - first]) if len(keys) == 1 else at
                text, start, count, spot, akey, pkey = _cut(data[first:end], part, length)
                keep = fresh[text]
                place = ((start + first) << 24 | count << 16 | spot << 8)[keep]
                parts.append(np.stack([akey[keep], pkey[keep], *keys[text[keep]].T, place]))
            size += len(data)
            if size >= SETTLE:
                if (rows := _settle(parts, sent)) is not None:
                    yield rows
                parts, size, seen = [], 0, set()
        if (rows := _settle(parts, sent)) is not None:
            yield rows
    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list | None]]:
    """Sorted rows in portions that end where an anchor ends: columns, and bodies if there are any."""
    held, bodies = np.zeros((5, 0), np.int64), []
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
        rows = np.concatenate([held, rows], axis=1)
        if batch.num_columns > 5:
            bodies = bodies + batch.column(5).to_pylist()
        stop = int(np.searchsorted(rows[0], rows[0][-1], "left")) if rows.shape[1] else 0
        # Rows of one anchor are held together; there are at most SENT of them a task and settling.
        if stop:
            yield rows[:, :stop], bodies[:stop]
        held, bodies = rows[:, stop:], bodies[stop:]
    if held.shape[1]:
        yield held, bodies


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled places, and the places whose bytes are needed: all different pieces of an anchor."""
    for rows, _ in _groups(batches):
        flags = rows[4] & 255
        done = (flags & SETTLED) > 0
        settled = [rows[:, done]]
        rows = rows[:, ~done]
        if rows.shape[1]:
            akey, pkey, place = rows[0], rows[1], rows[4]
            flags = place & 255
            new_a = np.append(True, akey[1:] != akey[:-1])
            new_p = new_a | np.append(True, pkey[1:] != pkey[:-1])
            group, kind = np.cumsum(new_a) - 1, np.cumsum(new_p) - 1
            twice = (np.bincount(kind)[kind] > 1) | (np.bincount(kind, (flags & TWICE) > 0)[kind] > 0)
            kinds = np.bincount(group, new_p)[group]
            open_kinds = np.bincount(group, new_p & ~twice)[group]
            crowd = (np.bincount(group, (flags & (CROWDED | ASIDE)) > 0)[group] > 0) | (kinds > SORTED)
            asked = new_p & (crowd | ((kinds > 1) & (open_kinds > 0)))
            base = place & ~np.int64(255)
            for mark, which in ((SETTLED, twice), (CROWDED, asked & crowd), (0, asked & ~crowd)):
                part = rows[:, which].copy()
                part[4] = base[which] | mark
                settled.append(part)
        out = np.concatenate(settled, axis=1)
        if out.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in out], schema=_ARROW)


_BODY = pa.schema([*_ARROW, ("body", pa.binary())])


def _fetch(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (t1, t2, text, places): pieces with their bytes, and windows of crowded anchors."""
    def bodies(rows: list[tuple], data: list[bytes]) -> pa.RecordBatch:
        columns = np.array(rows, np.int64).reshape(-1, 5).T
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(data, pa.binary())], schema=_BODY)

    def windows(crowd: list[tuple], data: list[bytes]) -> np.ndarray:
        columns = np.array(crowd, np.int64).T
        body = np.frombuffer(b"".join(data), np.uint8)
        size = np.array([len(d) for d in data])
        offset = np.cumsum(size) - size
        spots, owner = ranges(offset, size - length + 1)
        first, second = (mix(Hashes(body, w).at(spots, length)).view(np.int64) for w in (2, 3))
        place = ((columns[4][owner] >> 24) + spots - offset[owner]) << 24 | 1 << 16
        return np.stack([first, second, columns[2][owner], columns[3][owner], place])

    def without_body(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, pa.binary())], schema=_BODY)

    def run(batches):
        rows, data, crowd, crowd_data, parts, size = [], [], [], [], [], 0
        for batch in pieces(batches, 2, BLOCK):
            flat_text, at = flat(batch.column(2))
            t1, t2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            places = batch.column(3).to_pylist()
            for i in range(batch.num_rows):
                for item in places[i]:
                    place = item["place"]
                    start = at[i] + (place >> 24)
                    body = flat_text[start:start + ((place >> 16) & 255) + length - 1].tobytes()
                    if place & CROWDED:
                        crowd.append((0, 0, t1[i], t2[i], place))
                        crowd_data.append(body)
                    else:
                        rows.append((item["akey"], 0, t1[i], t2[i], place))
                        data.append(body)
            if rows:
                yield bodies(rows, data)
                rows, data = [], []
            while crowd:
                parts.append(windows(crowd[:BATCH], crowd_data[:BATCH]))
                crowd, crowd_data = crowd[BATCH:], crowd_data[BATCH:]
                size += parts[-1].shape[1]
            if size >= SETTLE // 64:
                yield without_body(_settle(parts))
                parts, size = [], 0
        if parts:
            yield without_body(_settle(parts))
    return run


def _repeating(rows: np.ndarray, bodies: list[bytes], length: int) -> np.ndarray:
    """Places of the windows that another piece of their anchor also has."""
    n = rows.shape[1]
    group = np.cumsum(np.append(True, rows[0][1:] != rows[0][:-1])) - 1
    count, spot = (rows[4] >> 16) & 255, (rows[4] >> 8) & 255
    body = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(b) for b in bodies])
    offset = np.cumsum(size) - size
    reach = length - ANCHOR
    right, right_ext = sort_suffixes(body, offset + spot + ANCHOR, size - spot - ANCHOR, group)
    # Left contexts are read backwards from the anchor.
    left, left_ext = sort_suffixes(body[::-1].copy(), len(body) - offset - spot, spot, group)
    first = np.append(True, group[1:] != group[:-1])
    found = np.zeros((n, reach + 1), bool)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for back in range(reach + 1):
        has = np.flatnonzero((spot >= back) & (spot - count < back))
        if not len(has):
            continue
        left_class[left] = np.cumsum(first | (left_ext < back))
        right_class[right] = np.cumsum(first | (right_ext < reach - back))
        both = left_class[has] * (n + 1) + right_class[has]
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        found[has[order], back] = np.append(same, False) | np.append(False, same)
    piece, back = np.nonzero(found[:, ::-1])
    if not len(piece):
        return np.zeros((5, 0), np.int64)
    window = spot[piece] - (reach - back)
    new = np.append(True, (piece[1:] != piece[:-1]) | (window[1:] != window[:-1] + 1))
    begin = np.flatnonzero(new)
    runs = np.diff(np.append(begin, len(piece)))
    owner = piece[begin]
    out = rows[:, owner].copy()
    out[4] = ((rows[4][owner] >> 24) + window[begin]) << 24 | runs << 16 | SETTLED
    return out


def _resolve(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def out(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(r) for r in rows[2:]], schema=_SPAN)

    def run(batches):
        held, bodies, size = [], [], 0
        for rows, found in _groups(batches):
            with_body = np.array([b is not None for b in found])
            single = rows[:, ~with_body]
            if single.shape[1]:
                new = np.append(True, (single[:2, 1:] != single[:2, :-1]).any(axis=0))
                kind = np.cumsum(new) - 1
                flags = single[4] & 255
                live = (flags & SETTLED) == 0
                again = (np.bincount(kind, live)[kind] > 1) | (np.bincount(kind, (flags & TWICE) > 0)[kind] > 0)
                if ((again & live) | ~live).any():
                    yield out(single[:, (again & live) | ~live])
            if with_body.any():
                held.append(rows[:, with_body])
                bodies += [b for b in found if b is not None]
                size += held[-1].shape[1]
            if size >= BATCH:
                yield out(_repeating(np.concatenate(held, axis=1), bodies, length))
                held, bodies, size = [], [], 0
        if held:
            yield out(_repeating(np.concatenate(held, axis=1), bodies, length))
    return run


_SPAN = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("place", pa.int64())])
_TEXT = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("text", pa.string())])


def _distinct_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their keys; copies that follow within SETTLE bytes are left out."""
    seen, size = set(), 0
    for batch in pieces(batches, 0, BLOCK):
        data, at = flat(batch.column(0))
        keys = _keys(data, at)
        keep = []
        for i, key in enumerate(map(tuple, keys.tolist())):
            if key not in seen:
                seen.add(key)
                keep.append(i)
        taken = pa.array(keep, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[keep, 0]), pa.array(keys[keep, 1]), batch.column(0).take(taken).cast(pa.string())], schema=_TEXT)
        size += len(data)
        if size >= SETTLE:
            seen, size = set(), 0


def _erase(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (t1, t2, text, places): removed bytes, spans, hash of what is left, and the rest as text."""
    schema = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("kept", pa.string())])

    def run(batches):
        for batch in pieces(batches, 2, BLOCK):
            data, at = flat(batch.column(2))
            places = batch.column(3)
            which = np.repeat(np.arange(batch.num_rows), np.diff(places.offsets.to_numpy()))
            place = places.flatten().to_numpy()
            start, count = place >> 24, (place >> 16) & 255
            edges = np.zeros(len(data) + 1, np.int64)
            begin = at[which] + start
            np.add.at(edges, begin, 1)
            np.add.at(edges, begin + count + length - 1, -1)
            gone = np.cumsum(edges[:-1]) > 0
            head = gone & ~np.append(False, gone[:-1])
            # A text may begin removed right after one that ends so.
            filled = at[:-1][at[:-1] < at[1:]]
            head[filled] = gone[filled]
            removed, spans = (np.concatenate([[0], np.cumsum(x)])[at] for x in (gone, head))
            kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(np.diff(removed)), pa.array(np.diff(spans)),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())], schema=schema)
    return run


def _texts_without_repeats(docs: DataFrame, text: str, length: int, sent: int, block: int) -> DataFrame:
    """``t1, t2, n_removed, n_spans, kept_sha256, kept`` of each text of which something goes."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.octet_length("text") >= length)
    flag = F.col("place").bitwiseAND(F.lit(255))
    own = F.when(flag.bitwiseAND(F.lit(SETTLED)) > 0, F.xxhash64("t1", "t2")) \
        .when(flag.bitwiseAND(F.lit(ASIDE)) > 0, F.xxhash64("akey", "pkey")).otherwise(F.col("akey"))
    sent = body.mapInArrow(_find_pieces(length, sent, block), _PIECE).repartition(parts, own).sortWithinPartitions("akey", "pkey")
    path = new_shared_path(spark, "places")
    sent.mapInArrow(_answers, _PIECE).write.parquet(path)
    answers = spark.read.schema(_PIECE).parquet(path)
    asked = answers.where(flag.bitwiseAND(F.lit(SETTLED)) == 0).groupBy("t1", "t2").agg(
        F.collect_list(F.struct("akey", "place")).alias("places"))
    texts = body.mapInArrow(_distinct_texts, "t1 long, t2 long, text string")
    columns = f"{_PIECE}, body binary"
    key = F.when(F.col("body").isNull() & (flag.bitwiseAND(F.lit(SETTLED)) > 0), F.xxhash64("t1", "t2")) \
        .when(flag.bitwiseAND(F.lit(ASIDE)) > 0, F.xxhash64("akey", "pkey")).otherwise(F.col("akey"))
    fetched = texts.join(asked, ["t1", "t2"]).select("t1", "t2", "text", "places").mapInArrow(_fetch(length), columns)
    resolved = fetched.repartition(parts, key).sortWithinPartitions("akey", "pkey").mapInArrow(
        _resolve(length), "t1 long, t2 long, place long")
    settled = answers.where(flag.bitwiseAND(F.lit(SETTLED)) > 0).select("t1", "t2", "place")
    spans = settled.unionByName(resolved).groupBy("t1", "t2").agg(F.collect_list("place").alias("places"))
    return texts.join(spans, ["t1", "t2"]).select("t1", "t2", "text", "places").mapInArrow(
        _erase(length), "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string, kept string")


def _with_copies(docs: DataFrame, text: str, length: int, sent: int = SENT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Keys of the rows' texts, and per key the copies and what is removed (null: nothing is)."""
    keyed = docs.select("*", *_text_key(F.coalesce(F.col(text), F.lit(""))))
    copies = keyed.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"))
    erased = _texts_without_repeats(docs, text, length, sent, block)
    # Rows of a text that has copies may come from several tasks; all of such a text goes anyway.
    single = copies.where("copies = 1").join(erased, ["t1", "t2"]).withColumn("copies", F.lit(1).cast("long"))
    many = copies.where("copies > 1")
    return keyed, single.unionByName(many, allowMissingColumns=True)


def removal_report(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 200,
                   sent: int = SENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A null text is empty; texts below ``length`` lose nothing; a text with copies, also in a repeated
    row, loses everything. Spans are maximal runs of removed bytes. Other columns are ignored, an
    empty table gives no rows. Null ids are ids like any other.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed, results = _with_copies(rows, "text", length, sent, block)
    light = keyed.select("doc_id", "t1", "t2", F.octet_length("text").cast("long").alias("n_bytes"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("_sha"))
    joined = light.join(results.drop("kept"), ["t1", "t2"], "left")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return joined.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, text: str = "text", chars: str = "n_chars", length: int = 200) -> DataFrame:
    """``docs`` with repeated passages cut from the text; ``chars``, where present, follows the text.

    Bytes of a character that is cut in two are dropped. Rows stay, also those left without text; a
    null text stays null.
    """
    # Other columns travel as one, whatever their names.
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(0).alias("none")])
    keyed, results = _with_copies(docs.select(rest.alias("rest"), F.col(text).alias("text")), "text", length)
    joined = keyed.join(results.select("t1", "t2", "copies", "kept"), ["t1", "t2"], "left")
    copied = (F.col("copies") > 1) & (F.octet_length("text") >= length)
    cut = F.when(copied, F.lit("")).otherwise(F.coalesce("kept", "text"))
    out = joined.select("rest", cut.alias("text"))
    columns = {c: F.col(f"rest.`{c}`") for c in docs.columns if c != text} | {text: F.col("text")}
    if chars in docs.columns and chars != text:
        columns[chars] = F.coalesce(F.length("text").cast(docs.schema[chars].dataType), columns[chars])
    return out.select(*[columns[c].alias(c) for c in docs.columns])
