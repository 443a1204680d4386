"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model is compiled into three machines: the normaliser (dummy prefix, spaces written as U+2581), the
pieces (a trie whose arcs emit a piece's id), and byte fallback (arcs that emit a character's UTF-8
bytes). An input is composed with them and the path of least weight in the tropical semiring is taken.

In a unigram model an arc weighs minus the piece's score. A byte-pair model has no such weights: its
scores only order merges. There the pieces are composed with a bigram acceptor that lets two pieces
follow each other (weight 0) only if merging their joined text gives back the two, and gives the
rest infinite weight. Merges act in order of score, then place, and whatever crosses a boundary is a
merge of its two neighbours, so a path is accepted exactly if it is the model's own segmentation.

Inputs are cut where no piece can reach across, and the stretches, mostly words, are remembered per
Python worker.
"""

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPACE = "▁"
# Kinds of pieces and of models in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNIGRAM, BYTE_PAIR = 1, 2
#: Stretches remembered per worker.
REMEMBERED = 1 << 19


def _stretches(pieces: Iterable[str]) -> re.Pattern:
    """Finds stretches that no piece reaches across. They end before a run of U+2581, between a letter
    or digit and a mark that no piece has after one, and around characters that are in no longer piece."""
    if not all(p.strip(SPACE) == "" or SPACE not in p.lstrip(SPACE) for p in pieces):
        return re.compile(".+", re.DOTALL)
    pairs = {pair for p in pieces for pair in zip(p, p[1:])}
    joined = {c for pair in pairs for c in pair}
    tied = {c for before, c in pairs if before.isalnum() and not c.isalnum()}
    lone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in joined)
    mark, letter = f"(?:[^\\w{SPACE}{lone}]|_)", "[^\\W_]"
    more = f"(?:[{re.escape(''.join(sorted(tied)))}]{mark}*{letter}*)*" if tied else ""
    ends = [f"{SPACE}+{mark}*{letter}*{more}", f"{mark}+{letter}*{more}", f"{letter}+{more}"]
    return re.compile("|".join(ends + ([f"[{lone}]"] if lone else [])))


class Transducer:
    """A compiled model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap:
            raise ValueError("models that rewrite characters are not supported")
        if proto.trainer_spec.model_type not in (UNIGRAM, BYTE_PAIR):
            raise ValueError("only unigram and byte-pair models are supported")
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.byte_pair = proto.trainer_spec.model_type == BYTE_PAIR
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type not in (UNKNOWN, CONTROL, BYTE)}
        self.scores = {p: proto.pieces[i].score for p, i in self.ids.items()}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        # The longest piece that begins with a character, and with two.
        self.reach: dict[str, int] = {}
        for piece in self.ids:
            for start in {piece[:1], piece[:2]}:
                self.reach[start] = max(self.reach.get(start, 1), len(piece))
        self._written = [self._bytes_of(i) for i in range(len(self.pieces))]
        # Less than any path of pieces could weigh.
        self.fallback_weight = 10.0 - min([s for s in self.scores.values() if s > -1e8], default=0.0)
        self._stretch = _stretches(self.ids)
        self._split = lru_cache(REMEMBERED)(self._last_merge)
        self._spine = lru_cache(REMEMBERED)(self._sides)
        self._follow: dict[tuple[str, str], bool] = {}
        # What was used lately, and before; half of what is remembered is forgotten at a time.
        self._known: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        # Pieces that merging their own characters gives.
        self._whole = {p for p in self.ids if len(p) == 1 or self._split(p)} if self.byte_pair else set()

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = (" " + text) if self.prefix else text
        return text.replace(" ", SPACE) if self.escape else text

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two parts that merging a piece's characters joins last; null if that doesn't give the
        piece. The best score merges first, then the leftmost."""
        parts, last = list(piece), None
        while len(parts) > 1:
            scores = [self.scores.get(x + y, float("-inf")) for x, y in zip(parts, parts[1:])]
            i = scores.index(max(scores))
            if scores[i] == float("-inf"):
                return None
            last = parts[i], parts[i + 1]
            parts[i:i + 2] = ["".join(last)]
        return last

    def _sides(self, piece: str, right: bool) -> list[tuple[str, float]]:
        """The parts at one end of a piece while it is merged, smallest first, with the score that
        made them. Scores fall along the way unless a merge had to wait for a worse one."""
        found, worst = [], float("inf")
        while len(piece) > 1:
            found.append((piece, self.scores[piece]))
            piece = self._split(piece)[1 if right else 0]
        found.append((piece, worst))
        found.reverse()
        made = []
        for part, score in found:
            worst = min(worst, score)
            made.append((part, worst))
        return made

    def _follows(self, first: str, second: str) -> bool:
        """Whether merging the joined text of two pieces leaves the two: no merge across the boundary
        comes before the one that uses up its left or its right side."""
        known = self._follow.get((first, second))
        if known is None:
            left, right, i, j = self._spine(first, True), self._spine(second, False), 0, 0
            none = float("-inf")
            known = True
            while True:
                across = self.scores.get(left[i][0] + right[j][0], none)
                grow_left = left[i + 1][1] if i + 1 < len(left) else none
                grow_right = right[j + 1][1] if j + 1 < len(right) else none
                # Of equal scores the leftmost merges first.
                if across > grow_left and across >= grow_right:
                    known = False
                    break
                if grow_left == none and grow_right == none:
                    break
                if grow_left >= grow_right:
                    i += 1
                else:
                    j += 1
            if len(self._follow) >= REMEMBERED:
                self._follow.clear()
            self._follow[first, second] = known
        return known

    def _arcs(self, text: str, start: int) -> Iterator[tuple[int, float]]:
        """Arcs of the pieces and of byte fallback from a place in a text, the longest first: end, weight."""
        for end in range(self._furthest(text, start), start, -1):
            score = self.scores.get(text[start:end])
            if score is not None:
                yield end, -score
        if text[start] not in self.ids:
            yield start + 1, self.fallback_weight

    def _furthest(self, text: str, start: int) -> int:
        two = self.reach.get(text[start:start + 2], 1)
        return min(start + two, len(text))

    def _least_path(self, text: str) -> list[str]:
        """Pieces along the path of least weight in a unigram model."""
        best = [(0.0, -1)] + [(float("inf"), -1)] * len(text)
        for start in range(len(text)):
            for end, weight in self._arcs(text, start):
                if best[start][0] + weight < best[end][0]:
                    best[end] = best[start][0] + weight, start
        path, place = [], len(text)
        while place:
            path.append(text[best[place][1]:place])
            place = best[place][1]
        return path[::-1]

    def _accepted_path(self, text: str) -> list[str]:
        """Pieces along the only path of finite weight in a byte-pair model. A prefix too has only one,
        so each place is reached with one last piece and entered once."""
        path: list[str] = []
        ends, left, entered, whole, last = [0], [self._furthest(text, 0)], {0}, self._whole, len(text)
        while ends[-1] < last:
            start, end = ends[-1], left[-1]
            while end > start:
                piece = text[start:end]
                if (piece in whole or end == start + 1) and end not in entered and (not path or self._follows(path[-1], piece)):
                    break
                end -= 1
            if end > start:
                # What is left to try here, should this arc lead nowhere.
                left[-1] = end - 1
                entered.add(end)
                path.append(piece)
                ends.append(end)
                left.append(self._furthest(text, end) if end < last else end)
            else:
                ends.pop()
                left.pop()
                path.pop()
        return path

    def _shortest(self, text: str) -> list[str]:
        return self._accepted_path(text) if self.byte_pair else self._least_path(text)

    def _emit(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in piece.encode("utf-8")]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for stretch in self._stretch.findall(self.normalise(text)):
            found = self._known.get(stretch)
            if found is None:
                found = self._older.get(stretch)
                if found is None:
                    found = tuple(i for piece in self._shortest(stretch) for i in self._emit(piece))
                if len(stretch) <= 64:
                    if 2 * len(self._known) >= REMEMBERED:
                        self._older, self._known = self._known, {}
                    self._known[stretch] = found
            out += found
        return out

    def rest(self) -> None:
        """A worker outlives its task; what was not met lately need not wait for the next one."""
        self._older = {}

    def _bytes_of(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == UNKNOWN:
            return " \u2047 ".encode()
        text = "" if self.kinds[i] == CONTROL else self.pieces[i]
        return (text.replace(SPACE, " ") if self.escape else text).encode()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, control pieces nothing."""
        text = b"".join(map(self._written.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_compiled: dict[int, Transducer] = {}


def _transducer(model: bytes) -> Transducer:
    key = hash(model)
    if key not in _compiled:
        _compiled[key] = Transducer(model)
    return _compiled[key]


def _lists(values: list[list[int]]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.fromiter(chain.from_iterable(values), np.int32, int(offsets[-1]))))


def _model(spark, path: str):
    """The model file (below a megabyte), read by the driver and sent to every executor once."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _over_batches(column: int, fields: Callable[[Transducer, list], list[tuple[str, pa.Array]]], model
                  ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        machine = _transducer(model.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                for name, values in fields(machine, batch.column(column).to_pylist()):
                    batch = batch.append_column(name, values)
                yield batch
        machine.rest()
    return run


def encode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids", count: str = "n_ids",
           exact: str = "round_trip") -> DataFrame:
    """``docs`` with the ids of the text's pieces, their number, and whether decoding gives the text back.

    A null text is empty and has no ids. A text that itself holds U+2581 comes back with spaces there, so
    its ``exact`` is false. Columns of ``docs`` that have one of the new names are replaced.
    """
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (ids, count, exact)])

    def fields(machine: Transducer, texts: list) -> list[tuple[str, pa.Array]]:
        found = [machine.encode(t or "") for t in texts]
        same = [machine.decode(i) == (t or "") for i, t in zip(found, texts, strict=True)]
        return [(ids, _lists(found)), (count, pa.array(map(len, found), pa.int64())), (exact, pa.array(same))]

    run = _over_batches(kept.columns.index(text), fields, _model(docs.sparkSession, model_file))
    return kept.mapInArrow(run, _with(kept, {ids: "array<int>", count: "bigint", exact: "boolean"}))


def decode(rows: DataFrame, model_file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the text of the ids; null ids and no ids give an empty text."""
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != text])

    def fields(machine: Transducer, found: list) -> list[tuple[str, pa.Array]]:
        return [(text, pa.array([machine.decode(i or []) for i in found], pa.string()))]

    run = _over_batches(kept.columns.index(ids), fields, _model(rows.sparkSession, model_file))
    return kept.mapInArrow(run, _with(kept, {text: "string"}))


def _with(df: DataFrame, more: dict[str, str]) -> StructType:
    extra = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in more.items()))
    return StructType([*df.schema.fields, *extra.fields])
