"""Byte-pair encoding and decoding by a deterministic automaton over tokens.

The automaton accepts a sequence of tokens exactly if it is the encoding of its text. It begins with one
arc per byte from every state to the state named after that byte, and every merge (u, v), in order, adds a gadget:

* a state for the new token uv, which has the arcs that the state of v has at that moment;
* an arc uv from every state that has an arc u, as soon as
* the arc v is taken from the state of u, because u and v in a row are merged from now on.

(For u = v the new state is made before the arc goes, and the new arcs after: ``uuu`` is ``uu u``.) Arcs
are never copied: a state refers to the one that it copies, a token to the one whose arcs it follows, each
as of its gadget, and taken arcs are a table. So the automaton takes three numbers per merge, and an arc is
looked up by a walk through the gadgets, whose answer is remembered.

A merge whose two tokens can't be neighbours by then makes nothing.

Encoding reads a word byte by byte with a second table, the one that spells the labels and knows for each place the
longest label that ends there. Of the labels that end at a place exactly one is reached by an arc, as
the beginning of an encoding is the encoding of the beginning. So there is one state per place, and
the arcs that lead to the end are the encoding. Decoding emits the labels of the arcs.
"""

import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sleeveworks.llm.flatbytes import pieces, ranges

#: Bytes of text worked on at a time, and words and arcs remembered per worker.
BLOCK, REMEMBERED = 1 << 21, 1 << 18
#: Bytes of a word that is spelled together with others.
SHORT = 64

# How byte-level tokenizers split texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters and numbers that Unicode has from version 17 on; to the tokenizers they are neither.
LATER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 "
    "10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 "
    "187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 "
    "1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)


def _later() -> str:
    return "".join("-".join(f"\\U{int(end, 16):08X}" for end in part.split("-")) for part in LATER.split())


def _byte_letters() -> dict[str, int]:
    """The letter each byte is written as: itself where it is printable, else the next letter from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Table:
    """Numbers by key, looked up very many at a time: open addressing, one slot further where a slot is taken."""

    def __init__(self, values: dict[int, int]):
        self._shift = np.uint64(64 - max(2 * len(values), 8).bit_length() - 1)
        self._mask = (1 << (64 - int(self._shift))) - 1
        self._keys, self._values = np.full(self._mask + 1, -1, np.int64), np.full(self._mask + 1, -1, np.int32)
        keys, found = np.array([*values], np.int64), np.array([*values.values()], np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] < 0
            self._keys[slot[free]] = keys[free]
            mine = self._keys[slot] == keys
            self._values[slot[mine]] = found[mine]
            keys, found, slot = keys[~mine], found[~mine], slot[~mine] + 1 & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 where there is none."""
        slot = self._slot(keys)
        there = self._keys[slot]
        out = np.where(there == keys, self._values[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slot[open_] = slot[open_] + 1 & self._mask
            there = self._keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self._values[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out


class _Memory:
    """Ids of words, two generations of them: what is not met any more goes when the younger one is full."""

    def __init__(self, fixed: dict[str, int]):
        self._fixed = fixed
        self._older = None
        self._begin()

    def _begin(self) -> None:
        self._index = {word: k for k, word in enumerate(self._fixed)}
        self._ids = np.array([*self._fixed.values()], np.int32)
        self._sizes = np.ones(len(self._fixed), np.int64)
        self._starts = np.arange(len(self._fixed))

    def _of(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self._sizes[k]
        return self._ids[ranges(self._starts[k], sizes)[0]], sizes

    def __len__(self) -> int:
        return len(self._index)

    def unknown(self, words: Iterable[str]) -> list[str]:
        """The different words that are not remembered; those of the older generation become young again."""
        if len(self._index) >= REMEMBERED:
            self._older = _Memory.__new__(_Memory)
            self._older.__dict__.update(self.__dict__, _older=None)
            self._begin()
        new = [word for word in set(words) if word not in self._index]
        if self._older is not None:
            old = self._older._index
            again = [word for word in new if word in old]
            self.add(again, *self._older._of(np.array([old[word] for word in again], np.int64)))
            new = [word for word in new if word not in old]
        return new

    def add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self._sizes)
        self._index.update(zip(words, range(first, first + len(words))))
        self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(sizes) - sizes])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._ids = np.concatenate([self._ids, ids])

    def forget(self, words: list[str]) -> None:
        for word in words:
            self._index.pop(word, None)

    def look_up(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of words in a row, and where each list's begin."""
        ends = np.cumsum([0, *map(len, split)])
        k = np.fromiter(map(self._index.__getitem__, chain.from_iterable(split)), np.int64, int(ends[-1]))
        ids, sizes = self._of(k)
        return ids, np.concatenate([[0], np.cumsum(sizes)])[ends]


class Automaton:
    """A compiled tokenizer file."""

    def __init__(self, tokenizer: bytes):
        spec = json.loads(tokenizer)
        model, split = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and split and split["type"] == "ByteLevel" and split.get("use_regex", True) and not spec.get("normalizer")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        added = spec.get("added_tokens") or []
        if not plain or odd or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("only byte-level tokenizers without normaliser and other rules are supported")
        self.prefix = bool(split.get("add_prefix_space"))
        letters = _byte_letters()
        vocabulary = model["vocab"]
        states = {letter: b for letter, b in letters.items()}
        #: Labels and outside ids by state; states 0 to 255 are the bytes.
        self.labels = [bytes([b]) for b in range(256)]
        self.ids = [0] * 256
        for letter, b in letters.items():
            self.ids[b] = vocabulary[letter]
        #: Per gadget the state whose arcs it copies, the label whose arcs it follows, and when an arc was taken.
        self.copies, self.follows, self.taken = [0] * 256, [0] * 256, {}
        self._idle: set[int] = set()
        for i, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if left not in states or right not in states or left + right in states:
                raise ValueError("merges must be in order and give each token once")
            self._gadget(i, states[left], states[right])
            states[left + right] = 256 + i
            self.ids.append(vocabulary[left + right])
        self.special = {t["content"]: t["id"] for t in added}
        self._moves, self._back, self._longest, self._shorter = self._spelling()
        self._sizes = [len(label) for label in self.labels]
        # The same tables for very many words at a time, and a memory of arcs: key and answer by slot.
        self._table, self._taken = _Table(self._moves), _Table({u << 32 | v: k for (u, v), k in self.taken.items()})
        self._arrays = [np.array(a, np.int32) for a in (self._back, self._longest, self._shorter, self._sizes, self.copies, self.follows, self.ids)]
        self._seen, self._answer = np.full(REMEMBERED, -1, np.int64), np.zeros(REMEMBERED, bool)
        self._arcs: dict[int, bool] = {}
        self._memory = _Memory(self.special)
        self._words, self._late = regex.compile(WORDS), regex.compile(f"[{_later()}]")
        late = _later()
        self._exact = regex.compile(WORDS.replace(r"\p{L}+", rf"[\p{{L}}--[{late}]]+").replace(r"\p{N}+", rf"[\p{{N}}--[{late}]]+").replace(
            r"[^\s\p{L}\p{N}]+", rf"[[^\s\p{{L}}\p{{N}}]||[{late}]]+"), regex.V1)
        names = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def _gadget(self, i: int, left: int, right: int) -> None:
        """Merge number ``i``."""
        if left in self._idle or right in self._idle or not self._walk(left, right, i):
            self._idle.add(256 + i)
        self.copies.append(right)
        self.follows.append(left)
        self.taken[left, right] = i
        self.labels.append(self.labels[left] + self.labels[right])

    def _spelling(self) -> tuple[dict[int, int], list[int], list[int], list[int]]:
        """Table that spells labels: place and byte to place; the place of the longest proper ending that is a place;
        the state of the longest label that ends there; and of each state, the next shorter label that ends its own."""
        moves, token, ends = {}, [-1], {}
        for state, label in enumerate(self.labels):
            if state in self._idle:
                continue
            at = 0
            for byte in label:
                key = at << 8 | byte
                if key not in moves:
                    moves[key] = len(token)
                    token.append(-1)
                at = moves[key]
            token[at], ends[state] = state, at
        back, longest = [0] * len(token), [-1] * len(token)
        below: dict[int, list[int]] = {}
        for key in moves:
            below.setdefault(key >> 8, []).append(key)
        queue = [0]
        for at in queue:
            longest[at] = token[at] if token[at] >= 0 else longest[back[at]] if at else -1
            for key in below.get(at, ()):
                end = back[at]
                while end and (end << 8 | key & 255) not in moves:
                    end = back[end]
                back[moves[key]] = moves.get(end << 8 | key & 255, 0) if at else 0
                queue.append(moves[key])
        shorter = [-1] * len(self.labels)
        for state, at in ends.items():
            shorter[state] = longest[back[at]]
        return moves, back, longest, shorter

    def has_arc(self, state: int, label: int) -> bool:
        """Whether a token may follow another, after all gadgets."""
        key = state << 32 | label
        found = self._arcs.get(key)
        if found is None:
            found = self._walk(state, label, len(self.labels))
            if len(self._arcs) >= REMEMBERED:
                self._arcs.clear()
            self._arcs[key] = found
        return found

    def _walk(self, state: int, label: int, made: int) -> bool:
        """The same after the first ``made`` gadgets."""
        while True:
            if self.taken.get((state, label), made) < made:
                return False
            if state < 256 and label < 256:
                return True
            # The later of the two came by a gadget: ask for the arc that it copied, as of then.
            if state > label:
                made, state = state - 256, self.copies[state]
            elif label > state:
                made, label = label - 256 + 1, self.follows[label]
            else:
                made, state, label = state - 256, self.copies[state], self.follows[label]

    def path(self, word: bytes) -> list[int]:
        """States on the way through a word."""
        moves, back, longest, shorter, sizes, arcs = self._moves.get, self._back, self._longest, self._shorter, self._sizes, self._arcs.get
        labels, at = [-1], 0
        for byte in word:
            there = moves(at << 8 | byte)
            while there is None:
                at = back[at]
                there = moves(at << 8 | byte)
            at = there
            labels.append(longest[at])
        # Only the places that labels begin at are looked at, from the end on, each once.
        size = len(word)
        reached, wanted = [-1] * (size + 1), [size] if size else []
        while wanted:
            end = wanted[-1]
            label = labels[end]
            start = end - sizes[label]
            if start:
                before = reached[start]
                if before < 0:
                    wanted.append(start)
                    continue
                found = arcs(before << 32 | label)
                if not (self.has_arc(before, label) if found is None else found):
                    labels[end] = shorter[label]
                    continue
            reached[end] = label
            wanted.pop()
        way = []
        while size:
            way.append(reached[size])
            size -= sizes[reached[size]]
        return way[::-1]

    def _have_arcs(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """``has_arc`` of very many pairs."""
        key = state.astype(np.int64) << 32 | label
        slot = (key.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)).astype(np.int64) % REMEMBERED
        out = self._answer[slot]
        unknown = np.flatnonzero(self._seen[slot] != key)
        if not len(unknown):
            return out
        copies, follows = self._arrays[4], self._arrays[5]
        todo, a, b = unknown, state[unknown].astype(np.int64), label[unknown].astype(np.int64)
        made = np.full(len(todo), len(self.labels))
        while len(todo):
            when = self._taken.get(a << 32 | b)
            gone = (when >= 0) & (when < made)
            over = gone | ((a < 256) & (b < 256))
            out[todo[over]] = ~gone[over]
            todo, a, b = todo[~over], a[~over], b[~over]
            made = np.where(a >= b, a - 256, b - 256 + 1)
            a, b = np.where(a >= b, copies[a], a), np.where(b >= a, follows[b], b)
        self._seen[slot[unknown]], self._answer[slot[unknown]] = key[unknown], out[unknown]
        return out

    def paths(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of very many words in a row, and how many each has: byte by byte, the state at every place of every word."""
        back, longest, shorter, sizes, _, _, ids = self._arrays
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        length = np.array([len(words[i]) for i in order], np.int64)
        width = int(length.max(initial=0))
        # Every word in a row of its own, filled up with zeros.
        body = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in order), np.uint8).reshape(len(words), width)
        reached = np.full((len(words), width + 1), -1, np.int32)
        at = np.zeros(len(words), np.int64)
        for end in range(1, width + 1):
            many = int(np.searchsorted(-length, -end, "right"))
            byte = body[:many, end - 1].astype(np.int64)
            there = self._table.get(at[:many] << 8 | byte)
            lost = np.flatnonzero(there < 0)
            while len(lost):
                at[lost] = back[at[lost]]
                there[lost] = self._table.get(at[lost] << 8 | byte[lost])
                lost = lost[there[lost] < 0]
            at[:many] = there
            label = longest[there]
            todo = np.flatnonzero(sizes[label] < end)
            while len(todo):
                wrong = ~self._have_arcs(reached[todo, end - sizes[label[todo]]], label[todo])
                todo = todo[wrong]
                label[todo] = shorter[label[todo]]
                todo = todo[sizes[label[todo]] < end]
            reached[:many, end] = label
        on_way = np.zeros(reached.shape, bool)
        row, end = np.arange(len(words)), length.copy()
        while len(row := row[end > 0]):
            end = end[end > 0]
            on_way[row, end] = True
            end = end - sizes[reached[row, end]]
        # Back into the order of the words.
        counts, place = on_way.sum(axis=1), np.argsort(np.array(order, np.int64), kind="stable")
        spots, _ = ranges((np.cumsum(counts) - counts)[place], counts[place])
        return ids[reached[on_way]][spots], counts[place]

    def _split(self, text: str, exact: bool) -> list[str]:
        """The words of a text, added tokens among them."""
        words = self._exact if exact else self._words
        if not self.prefix and not any(name in text for name in self.special):
            return words.findall(text)
        out = []
        for k, part in enumerate(self._special.split(text) if self._special else [text]):
            if k % 2:
                out.append(part)
            else:
                out += words.findall(" " + part if self.prefix and part and not part[0].isspace() else part)
        return out

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and where each text's begin; names of added tokens in a text are those tokens."""
        split = [self._split(text, False) for text in texts]
        fresh = self._memory.unknown(chain.from_iterable(split))
        joined = "".join(fresh)
        # Words that were told apart wrongly hold a late character, and such words are never remembered.
        late = not joined.isascii() and self._late.search(joined) is not None
        if late:
            split = [self._split(text, not text.isascii() and self._late.search(text) is not None) for text in texts]
            fresh = self._memory.unknown(chain.from_iterable(split))
        spelled = [w.encode() for w in fresh]
        short = [i for i, w in enumerate(spelled) if len(w) <= SHORT]
        ids, sizes = self.paths([spelled[i] for i in short])
        self._memory.add([fresh[i] for i in short], ids, sizes)
        rare = [fresh[i] for i, w in enumerate(spelled) if len(w) > SHORT]
        ways = [self._arrays[6][self.path(w.encode())] for w in rare]
        self._memory.add(rare, np.concatenate([np.zeros(0, np.int32), *ways]), np.array([len(w) for w in ways], np.int64))
        ids, ends = self._memory.look_up(split)
        self._memory.forget(rare + [w for w in fresh if late and self._late.search(w)])
        return ids, ends

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return self.encode_all([text])[0].tolist()


class Labels:
    """The labels that ids emit; all that decoding needs of a tokenizer file."""

    def __init__(self, tokenizer: bytes):
        spec, letters = json.loads(tokenizer), _byte_letters()

        def label(text: str) -> bytes:
            return b"".join(bytes([letters[c]]) if c in letters else c.encode() for c in text)

        self._emitted = {i: label(token) for token, i in spec["model"]["vocab"].items()}
        self._emitted |= {t["id"]: label(t["content"]) for t in spec.get("added_tokens") or []}

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        return b"".join([self._emitted.get(i, b"") for i in ids]).decode("utf-8", "replace")


_compiled: dict[tuple[type, int], Automaton | Labels] = {}


def _machine(kind: type, tokenizer: bytes) -> Automaton | Labels:
    key = kind, hash(tokenizer)
    if key not in _compiled:
        _compiled[key] = kind(tokenizer)
    return _compiled[key]


def _file(spark: SparkSession, path: str):
    """The tokenizer file (a few megabytes, by its vocabulary), read by the driver and sent to every executor once."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _with(df: DataFrame, name: str, kind: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(f"`{name}` {kind}").fields])


def encode(docs: DataFrame, tokenizer_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text's tokens. A null text is empty and has none. A column of ``docs`` named like ``ids`` is
    replaced; rows are independent of each other, so repeated ones have equal ids."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != ids])
    column, file = kept.columns.index(text), _file(docs.sparkSession, tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(Automaton, file.value)
        for batch in pieces(batches, column, BLOCK):
            found, ends = machine.encode_all([t or "" for t in batch.column(column).to_pylist()])
            yield batch.append_column(ids, pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(found)))

    return kept.mapInArrow(run, _with(kept, ids, "array<int>"))


def decode(rows: DataFrame, tokenizer_file: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with the text of the ids; null ids and no ids give an empty text, a null among ids nothing."""
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != text])
    column, file = kept.columns.index(ids), _file(rows.sparkSession, tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(Labels, file.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                yield batch.append_column(text, pa.array([machine.decode(i or []) for i in batch.column(column).to_pylist()], pa.string()))

    return kept.mapInArrow(run, _with(kept, text, "string"))
