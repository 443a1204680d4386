"""Stretches of words that repeat with a period, found online, and texts without the repeats.

Every aligned block of 2^k words that is complete is a catcher. It waits for the stretch of 2^k words
that ends at a newly appended word to be equal to it, at a distance between 2^(k+1) - 1 and 2^(k+2) - 2. Any
window as long as such a period holds a block of its level, so every repetition is caught; at each place
two catchers of a level wait at the right distance, so an appended word takes two comparisons of suffixes
per level. Suffixes are compared by hash, the hash of 2^k words being made of two of 2^(k-1). A catch is a
square; where the copies before it agree as well, it is grown in both directions on the words
themselves, which verifies it, and squares of one period that lie in one stretch merge into its run.

A stretch that has a period also has its multiples. Catches of a multiple inside a run that is known are
passed over, and of runs that cover the same stretch the least period stays.

The words may be appended one at a time or very many at once; what is kept of a level's hashes is a few
times its longest period.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sleeveworks.llm.flatbytes import flat, mix, pieces

#: Bytes of text worked on at a time.
BLOCK = 1 << 21
_STEP = np.uint64(0x9FB21C651E98DF25)


def _agreeing(x: np.ndarray, a: int, b: int, limit: int, back: bool = False) -> int:
    """How many words are equal from places ``a`` and ``b`` on, or before them, ``limit`` at most."""
    done, step = 0, 64
    while done < limit:
        size = min(step, limit - done)
        if back:
            differ = x[a - done - size:a - done][::-1] != x[b - done - size:b - done][::-1]
        else:
            differ = x[a + done:a + done + size] != x[b + done:b + done + size]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done, step = done + size, 2 * step
    return limit


class Catchers:
    """Runs among the words appended so far: stretches of at least ``least`` words and ``copies`` periods.

    ``longest`` bounds the length of a run; it is only needed to save work.
    """

    def __init__(self, least: int = 6, copies: int = 4, longest: int | None = None):
        if copies < 2:
            raise ValueError("a run has two copies at least")
        self.least, self.copies, self.longest = least, copies, longest
        self._words, self.n = np.zeros(1024, np.int64), 0
        # Of every level the hashes of the stretches that start at ``base`` and later.
        self._base: list[int] = []
        self._hashes: list[np.ndarray] = []
        self._ends: dict[tuple[int, int], int] = {}
        self._open: list[tuple[int, int]] = []

    def append(self, words: np.ndarray) -> None:
        """Takes the next words, as numbers."""
        before, self.n = self.n, self.n + len(words)
        if self.n > len(self._words):
            room = np.zeros(max(self.n, 2 * len(self._words)), np.int64)
            room[:before] = self._words[:before]
            self._words = room
        self._words[before:self.n] = words
        for period, start in self._open:
            more = _agreeing(self._words, before, before - period, self.n - before)
            self._ends[period, start] = before + more
        self._open = [key for key in self._open if self._ends[key] == self.n]
        level = 0
        while (1 << level) <= self.n and (self.longest is None or (self.copies - 1) * ((2 << level) - 1) + (1 << level) <= self.longest):
            first = self._extend(level, before)
            self._catch(level, first)
            level += 1
        for k in range(level):
            # A level's own catches reach back this far, and so does the next level's hashing.
            drop = len(self._hashes[k]) - self.copies * (4 << k)
            if drop > 0:
                self._hashes[k] = self._hashes[k][drop:].copy()
                self._base[k] += drop

    def _extend(self, level: int, before: int) -> int:
        """Hashes of the stretches completed by the new words; the place of the first."""
        if level == len(self._base):
            self._base.append(0)
            self._hashes.append(np.zeros(0, np.uint64))
        first = self._base[level] + len(self._hashes[level])
        if level == 0:
            fresh = mix(self._words[before:self.n].astype(np.uint64))
        else:
            half, low = self._hashes[level - 1], first - self._base[level - 1]
            size = 1 << (level - 1)
            fresh = mix(half[low:len(half) - size] * _STEP + half[low + size:])
        self._hashes[level] = np.concatenate([self._hashes[level], fresh])
        return first

    def _catch(self, level: int, first: int) -> None:
        hashes, base, size = self._hashes[level], self._base[level], 1 << level
        place = np.arange(max(first, (self.copies - 1) * (2 * size - 1)), base + len(hashes))
        nearest = ((place - (2 * size - 1)) >> level) << level
        caught = []
        for block in (nearest, nearest - size):
            hit = np.flatnonzero((block >= 0) & (hashes[place - base] == hashes[np.maximum(block - base, 0)]))
            block, period = block[hit], place[hit] - block[hit]
            for copy in range(1, self.copies - 1):
                there = block - copy * period
                same = (there >= 0) & (hashes[block - base] == hashes[np.maximum(there - base, 0)])
                block, period = block[same], period[same]
            caught.append(np.stack([period, block]))
        period, block = np.concatenate(caught, axis=1)
        if len(period) and self._ends:
            new = ~self._inside(period, block - (self.copies - 2) * period, block + period + size)
            period, block = period[new], block[new]
        order = np.lexsort((block, period))
        last, reach = 0, 0
        for q, at in zip(period[order].tolist(), block[order].tolist()):
            if q == last and at + q < reach:
                continue
            right = _agreeing(self._words, at, at + q, self.n - at - q)
            left = _agreeing(self._words, at, at + q, at, back=True)
            last, reach = q, at + q + right
            if reach == self.n or reach - at + left >= self.copies * q:
                self._ends[q, at - left] = reach
                if reach == self.n:
                    self._open.append((q, at - left))

    def _inside(self, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether a stretch lies in a known run whose period divides its own."""
        runs = np.array([(s, e, q) for (q, s), e in self._ends.items()], np.int64)
        runs = runs[np.argsort(runs[:, 0], kind="stable")]
        # Two of the runs that begin before the stretch are tried: the last one, and the one that reaches farthest.
        far = np.maximum.accumulate(runs[:, 1])
        farthest = np.maximum.accumulate(np.where(runs[:, 1] == far, np.arange(len(runs)), 0))
        found = np.zeros(len(period), bool)
        last = np.searchsorted(runs[:, 0], start, "right") - 1
        for which in (last, farthest[np.maximum(last, 0)]):
            fits = runs[which]
            found |= (last >= 0) & (fits[:, 1] >= end) & (period > fits[:, 2]) & (period % fits[:, 2] == 0)
        return found

    def runs(self) -> list[tuple[int, int, int]]:
        """``start, length, period`` of all runs, in that order."""
        least: dict[tuple[int, int], int] = {}
        for (period, start), end in self._ends.items():
            if end - start >= max(self.least, self.copies * period):
                least[start, end] = min(period, least.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in least.items())


def _runs_of(texts: list[np.ndarray], least: int, copies: int) -> list[list[tuple[int, int, int]]]:
    """Runs of every text; texts of like length are one stream, with marks between them that equal nothing."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    classes: dict[int, list[int]] = {}
    for i, words in enumerate(texts):
        if len(words) >= least:
            classes.setdefault(len(words).bit_length(), []).append(i)
    for members in classes.values():
        stream = np.concatenate([part for k, i in enumerate(members) for part in (texts[i], np.array([-1 - k]))])
        sizes = np.array([len(texts[i]) for i in members])
        begin = np.cumsum(sizes + 1) - sizes - 1
        catchers = Catchers(least, copies, int(sizes.max()))
        catchers.append(stream)
        for start, length, period in catchers.runs():
            k = int(np.searchsorted(begin, start, "right")) - 1
            found[members[k]].append((start - int(begin[k]), length, period))
    return found


def _without(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        stay = np.ones(len(words), bool)
        for start, length, period in runs:
            stay[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(stay).tolist()]
    return b" ".join(words)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(column: int, names: tuple[str, str, str], least: int, copies: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in pieces(batches, column, BLOCK):
            data, at = flat(batch.column(column))
            body, numbers = data.tobytes(), {}
            texts = [body[a:b].split() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            coded = [np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64) for words in texts]
            runs = _runs_of(coded, least, copies)
            flat_runs = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3).T
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(c) for c in flat_runs], fields=list(_RUN)))
            short = pa.array([_without(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
            for name, values in zip(names, (pa.array([len(w) for w in texts], pa.int64()), listed, short)):
                batch = batch.append_column(name, values)
            yield batch
    return run


def collapse(docs: DataFrame, text: str = "text", count: str = "n_words", runs: str = "runs", collapsed: str = "collapsed",
             least: int = 6, copies: int = 4) -> DataFrame:
    """``docs`` with the number of words, the runs of words, and the text without their repeats.

    A run is a stretch of words with least period q, of ``copies * q`` and ``least`` words at least, that
    no neighbouring word continues: ``start`` (number of its first word), ``length`` and ``period``, in
    words, in this order. Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. Words inside a run
    after its first q are left out of ``collapsed``, whose words are joined by one space.

    A null text has no words, no runs, and collapses to an empty text. Every row is worked on by
    itself, so repeated rows have equal results. Columns of ``docs`` that have one of the new names are replaced.
    """
    new = (count, runs, collapsed)
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    more = StructType.fromDDL(f"`{count}` bigint, `{runs}` array<struct<start:bigint,length:bigint,period:bigint>>, `{collapsed}` string")
    schema = StructType([*kept.schema.fields, *more.fields])
    return kept.mapInArrow(_find(kept.columns.index(text), new, least, copies), schema)
