"""Words and word shingles of many texts at once, as hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; both only touch single ASCII bytes, so the
UTF-8 bytes are worked on as they are.
"""

import numpy as np

from sleeveworks.llm.flatbytes import mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_STEP, _ADD, _ALL = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93), np.uint64(2**64 - 1)


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of the texts in a flat array, and the first word of each text
    (one more entry than texts)."""
    solid = ~_WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    begin = np.flatnonzero(solid & (cut[:-1] | ~np.append(False, solid[:-1])))
    end = np.flatnonzero(solid & (cut[1:] | ~np.append(solid[1:], False))) + 1
    return begin, end, np.searchsorted(begin, at, "left")


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One number per word, lower-cased: eight bytes at a time are mixed in, so that no algebra relates words of equal hash."""
    body = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", body, strides=(1,))
    length = end - begin
    found = mix(length.astype(np.uint64) * _STEP)
    open_ = np.arange(len(begin))
    done = 0
    while len(open_):
        left = np.minimum(length[open_] - done, 8)
        part = eights[begin[open_] + done] & (_ALL >> (64 - 8 * left).astype(np.uint64))
        found[open_] = mix((found[open_] ^ part) * _STEP + _ADD)
        done += 8
        open_ = open_[length[open_] > done]
    return found


def shingles(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles of ``size`` words, sorted, and their offsets by text.

    A text of fewer words has its whole sequence as one shingle; a text without a word has none.
    """
    begin, end, first = word_spans(data, at)
    words = word_hashes(data, begin, end)
    counts = np.diff(first)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), made)
    before = np.cumsum(made) - made
    start = np.arange(int(made.sum())) - before[owner] + first[:-1][owner]
    found = np.zeros(len(start), np.uint64)
    used = np.minimum(counts, size)[owner]
    for k in range(size):
        has = used > k
        found[has] = mix(found[has] * _STEP + words[start[has] + k])
    found = mix(found + used.astype(np.uint64))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))[:len(found)]
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(counts) + 1), "left")
