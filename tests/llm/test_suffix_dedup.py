import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sleeveworks.llm import suffix_dedup, suffix_sort


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.append(False, gone).astype(int)) > 0).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return out


@pytest.fixture
def texts(prose):
    base, passage = prose(1, 150), prose(2, 50)
    texts = [None, "", "a", "x" * 500, "x" * 199, "x" * 200, "ab" * 300, base, base, base + base, base[100:600], base]
    texts += [prose(s, 20) + " " + passage + "\n" + prose(s + 500, 15) for s in range(10, 50)]
    texts += [prose(s, 4) + passage[:240] + prose(s + 700, 4) for s in range(100, 130)]
    for s in range(25):
        draw, words = random.Random(s), base.split(" ")
        for _ in range(draw.randint(0, 5)):
            words[draw.randrange(len(words))] = f"Z{draw.randint(0, 4)}"
        texts.append(" ".join(words))
    return texts + [prose(s, 60) for s in range(200, 215)]


# Few rows sent per anchor and small blocks force the ways for crowded anchors and long texts.
@pytest.mark.parametrize("sent, block", [(16, 1 << 21), (2, 700)])
def test_against_plain(documents, texts, sent, block):
    want = {i: row[:4] for i, row in enumerate(plain(texts, 200))}
    got = suffix_dedup.removal_report(documents(texts), sent=sent, block=block).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want


def test_texts_without_repeats(documents, texts):
    docs = documents(texts)
    got = suffix_dedup.without_repeats(docs)
    assert got.dtypes == docs.dtypes
    rows = {r.doc_id: r for r in got.collect()}
    for i, row in enumerate(plain(texts, 200)):
        assert (rows[i].text or "") == row[4] and rows[i].n_chars == len(row[4])


def test_nothing(documents):
    assert suffix_dedup.removal_report(documents([])).collect() == []
    assert [r[1:] for r in suffix_dedup.removal_report(documents([None], ids=[None])).collect()] == [
        (0, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_sort_of_suffixes():
    draw = random.Random(4)
    data = np.array([draw.randrange(3) for _ in range(4000)], np.uint8)
    start = np.array(sorted(draw.randrange(3900) for _ in range(600)))
    length = np.array([draw.randrange(0, 90) for _ in start])
    group = np.sort(np.array([draw.randrange(20) for _ in start]))
    order, extension = suffix_sort.sort_suffixes(data, start, length, group)
    suffix = [(g, data[s:s + n].tobytes()) for g, s, n in zip(group.tolist(), start, length)]
    assert [suffix[i] for i in order] == sorted(suffix)
    for k in range(1, len(order)):
        (g, a), (h, b) = suffix[order[k - 1]], suffix[order[k]]
        common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert extension[k] == (common if g == h else -1)


def test_collisions_are_noticed(monkeypatch):
    """With hashes that agree too often the order is found with another base, or not at all."""
    real = suffix_sort.Hashes.at
    monkeypatch.setattr(suffix_sort.Hashes, "at", lambda self, s, n: real(self, s, n) & np.uint64(1))
    data = np.arange(200, dtype=np.uint8)
    with pytest.raises(ArithmeticError):
        suffix_sort.sort_suffixes(data, np.arange(50), np.full(50, 40), np.zeros(50, int))
