import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sleeveworks.llm import jaccard_join
from sleeveworks.llm.words import word_hashes, word_spans


def plain(texts, size, percent):
    sets = []
    for t in texts:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets.append({tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set())
    least = list(range(len(sets)))
    for _ in sets:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets[:a]):
                if x and y and 100 * len(x & y) >= percent * len(x | y):
                    least[a] = least[b] = min(least[a], least[b])
        if least == (least := [least[i] for i in least]):
            break
    return {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, least))}


@pytest.fixture
def texts():
    draw = random.Random(5)
    words = [a + b for a in "abcdefgh" for b in ("x", "É", "zz", "q1")]
    texts = [None, "", " \n", "a", "A", "a b", "a  B", "a b c", "A\tb C"]
    texts += [" ".join(draw.choice(words) for _ in range(draw.randint(0, 30))) for _ in range(25)]
    for n in (9, 12, 20, 45, 90, 300):
        base = [draw.choice(words) for _ in range(n)]
        for _ in range(9):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, n // 25))):
                place = draw.randrange(len(copy))
                copy[place:place + 1] = [draw.choice(words)] * draw.randint(0, 2) or [copy[place]]
            texts.append(draw.choice(" \n").join(copy))
    return texts


# Small limits force the ways for crowded signatures and for groups of many blocks.
@pytest.mark.parametrize("size, percent, sent, block", [(3, 90, 16, 512), (3, 90, 2, 5), (5, 80, 2, 5)])
def test_against_plain(documents, texts, size, percent, sent, block):
    got = jaccard_join.similar_groups(documents(texts), size=size, percent=percent, sent=sent, block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain(texts, size, percent)


def test_one_of_each(documents, texts):
    docs = documents([*texts, "no id " * 9], ids=[*range(len(texts)), None])
    got = jaccard_join.one_of_each(docs)
    assert got.dtypes == docs.dtypes
    firsts = {c for _, c in plain(texts, 5, 80).values()}
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted([*firsts, None], key=str)


def test_nothing_and_nulls(documents):
    assert jaccard_join.similar_groups(documents([])).collect() == []
    got = jaccard_join.similar_groups(documents(["a b c d"] * 4, ids=[None, 7, 7, 3])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 2, None), (7, 2, 3), (7, 2, 3), (3, 2, 3)], key=str)


def test_similar_sets_share_a_signature():
    draw = random.Random(8)
    for percent in (80, 90):
        for n in (10, 11, 19, 40, 200, 700):
            for _ in range(20):
                a = {draw.getrandbits(64) for _ in range(n)}
                b = set(a)
                while True:
                    c = set(b)
                    c.discard(draw.choice(sorted(c)))
                    if draw.random() < 0.5:
                        c.add(draw.getrandbits(64))
                    if 100 * len(a & c) < percent * len(a | c):
                        break
                    b = c
                if a == b:
                    continue
                flat = np.array([*sorted(a), *sorted(b)], np.uint64)
                sign, owner = jaccard_join.signatures(flat, np.array([0, len(a), len(a) + len(b)]), percent)
                assert set(sign[owner == 0].tolist()) & set(sign[owner == 1].tolist())


def thue_morse(n, zero, one):
    word = [0]
    while len(word) < n:
        word += [1 - b for b in word]
    return "".join((zero, one)[b] for b in word[:n])


def test_long_words_of_one_pattern(documents):
    """Words that every polynomial modulo a power of two takes for equal are different words."""
    pairs = [(thue_morse(n, "a", "b"), thue_morse(n, "b", "a")) for n in (1024, 2048, 256)]
    texts = [f"one two {w} three four" for pair in pairs for w in pair]
    got = jaccard_join.similar_groups(documents(texts)).collect()
    assert {r.component_id for r in got} == set(range(len(texts)))


def test_word_hashes():
    """Words are told apart by every byte, wherever they stand, but not by the case of A-Z."""
    words = ["a", "b", "ab", "abcdefgh", "abcdefghi", "abcdefgh\x00", "abcdefgi", "x" * 16, "x" * 17, "é", "É", "q" * 40 + "r", "r" + "q" * 40]
    lines = [words, words[::-1], [w.replace("a", "A").replace("x", "X") for w in words]]
    found = []
    for line in lines:
        data = np.frombuffer(" ".join(line).encode(), np.uint8)
        begin, end, _ = word_spans(data, np.array([0, len(data)]))
        found.append(word_hashes(data, begin, end).tolist())
    assert len(set(found[0])) == len(words) and found[1] == found[0][::-1] and found[2] == found[0]


def test_one_of_repeated_ids(spark, documents):
    """Of rows with one id always the same stays, and columns may be named as they like."""
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents([text, text + " end", "other words " * 30, "x"], ids=[4, 4, 4, None]).withColumn("_first", F.lit("f")).withColumn("row", F.lit("r"))
    kept = [sorted(map(tuple, jaccard_join.one_of_each(docs.repartition(n)).collect()), key=str) for n in (1, 2, 5)]
    assert kept[0] == kept[1] == kept[2] and [r[0] for r in kept[0]] == [4, None] and kept[0][0][-2:] == ("f", "r")
