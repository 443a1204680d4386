"""Runs of words against all periods tried one by one."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sleeveworks.llm import periodic_runs as P


def plain(words, least=6, copies=4):
    """Every maximal stretch of every period, those with a smaller period left out."""
    n, found = len(words), {}
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, copies * q):
                found.setdefault((start, length), q)
    return sorted((s, n_, q) for (s, n_), q in found.items())


def made(draw, n):
    """Words with runs of all kinds: periodic parts, parts of parts, copies cut short."""
    out = []
    while len(out) < n:
        part = [draw.randint(0, draw.choice([1, 2, 50])) for _ in range(draw.choice([1, 2, 3, 5, 7, 8, 15, 16, 30]))]
        if draw.random() < 0.3:
            part = part * draw.randint(2, 6) + part[:draw.randint(0, len(part))]
        out += part * draw.randint(1, 7) + part[:draw.randint(0, len(part))]
    return out[:n]


@pytest.mark.parametrize("copies", [2, 3, 4])
def test_catchers(copies):
    draw = random.Random(copies)
    for trial in range(150):
        words = made(draw, draw.randint(0, 400))
        at_once = P.Catchers(copies=copies)
        at_once.append(np.array(words, np.int64))
        assert at_once.runs() == plain(words, copies=copies)
        parts = P.Catchers(copies=copies)
        i = 0
        while i < len(words):
            step = 1 if trial % 2 else draw.randint(1, 60)
            parts.append(np.array(words[i:i + step], np.int64))
            i += step
        assert parts.runs() == at_once.runs()


def test_every_prefix():
    """Runs are known as soon as their last word is."""
    words, online = made(random.Random(7), 160), P.Catchers()
    for i, word in enumerate(words):
        online.append(np.array([word]))
        assert online.runs() == plain(words[:i + 1])


def test_hashes_are_reduced():
    online = P.Catchers()
    for _ in range(300):
        online.append(np.arange(online.n, online.n + 100))
    assert all(len(h) <= 4 * (4 << k) for k, h in enumerate(online._hashes)) and online.runs() == []


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_texts(spark, documents):
    draw = random.Random(3)
    white = [" ", "\n", "\t ", "\r\n", "\x0b", "\x0c"]
    texts = [draw.choice(white).join(f"w{i}é" for i in made(draw, draw.randint(0, 300))) for _ in range(60)]
    texts += ["", None, " \n ", "a " * 5, "a " * 6, "A a " * 20, "x", "long " * 100_000 + "end", "  " * 8, texts[0], texts[0]]
    docs = documents(texts).withColumn("runs", F.lit("r")).withColumn("start", F.lit("s"))
    got = P.collapse(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        words = [w.decode() for w in (texts[r.doc_id] or "").encode().split()]
        runs = plain(words) if len(words) < 1000 else [(0, 100_000, 1)]
        assert (r.n_words if isinstance(r.n_words, int) else -1) == len(words) and r.start == "s"
        assert [tuple(x) for x in r.runs] == runs and r.collapsed == collapsed(words, runs)
    assert P.collapse(documents([])).collect() == []


def test_query(spark, documents, tmp_path, prose):
    """The registered query, with the words that it plants, against the plain version."""
    import hashlib

    from sleeveworks.llm.queries import op12_periodic_runs

    draw = random.Random(5)
    texts = [None, "", "one", *(prose(i, draw.randint(1, 200), draw.choice([" ", "\n\t"])) for i in range(120)), "b a " * 40]
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    planted = 0
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        words = [w.decode() for w in words]
        runs = plain(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(words, runs))]
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period, r.runs_sha256, r.collapsed_sha256) == (len(runs), *best, *sha)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert planted > 5
