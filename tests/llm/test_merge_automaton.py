"""Byte-pair ids against the public library, and the automaton against merging by hand."""

import hashlib
import itertools
import json
import random

import pytest
from tokenizers import Tokenizer

from sleeveworks.llm import merge_automaton as M
from sleeveworks.llm.queries import TOKENIZERS, op11_merge_automaton

FILE = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def machine():
    with open(FILE, "rb") as file:
        return M.Automaton(file.read())


@pytest.fixture(scope="module")
def labels():
    with open(FILE, "rb") as file:
        return M.Labels(file.read())


def tokenizer(merges, added=(), **changes):
    """A tokenizer file with all bytes and the given merges."""
    tokens = [*M._byte_letters(), *dict.fromkeys(a + b for a, b in merges)]
    spec = {"model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": [list(m) for m in merges]},
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "normalizer": None,
            "added_tokens": [{"id": len(tokens) + i, "content": t, "lstrip": False, "rstrip": False, "single_word": False, "normalized": False}
                             for i, t in enumerate(added)]}
    return json.dumps(spec | changes).encode()


def merged(word, merges):
    """Each merge in order, over the whole word from left to right."""
    tokens = list(word)
    for a, b in merges:
        out, i = [], 0
        while i < len(tokens):
            pair = tokens[i:i + 2] == [a, b]
            out.append(a + b if pair else tokens[i])
            i += 2 if pair else 1
        tokens = out
    return tokens


def test_automaton_of_random_merges():
    draw = random.Random(1)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < draw.randint(1, 12):
            pair = draw.choice(tokens), draw.choice(tokens)
            if "".join(pair) not in tokens:
                merges.append(pair)
                tokens.append("".join(pair))
        automaton = M.Automaton(tokenizer(merges))
        labels = [label.decode("latin-1") for label in automaton.labels]
        for size in range(1, 8):
            for word in map("".join, itertools.product("abc", repeat=size)):
                assert [labels[s] for s in automaton.path(word.encode())] == merged(word, merges), (merges, word)
        # The automaton accepts exactly the encodings.
        state = {label: s for s, label in enumerate(labels)}
        for parts in itertools.product(tokens, repeat=2):
            accepted = automaton.has_arc(*map(state.get, parts))
            if all(merged(t, merges) == [t] for t in parts):
                assert accepted == (merged("".join(parts), merges) == list(parts)), (merges, parts)


POOL = ["a", "b", "ab", "the", " ", "  ", "\n", "é", "日本", "1", "23", "'s", "'re", "!", "...", "==", "    ", "<|endoftext|>", "ſ", "İ", "՘",
        "\U0003d000", "\x85", "​", "é", "🙂", "aaaa", "\t", "\r\n", "'", "᛾"]


def test_library(library, machine, labels):
    draw = random.Random(2)
    texts = ["".join(draw.choice(POOL) for _ in range(draw.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(chr(draw.choice([draw.randint(0, 0x2FF), draw.randint(0, 0xD7FF), draw.randint(0xE000, 0x10FFFF)])) for _ in range(20))
              for _ in range(2000)]
    texts += ["".join(draw.choice("ab =-") for _ in range(draw.randint(0, 80))) for _ in range(1000)]
    texts += ["a" * 20_000, " " * 5000, "ab" * 9000 + "!", "<|endoftext|><|endoftext|>x<|endoftext", "".join(map(chr, range(0x500, 0x900)))]
    flat, ends = machine.encode_all(texts)
    for text, a, b in zip(texts, ends, ends[1:]):
        ids = flat[a:b].tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert labels.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    for _ in range(500):
        ids = [draw.randint(0, 50256) for _ in range(draw.randint(1, 12))]
        assert labels.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_memory_is_bounded(library, monkeypatch):
    """Words that went are spelled again, those that come again stay; long ones and late ones are not kept."""
    monkeypatch.setattr(M, "REMEMBERED", 60)
    with open(FILE, "rb") as file:
        machine = M.Automaton(file.read())
    texts = [" ".join(f"{chr(97 + i % 26)}{i * 7919 % 100_003}" for i in range(k, k + 50)) for k in range(0, 500, 25)]
    assert [machine.encode(t) for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(machine._memory) < 60 + 110
    for text in ["x" * 200, "\u0558a", "a\u0558 b", "\u0558"]:
        assert machine.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert not any(len(w) > 64 or "\u0558" in w for w in machine._memory._index)


def test_other_files(library):
    file = tokenizer([("a", "b")], added=["[x]", "[x][y]"])
    added = M.Automaton(file)
    assert added.encode("ab[x][y]a[x]") == [256, 258, added.ids[97], 257] and M.Labels(file).decode([256, 258, 7777]) == "ab[x][y]"
    prefixed = M.Automaton(tokenizer([("Ġ", "a")], pre_tokenizer={"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}))
    assert prefixed.encode("a") == [256] and prefixed.encode(" a") == [256] and prefixed.encode("") == []
    for changes in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError):
            M.Automaton(tokenizer([], **changes))
    with pytest.raises(ValueError):
        M.Automaton(tokenizer([("ab", "a")]))


def test_frames(spark, documents, library, prose):
    texts = [None, "", " ", "<|endoftext|>", prose(1, 30), prose(1, 30), prose(2, 20_000), "é" * 3]
    docs = documents(texts)
    got = M.decode(M.encode(docs, FILE), FILE, text="back").collect()
    assert len(got) == len(texts) and all(r.size == "x" for r in got)
    for r in got:
        assert r.ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids and r.back == (texts[r.doc_id] or "")
    assert M.encode(documents([]), FILE).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 65])], "k int, ids array<int>")
    assert sorted((r.k, r.text) for r in M.decode(odd, FILE).collect()) == [(1, ""), (2, ""), (3, "ab")]


def test_query(spark, documents, library, prose, tmp_path):
    texts = [None, "", "a <|endoftext|> b", *(prose(i, 40) for i in range(8))]
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    for r in op11_merge_automaton(spark, str(tmp_path)).collect():
        text = texts[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
