"""Sharding, quality rules, host reputation, raking, toxicity, licenses and pieces."""

import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sleeveworks.llm import host_reputation, license_scan, line_cleaning, piece_transducer, raking, sharding, toxicity
from sleeveworks.llm.flatbytes import flat
from sleeveworks.llm.queries import TOKENIZERS

MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"


def test_shards(documents):
    texts = [None, "", "é", "same", "same", *(f"text {i}" for i in range(300))]
    got = sharding.interleave(documents(texts), shards=7).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    counts = [len(v) for v in by_shard.values()]
    assert sorted(by_shard) == list(range(7)) and max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by_shard.values())
    # Every shard has each source's share, give or take one row a source.
    total = Counter(r.source for r in got)
    for v in by_shard.values():
        for source, n in Counter(r.source for r in v).items():
            assert abs(n - total[source] / 7) <= 2
    # The order in a source is a shuffle, by fractional rank over all.
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    seen = Counter()
    ranks = []
    for r in order:
        seen[r.source] += 1
        ranks.append(Fraction(2 * seen[r.source] - 1, 2 * total[r.source]))
    assert ranks == sorted(ranks)
    assert [r.doc_id for r in order if r.source == "a"] != sorted(r.doc_id for r in order if r.source == "a")


def test_shards_of_few_rows(documents):
    assert sharding.interleave(documents([])).collect() == []
    got = sharding.interleave(documents(["x", "x"], ids=[None, None])).collect()
    assert len(got) == 2 and sorted(r.slot for r in got) == [0, 0]


def repeat_words(words):
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    return len({j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)})


def test_quality_rules(documents, prose):
    clean = "\n".join(prose(s, 12) + "." for s in range(4))
    junk = "\n".join(" ".join(w + "###" for w in prose(s, 12).split()) for s in range(9))
    texts = [None, "", " \n\t", "few words", clean, clean + "\n" + junk, junk, "\n".join([clean, "Privacy policy | Terms of use", clean.split("\n")[0]]),
             "\n".join(["home | news | sport | more"] * 9), clean.upper().replace(" ", "!! ") + "!!", " ".join(["again and"] * 60),
             prose(9, 3000), prose(10, 200) + "\n" + prose(10, 200), "\u00a0".join(prose(3, 30).split()), clean + "\n\n" + clean.split("\n")[1] + "\n \n"]
    got = {r.doc_id: r for r in line_cleaning.quality_report(documents(texts)).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat_words(words))
        assert tuple(got[i])[1:6] == want
        assert got[i].base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
    # 7 and 14 repeat a line of twelve words, too much of so short a text.
    assert {i for i in got if got[i].kept} == {4, 11}


def test_clean_texts(documents, prose):
    good = "\n".join(prose(s, 15) + "." for s in range(4))
    docs = documents([good, good + "\nAll rights reserved.\n\nlast line here", None])
    rows = {r.doc_id: r for r in line_cleaning.clean(docs).collect()}
    assert line_cleaning.clean(docs).dtypes == docs.dtypes and set(rows) == {0, 1}
    assert rows[0].text == good and rows[1].text == good + "\n\nlast line here" and rows[1].n_chars == len(rows[1].text)
    assert line_cleaning.clean(documents([])).collect() == []


def test_urls(spark):
    urls = {
        "http://WWW.Example.net/en/a?q": ("www.example.net", "/en/a", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"), "x://net": ("net", "", None, None), "x://net/": ("net", "/", "net/", "block"),
        "http://badexample.com/de/1": ("badexample.com", "/de/1", None, None), "http://a.example.com/de/1#x": ("a.example.com", "/de/1", "example.com/de/", "block"),
        "https://b.org/fr/": ("b.org", "/fr/", "org/fr/", "allow"), "no scheme": ("", "", None, None), None: ("", "", None, None), "http://": ("", "", None, None),
        "http://h?x=/a://b/": ("h", "", None, None), "http://é.COM#/en/": ("é.com", "", None, None), "a://b://c/d": ("b:", "//c/d", None, None),
    }
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, n string")
    labels = spark.createDataFrame([(0, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = host_reputation.judge(pages, labels).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = list(urls.values())[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
    assert host_reputation.judge(pages.limit(0), labels.limit(0)).collect() == []


def test_reputation_shrinks(spark):
    hosts = [("bad.example.com", 400, 380), ("one.example.com", 1, 1)] + [(f"h{i}.example.com", 200, 10 + i % 3) for i in range(30)]
    rows = {r.host: r for r in host_reputation.reputation(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert rows["bad.example.com"].bound > 0.8 and rows["h1.example.com"].bound < 0.1
    # One bad page tells little: the host stays near its parents.
    assert rows["one.example.com"].rate < 0.9 and rows["one.example.com"].bound < 0.2


def test_name_parts(spark):
    """Registered domains under suffixes of one and two labels, without user info and port; addresses stand alone."""
    want = {"a.b.example.com": ("com", "example.com"), "example.com:8080": ("com", "example.com"), "u:p@www.a.co.uk:1": ("co.uk", "a.co.uk"),
            "b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"), "localhost": ("localhost", "localhost"), "": ("", ""),
            "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:80": ("[::1]", "[::1]"), "a.com.au": ("com.au", "a.com.au")}
    suffix, domain = host_reputation.name_parts(F.col("host"))
    got = spark.createDataFrame([(h,) for h in want], "host string").select("host", suffix, domain).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == want


def test_raking(documents, spark, prose):
    texts = [None, ""] + [prose(i, i % 40) + (" licence" if i % 5 == 0 else "") for i in range(300)]
    docs = documents(texts)
    rows = raking.calibrated(docs, keep=0.4).collect()
    assert len(rows) == len(texts) and all(0 <= r.probability <= 1 for r in rows)
    cells = {}
    for r in rows:
        cells.setdefault((r.source, r.lang, r.topic), [0, r.probability])[0] += r.n_tokens
    # Raked by hand.
    tokens = {k: float(v[0]) for k, v in cells.items()}
    weight, targets = dict(tokens), []
    for d, power in enumerate(raking.TEMPER.values()):
        own = Counter()
        for k, v in tokens.items():
            own[k[d]] += v
        share = {v: n**power if n else 0.0 for v, n in own.items()}
        targets.append({v: s / sum(share.values()) for v, s in share.items()})
    for _ in range(raking.ROUNDS):
        for d, target in enumerate(targets):
            total = Counter()
            for k, v in weight.items():
                total[k[d]] += v
            weight = {k: v * target[k[d]] / total[k[d]] if total[k[d]] else 0.0 for k, v in weight.items()}
    for k, (n, probability) in cells.items():
        want = min(1.0, 0.4 * weight[k] / (n / sum(tokens.values()))) if n else 1.0
        assert probability == pytest.approx(want, abs=2e-9)
    # Fitted: every marginal but the last agrees closely, the last exactly.
    for d, target in enumerate(targets):
        for v, share in target.items():
            assert sum(w for k, w in weight.items() if k[d] == v) == pytest.approx(share, rel=1e-2)
    out = raking.sample_mixture(docs)
    drawn = raking.calibrated(docs).where("kept").collect()
    assert out.dtypes == docs.dtypes and sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in drawn)
    assert raking.sample_mixture(documents([])).collect() == []


def expected_shares(rows):
    """Share of every source, language and topic among the tokens the draw is expected to keep, and how many these are."""
    kept = [Counter() for _ in raking.TEMPER]
    for r in rows:
        for d, name in enumerate(raking.TEMPER):
            kept[d][r[name]] += r.n_tokens * r.probability
    total = sum(kept[0].values())
    return [{v: n / total for v, n in k.items()} for k in kept], total


def target_shares(rows):
    targets = []
    for name, power in raking.TEMPER.items():
        own = Counter()
        for r in rows:
            own[r[name]] += r.n_tokens
        total = sum(n**power for n in own.values())
        targets.append({v: n**power / total for v, n in own.items()})
    return targets


def mixed(spark, sizes):
    """Documents of ten tokens: so many of each source, over three languages and topics, unevenly."""
    ends = [" word", " licence", " a@b"]
    rows = [(s, ["en", "en", "de", "fr"][i % 4], "word " * 9 + ends[(i // 4 + i // 7) % 3]) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, lang string, text string")


def test_the_draw_meets_the_targets(spark):
    """Small sources beside a hot one need more than half of their tokens; so do some cells."""
    docs = mixed(spark, {"hot": 2000, "b": 300, "c": 260, "d": 240})
    rows = raking.calibrated(docs).collect()
    tokens = sum(r.n_tokens for r in rows)
    shares, total = expected_shares(rows)
    assert total == pytest.approx(tokens / 2, rel=1e-6) and all(0 <= r.probability <= 1 for r in rows)
    assert any(r.probability == 1 for r in rows)
    for got, want in zip(shares, target_shares(rows)):
        assert got == pytest.approx(want, rel=1e-4)


def test_a_target_above_the_supply(spark):
    """A source too small for its target is taken whole; the others share the rest, and languages and topics fit."""
    rows = raking.calibrated(mixed(spark, {"hot": 1000, "b": 400, "c": 400, "tiny": 12})).collect()
    tokens = sum(r.n_tokens for r in rows)
    shares, total = expected_shares(rows)
    want = target_shares(rows)
    supply = 2 * sum(r.n_tokens for r in rows if r.source == "tiny") / tokens
    assert want[0]["tiny"] > supply and {r.probability for r in rows if r.source == "tiny"} == {1.0}
    want[0] = {v: supply if v == "tiny" else s * (1 - supply) / (1 - want[0]["tiny"]) for v, s in want[0].items()}
    assert total == pytest.approx(tokens / 2, rel=1e-6)
    for got, target in zip(shares, want):
        assert got == pytest.approx(target, rel=1e-4)
    # Where a source is to be left out or all is to be kept, the bounds still hold.
    rows = raking.calibrated(mixed(spark, {"a": 30, "b": 30}), targets={"source": {"a": 0.0}}).collect()
    assert {r.probability for r in rows if r.source == "a"} == {0.0} and max(r.probability for r in rows) <= 1
    assert {r.probability for r in raking.calibrated(mixed(spark, {"a": 30, "b": 9}), keep=1.0).collect()} == {1.0}


def test_clashing_names(spark, documents, prose):
    """Columns may be named as the operators name theirs inside."""
    names = ["_words", "_lines", "_filled", "_hashes", "_windows", "_sorted", "_places", "_s", "_l", "_t", "_body", "_row", "row", "body", "place",
             "_q_kept", "s", "l", "t", "id", "_m_kept", "clean_text", "probability"]
    docs = documents(["\n".join(prose(10 * i + k, 15) + "." for k in range(4)) for i in range(12)])
    odd = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names if n not in docs.columns})
    for operator in (line_cleaning.clean, raking.sample_mixture):
        plain, got = operator(docs).collect(), operator(odd)
        assert got.dtypes == odd.dtypes
        assert sorted(tuple(r)[:len(docs.columns)] for r in got.collect()) == sorted(map(tuple, plain))
        assert all(r[n] == f"{n}{r.doc_id}" for r in got.collect() for n in names if n not in docs.columns)


def test_draw_meets_its_targets(spark):
    """What the registered query draws on the whole, by its probabilities, is what can be reached."""
    rows = mixed(spark, {"hot": 900, "b": 60, "c": 60, "tiny": 9})
    got = raking.mixture_report(rows).collect()
    tokens = Counter()
    for r in got:
        tokens[r.source] += r.n_tokens
    total, keep = sum(tokens.values()), 0.5
    share = {s: (n / total) ** raking.TEMPER["source"] for s, n in tokens.items()}
    share = {s: v / sum(share.values()) for s, v in share.items()}
    # Values without enough tokens are taken whole; the others share the rest.
    held = set()
    while True:
        free = 1 - sum(tokens[s] / total / keep for s in held)
        scale = free / sum(share[s] for s in share if s not in held)
        more = {s for s in share if s not in held and share[s] * scale > tokens[s] / total / keep}
        if not more:
            break
        held |= more
    drawn = Counter()
    for r in got:
        drawn[r.source] += r.n_tokens * r.probability
    for s in share:
        want = tokens[s] / total / keep if s in held else share[s] * scale
        assert abs(drawn[s] / (keep * total) - want) < 2e-2


def test_toxicity_bound(spark, documents, prose, monkeypatch):
    """Rows of one id that repeats count one by one, and the least ids' hashes are fitted on."""
    real = toxicity._featurise
    docs = documents([prose(i, 5) for i in range(300)], ids=[i if i < 20 else 3 for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    fitted = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in real(batches):
            fitted.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(toxicity, "_featurise", counting)
    toxicity.train(docs, labels, rows=10)
    assert fitted.value == 10


def plain_ftrl(rows):
    """The FTRL-proximal rule, one coordinate at a time."""
    import math
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    bias = 1 << toxicity.BITS
    for _ in range(toxicity.PASSES):
        for label, places in rows:
            used = {i: weight(i) for i in [*places, bias]}
            slope = 1 / (1 + math.exp(-sum(used.values()))) - label
            for i, w in used.items():
                z[i] += slope - (math.sqrt(n[i] + slope**2) - math.sqrt(n[i])) / toxicity.ALPHA * w
                n[i] += slope**2
    return {i: weight(i) for i in z}


def test_ftrl_against_plain():
    draw = random.Random(4)
    rows = [(int(draw.random() < 0.4), sorted(draw.sample(range(60), draw.randint(0, 20)))) for _ in range(400)]
    rows = [(label, [p for p in places if not (p < 8 and not label)]) for label, places in rows]
    weights, bias = toxicity.fit([(label, np.array(places, np.int64)) for label, places in rows])
    want = plain_ftrl(rows)
    assert abs(bias - want.pop(1 << toxicity.BITS)) < 1e-9 and any(want.values())
    assert all(abs(weights[i] - w) < 1e-9 for i, w in want.items())


def test_toxicity(spark, documents, prose):
    texts = [prose(i, 30) + (" you scum and trash " if i % 4 == 0 else " ") + prose(i + 5000, 10) for i in range(600)] + [None, "", "scum trash"]
    docs = documents(texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(600)] + [(None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    judged = [r for r in got if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in judged) > 0.97 * len(judged)
    # What is held out is never learned from.
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    again = toxicity.score(docs, toxicity.train(docs, other)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in got}
    nothing = toxicity.score(docs, toxicity.train(docs, labels.limit(0))).collect()
    assert {r.score for r in nothing} == {0.5} and toxicity.score(docs.limit(0), np.zeros((1 << toxicity.BITS) + 1)).collect() == []


def test_licenses(documents, prose):
    notices = license_scan.TEMPLATES
    texts = [None, "", "Released under the", prose(1, 400)] + [prose(i, 40 * i) + "\n" + t.upper().replace(" ", "\n ") + "\n" + prose(i + 50, 33) for i, t in enumerate(notices.values())]
    long = notices["MIT"].split(" ")
    texts += [" ".join(w for i, w in enumerate(long) if i != 60), " ".join(w if i % 6 else "odd" for i, w in enumerate(long)), notices["MIT-notice"] + " " + prose(9, 3000) + " " + notices["BSD"]]
    got = {(r.doc_id, r.license): r for r in license_scan.licenses(documents(texts)).collect()}
    last = len(texts) - 1
    want = {(4 + i, name) for i, name in enumerate(notices)} | {(last - 2, "MIT"), (last, "MIT-notice"), (last, "BSD")}
    assert set(got) == want
    assert got[last - 2, "MIT"].containment < 1 == got[8, "MIT"].containment
    row = got[last, "MIT-notice"]
    assert texts[last].encode()[row.start_byte:row.end_byte] == b"Released under the MIT License"
    assert license_scan.licenses(documents([])).collect() == []


def plain_licenses(text):
    """Share of every template in every window of a text, by sets of words."""
    def shingles(t):
        words = re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        return [tuple(words[i:i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []

    rows, best = shingles(text), {}
    for name, template in license_scan.TEMPLATES.items():
        members = set(shingles(template))
        size = 1 << (len(members) - 1).bit_length()
        for low in range(0, len(rows), size):
            inside = [i for i in range(low, min(low + 2 * size, len(rows))) if rows[i] in members]
            share = len({rows[i] for i in inside}) / len(members)
            if share >= 0.8 and share > best.get(name, (0,))[0]:
                best[name] = share, inside[0], inside[-1] + 5
    return {n: round(s, 9) for n, (s, a, b) in best.items() if not any(t > s and c < b and a < d for t, c, d in best.values())}


def test_licenses_against_plain(documents, prose):
    """Whole, worn and mixed templates, several to a text, very long texts and ties."""
    draw, names = random.Random(6), list(license_scan.TEMPLATES)
    texts = []
    for i in range(250):
        parts = []
        for _ in range(draw.randint(0, 3)):
            words = license_scan.TEMPLATES[draw.choice(names)].split(" ")
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                words[draw.randrange(len(words))] = draw.choice(["odd", "", "2", "3"])
            parts += [prose(1000 + draw.randint(0, 999), draw.randint(0, 60)), draw.choice([" ", "\n", " -- "]).join(words)]
        texts.append("\n".join([*parts, prose(i, draw.randint(0, 50))]))
    texts += [license_scan.TEMPLATES["MIT"] + " " + license_scan.TEMPLATES["MIT"], prose(5, 30_000) + license_scan.TEMPLATES["GPL-2.0-header"]]
    got = {}
    for r in license_scan.licenses(documents(texts)).collect():
        got.setdefault(r.doc_id, {})[r.license] = round(r.containment, 9)
    want = {i: found for i, t in enumerate(texts) if (found := plain_licenses(t))}
    assert got == want and sum(map(len, want.values())) > 200


def test_windows_hold_whole_templates():
    """Wherever a template stands, one window holds it, so its bands agree."""
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8, 48)
    for at in range(70):
        text = " ".join([*(f"w{i}" for i in range(at)), license_scan.TEMPLATES["GPL-3.0-notice"], *(f"v{i}" for i in range(40))])
        assert [(t, s) for _, t, s, _, _ in scanner.scan(*flat(pa.array([text])))] == [(2, 1.0)]


@pytest.fixture(scope="module")
def piece_texts():
    draw = random.Random(3)
    parts = list(" ab thereingé日本\n\t▁　.,0123<>~@'") + ["  ", "the", "ing", "\U0001F600", "ß", "\x00", "\r\n", "    ", "ation", "ing."]
    texts = [None, "", " ", "  ", "a ", "x" * 2000, "....", "日本語" * 200]
    return texts + ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(1500)]


def test_pieces_are_the_models_own(documents, piece_texts, prose):
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = piece_texts + [prose(i, 50) for i in range(40)]
    docs = documents(texts)
    rows = piece_transducer.encode(docs, MODEL)
    assert rows.columns == [*(c for c in docs.columns if c != "ids"), "ids", "n_ids", "round_trip"]
    got = {r.doc_id: r for r in rows.collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == own.encode(t or "") and got[i].n_ids == len(got[i].ids)
        assert got[i].round_trip == ("▁" not in (t or ""))
    back = {r.doc_id: r.text for r in piece_transducer.decode(rows, MODEL).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    assert piece_transducer.encode(documents([]), MODEL).collect() == []


def test_unigram_paths():
    """The least path of a small unigram model is the best of all segmentations."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.trainer_spec.model_type, proto.normalizer_spec.add_dummy_prefix = 1, False
    proto.normalizer_spec.remove_extra_whitespaces = False
    draw = random.Random(1)
    pieces = {"a": -3.0, "b": -3.5, "c": -4.0} | {"".join(draw.choice("abc") for _ in range(n)): -draw.uniform(2, 9) for n in (2, 2, 3, 3, 4, 5) for _ in range(3)}
    proto.pieces.add(piece="<unk>", score=0.0, type=2)
    for p, s in pieces.items():
        proto.pieces.add(piece=p, score=s, type=1)
    machine = piece_transducer.Transducer(proto.SerializeToString())

    def best(text):
        if not text:
            return 0.0
        return max(pieces[text[:n]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in pieces)

    for _ in range(40):
        text = "".join(draw.choice("abc") for _ in range(draw.randint(1, 11)))
        ids = machine.encode(text)
        assert machine.decode(ids) == text and sum(machine.scores[machine.pieces[i]] for i in ids) == pytest.approx(best(text))
