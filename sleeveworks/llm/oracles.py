"""Expected rows of the queries, in DuckDB's SQL over the same tables."""

from sleeveworks.llm.host_reputation import ADDRESS, RULES, STRONGEST, TWO_LABELS, WEAKEST
from sleeveworks.llm.line_cleaning import BOILERPLATE, JUNK, SEPARATORS, WINDOW
from sleeveworks.llm.raking import ROUNDS, TEMPER, TOPICS

_WORD = "[^\\x20\\x09-\\x0D]+"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _n(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, '{characters}', '')))"


def quality(source: str = "documents") -> str:
    """Per document the figures of the quality rules, the verdict, and the text without failed lines."""
    size = f"length(translate(line, {_WHITE}, ''))"
    fails = (
        f"(8 * {_n('line', JUNK)} > {size} OR 8 * {_n('line', '!')} > {size} OR "
        f"({_n('line', SEPARATORS)} >= 3 AND 20 * {_n('line', SEPARATORS)} > {size}) OR "
        f"(length(line) <= 100 AND regexp_matches(lower(line), '{'|'.join(BOILERPLATE)}')))"
    )
    window = " || ' ' || ".join(f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY i)" for k in range(WINDOW))
    return f"""
    WITH base AS (SELECT *, coalesce(text, '') AS body FROM {source}),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i
              FROM (SELECT doc_id, regexp_extract_all(body, '{_WORD}') AS w FROM base)),
    windows AS (SELECT doc_id, i, {window} AS win FROM words),
    twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows WHERE win IS NOT NULL),
    places AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM twice WHERE c > 1),
    repeats AS (SELECT doc_id, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n FROM places GROUP BY doc_id),
    lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM (SELECT doc_id, string_split(body, chr(10)) AS l FROM base)),
    judged AS (SELECT doc_id, line, pos, {size} > 0 AS filled, {size} AS size, {fails} AS fails FROM lines),
    by_line AS (SELECT doc_id, count(*) FILTER (filled) - count(DISTINCT line) FILTER (filled) AS dup,
                coalesce(sum(size) FILTER (filled AND fails), 0) AS lost,
                string_agg(line, chr(10) ORDER BY pos) FILTER (NOT filled OR NOT fails) AS clean FROM judged GROUP BY doc_id),
    figures AS (SELECT base.*, len(regexp_extract_all(body, '{_WORD}'))::BIGINT AS n_words,
                length(translate(body, {_WHITE}, ''))::BIGINT AS word_chars, {_n('body', '#*$%&|<>')}::BIGINT AS n_symbols,
                dup::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, lost, coalesce(clean, '') AS clean
                FROM base JOIN by_line USING (doc_id) LEFT JOIN repeats USING (doc_id)),
    rules AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
    SELECT *, NOT base_failed AND 2 * lost <= word_chars AS kept FROM rules"""


OP6 = f"""SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM ({quality()})"""


def _strength(n: str, bad: str, children: str, squares: str, shares: str) -> str:
    p = f"({bad} / {n})"
    free = f"({p} * (1 - {p}))"
    share = (f"(({shares} - {n} * {p} * {p} - {free} * ({children} - 1)) / "
             f"nullif({free} * ({n} - {squares} / {n} - ({children} - 1)), 0))")
    return f"""least(greatest(coalesce(CASE WHEN {n} > 0 AND {share} > 0 THEN 1 / {share} - 1 ELSE {STRONGEST} END,
        {STRONGEST}), {WEAKEST}), {STRONGEST})"""


_SUMS = "sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad"
_SPREAD = """sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(CASE WHEN n > 0 THEN 1.0::DOUBLE END) AS children,
    sum(n * n) AS squares, sum(CASE WHEN n > 0 THEN bad * bad / n END) AS shares"""
_S = _strength("n", "bad", "children", "squares", "shares")
_BY_RULE = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in RULES.items())
_FITS = " ".join(
    f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) "
    f"AND starts_with(path, '/{r.split('/', 1)[1]}') THEN '{r}'"
    for r in sorted(RULES, key=lambda r: (-len(r), r)))
_TWO = ", ".join(f"'{suffix}'" for suffix in TWO_LABELS)
OP7 = f"""
WITH urls AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
ruled AS (SELECT *, CASE {_FITS} END AS rule FROM parts),
counts AS (SELECT doc_id AS page_id, count(*) AS n, count(*) FILTER (quality = 0) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
names AS (SELECT *, regexp_extract(bare, '([^.]*[.])?[^.]*$') AS two, regexp_matches(bare, '{ADDRESS}') AS address FROM (
          SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare,
          coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad FROM parts LEFT JOIN counts USING (page_id) GROUP BY host)),
hosts AS (SELECT host, n, bad, CASE WHEN address THEN bare WHEN two IN ({_TWO}) THEN two ELSE regexp_extract(bare, '[^.]*$') END AS suffix,
          CASE WHEN address THEN bare WHEN two IN ({_TWO}) THEN regexp_extract(bare, '([^.]*[.])?[^.]*[.][^.]*$') ELSE two END AS domain FROM names),
domains AS (SELECT domain, suffix, {_SUMS} FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, {_SUMS} FROM domains GROUP BY suffix),
root AS (SELECT (bad + 0.5) / (n + 1.0) AS rate, {_S} AS strength FROM (SELECT {_SPREAD} FROM suffixes)),
by_suffix AS (SELECT suffix, (bad + strength * rate) / (n + strength) AS rate FROM suffixes, root),
prior_d AS (SELECT suffix, rate, {_S} AS strength FROM (SELECT suffix, {_SPREAD} FROM domains GROUP BY suffix) JOIN by_suffix USING (suffix)),
by_domain AS (SELECT domain, (bad + strength * rate) / (n + strength) AS rate FROM domains JOIN prior_d USING (suffix)),
prior_h AS (SELECT domain, rate, {_S} AS strength FROM (SELECT domain, {_SPREAD} FROM hosts GROUP BY domain) JOIN by_domain USING (domain)),
by_host AS (SELECT host, (bad + strength * rate) / (n + strength) AS r, n + strength AS total FROM hosts JOIN prior_h USING (domain))
SELECT page_id, host, path, rule,
       CASE rule {_BY_RULE} ELSE CASE WHEN r - 2 * sqrt(r * (1 - r) / (total + 1)) > 0.2 THEN 'block' ELSE 'allow' END END AS verdict,
       round(r, 6) AS rate
FROM ruled JOIN by_host USING (host)"""


def _scaled(source: str, value: str, bound: str, total: str, group: str) -> str:
    """``source`` with ``f``: the factor by which least(value * f, bound) sums up to ``total`` in each group."""
    within = f"PARTITION BY {group} " if group else ""
    dims = ("source", "lang", "topic")
    rising = f"{within}ORDER BY ratio ASC NULLS FIRST, {', '.join(f'{d} ASC NULLS FIRST' for d in dims)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    falling = f"{within}ORDER BY ratio DESC NULLS LAST, {', '.join(f'{d} DESC NULLS LAST' for d in dims)} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return f"""(SELECT *, greatest(coalesce(max(g) OVER ({within}), 0.0), 0.0) AS f FROM (
        SELECT *, ({total} - coalesce(sum(CASE WHEN {value} > 0 THEN {bound} ELSE 0.0 END) OVER ({rising}), 0.0))
                  / nullif(sum({value}) OVER ({falling}), 0) AS g
        FROM (SELECT *, {bound} / nullif({value}, 0) AS ratio FROM {source})))"""


def mixture(source: str = "documents", keep: float = 0.5, seed: int = 7) -> str:
    """Per document of ``source`` its topic, tokens, raked probability and decision; no cell gives more than it has."""
    cases = " ".join(f"WHEN regexp_matches(body, '{pattern}') THEN '{name}'" for name, pattern in TOPICS.items())
    dims = "source, lang, topic"
    steps = [f"""b0 AS MATERIALIZED (SELECT *, tokens::DOUBLE AS weight, coalesce(tokens / nullif(sum(tokens) OVER () * {keep}::DOUBLE, 0), 0.0) AS bound FROM cells)"""]
    # Target shares: tempered, then no value above its supply.
    for n, (d, power) in enumerate(TEMPER.items()):
        steps += [
            f"""o{n} AS (SELECT *, row_number() OVER (PARTITION BY {d} ORDER BY source ASC NULLS FIRST, lang ASC NULLS FIRST, topic ASC NULLS FIRST) = 1 AS nth,
                sum(tokens) OVER (PARTITION BY {d})::DOUBLE AS own, sum(bound) OVER (PARTITION BY {d}) AS supply FROM b{n})""",
            f"p{n} AS (SELECT *, CASE WHEN own > 0 THEN pow(own, {power}) ELSE 0.0 END AS tempered FROM o{n})",
            f"s{n} AS (SELECT *, tempered / nullif(sum(CASE WHEN nth THEN tempered ELSE 0.0 END) OVER (), 0) AS t_{d} FROM p{n})",
            f"l{n} AS (SELECT *, CASE WHEN nth THEN t_{d} ELSE 0.0 END AS once FROM s{n})",
            f"b{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (nth, own, supply, tempered, once, ratio, g, f) "
            f"REPLACE (least(t_{d} * f, supply) AS t_{d}) FROM {_scaled(f'l{n}', 'once', 'supply', '1.0', '')})",
        ]
    steps.append(f"w0 AS (SELECT * FROM b{len(TEMPER)})")
    n = 0
    for _ in range(ROUNDS):
        for d in TEMPER:
            steps.append(f"w{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (ratio, g, f) REPLACE (weight * f AS weight) "
                         f"FROM {_scaled(f'w{n}', 'weight', 'bound', f't_{d}', d)})")
            n += 1
    steps.append(f"w{n + 1} AS (SELECT {dims}, tokens, least(weight, bound) AS weight FROM w{n})")
    n += 1
    return f"""
    WITH bodies AS (SELECT *, coalesce(text, '') AS body FROM {source}),
    counted AS (SELECT *, CASE {cases} ELSE 'prose' END AS topic, len(regexp_extract_all(body, '{_WORD}'))::BIGINT AS n_tokens FROM bodies),
    cells AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM counted GROUP BY source, lang, topic),
    {", ".join(steps)},
    chances AS (SELECT source, lang, topic, round(least(1.0, coalesce({keep}::DOUBLE * weight /
                nullif(tokens / (SELECT sum(tokens) FROM cells), 0), 1.0)), 9) AS probability FROM w{n})
    SELECT counted.*, probability,
           ('0x' || substr(md5(concat_ws(':', '{seed}', doc_id::VARCHAR)), 1, 12))::BIGINT::DOUBLE / {2.0**48} < probability AS kept
    FROM counted JOIN chances ON counted.source IS NOT DISTINCT FROM chances.source
        AND counted.lang IS NOT DISTINCT FROM chances.lang AND counted.topic = chances.topic"""


OP4 = f"SELECT doc_id, source, lang, topic, n_tokens, probability, kept FROM ({mixture()})"


def _crc32(text: str) -> str:
    """Of ASCII text: every character, then eight shifts of one bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END"
    return f"xor(list_reduce({bits}, lambda a, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def merkle(source: str = "documents") -> str:
    """Per document its leaf, proof and root, and the root that its possibly tampered copy leads to."""
    def leaf(n_chars: str) -> str:
        fields = ["doc_id", "source", "lang", n_chars, "text"]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"

    changed = f"(n_chars + CASE WHEN {_crc32('doc_id::VARCHAR')} % 7 = 0 THEN 1 ELSE 0 END)"
    parent = "pos // 2 AS pos, sha256(string_agg(hash, '' ORDER BY pos)) AS hash, any_value((n + 1) // 2) AS n"
    return f"""
    WITH RECURSIVE leaves AS (
      SELECT doc_id, lang, leaf, tampered, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
      FROM (SELECT doc_id, lang, {leaf('n_chars')} AS leaf, {leaf(changed)} AS tampered FROM {source})
    ), nodes AS (
      SELECT lang, 0 AS level, pos, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM leaves
      UNION ALL SELECT lang, level + 1, {parent} FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2
    ), subroots AS (
      SELECT lang, hash, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
    ), uppers AS (
      SELECT 0 AS level, pos, hash, n FROM subroots
      UNION ALL SELECT level + 1, {parent} FROM uppers WHERE n > 1 GROUP BY level, pos // 2
    ), ways AS (
      SELECT l.lang, l.pos AS place, o.level, CASE WHEN s.hash IS NULL THEN '-' WHEN o.pos % 2 = 1 THEN 'L' || s.hash ELSE 'R' || s.hash END AS step
      FROM leaves l JOIN nodes o ON o.lang IS NOT DISTINCT FROM l.lang AND o.n > 1 AND o.pos = l.pos >> o.level
      LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM o.lang AND s.level = o.level AND s.pos = xor(o.pos, 1)
      UNION ALL
      SELECT l.lang, l.pos, 1000 + o.level, CASE WHEN s.hash IS NULL THEN '-' WHEN o.pos % 2 = 1 THEN 'L' || s.hash ELSE 'R' || s.hash END
      FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN uppers o ON o.n > 1 AND o.pos = r.pos >> o.level
      LEFT JOIN uppers s ON s.level = o.level AND s.pos = xor(o.pos, 1)
    ), steps AS (SELECT lang, place, list(step ORDER BY level) AS steps FROM ways GROUP BY lang, place),
    proofs AS (
      SELECT l.doc_id, l.leaf, r.hash AS subroot, (SELECT hash FROM uppers WHERE n = 1) AS root,
             sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) AS proof_sha256,
             list_reduce(coalesce(steps, []), lambda a, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || a) WHEN 'R' THEN sha256(a || s[2:])
                         ELSE sha256(a) END, tampered) AS folded_root
      FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
      LEFT JOIN steps w ON w.lang IS NOT DISTINCT FROM l.lang AND w.place = l.pos
    )
    SELECT *, folded_root = root AS verified FROM proofs"""


ORACLES: dict[str, str] = {"op4_raking": OP4, "op6_quality_rules": OP6, "op7_url_filter": OP7, "op13_merkle_manifest": merkle()}
