"""Line-first quality rules, in SQL functions only.

Every line is judged first: junk punctuation, navigation bars and boilerplate phrases go. A document
is rejected if that takes too much of its text, or if it fails the base rules (few words, or many
words inside passages that the text repeats).

Words are ``[^\\x20\\x09-\\x0D]+``. A text is split once and everything is computed in its own row:
no shuffle, and the cost follows the length of the text (n log n where passages repeat).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Repeated passages are found by windows of so many words.
WINDOW = 8

# What marks a line that is not prose.
JUNK = "#*$%&<>~^=_"
SHOUT = "!"
SEPARATORS = "|»›•·"
BOILERPLATE = [
    "all rights reserved", "privacy policy", "cookie policy", "uses cookies", "terms of use", "terms of service",
    "subscribe to our", "sign up for", "click here", "share this", "follow us on", "read more", "back to top",
    "skip to content", "enable javascript", "lorem ipsum",
]


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column, junk_share: float = 0.125, bar_share: float = 0.05, phrase_length: int = 100) -> Column:
    """Whether a line is junk: by its share of symbols or exclamation marks, as a bar of three
    separators or more, or as a short line with a boilerplate phrase. A line without a word passes.

    One search for any mark comes first, so that plain prose is not counted character by character.
    """
    chars = F.length(F.translate(line, WHITE, ""))
    bars = _count(line, SEPARATORS)
    marked = (
        (_count(line, JUNK) > junk_share * chars)
        | (_count(line, SHOUT) > junk_share * chars)
        | ((bars >= 3) & (bars > bar_share * chars))
    )
    phrase = (F.length(line) <= phrase_length) & F.lower(line).rlike("|".join(BOILERPLATE))
    return (line.rlike(f"[{JUNK}{SHOUT}{SEPARATORS}]") & marked) | phrase


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_chars", "kept", "clean_text"]


def measure(docs: DataFrame, text: str = "text", min_words: int = 20, max_repeat_percent: int = 30,
            max_lost: float = 0.5, prefix: str = "") -> DataFrame:
    """``docs`` with the rules' figures and verdict, each name after ``prefix``:

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_chars (characters
    in words of failed lines), kept, clean_text (the text without its failed lines).

    A null text has no words and fails. Rows are judged one by one, so repeated rows are judged
    alike. ``prefix`` keeps the figures apart from columns of ``docs`` with the same names; without
    it such columns are replaced.
    """
    p = prefix
    figures = [f"{p}{n}" for n in FIGURES]
    # The row travels as one, whatever its columns' names.
    names = [c for c in docs.columns if c not in figures]
    row = F.struct(*[F.col(f"`{c}`") for c in names] or [F.lit(0).alias("none")])
    columns = [F.col(f"_row.`{c}`").alias(c) for c in names]
    docs = docs.select(row.alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_body"))
    body = F.col("_body")
    rows = docs.withColumns({
        "_words": F.array_remove(F.split(body, "[\\x20\\x09-\\x0D]+"), ""),
        "_lines": F.split(body, "\n"),
    })
    rows = rows.withColumns({
        f"{p}n_words": F.size("_words").cast("long"),
        f"{p}word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "_filled": F.filter("_lines", lambda line: F.btrim(line, F.lit(WHITE)) != ""),
        "_hashes": F.transform("_words", lambda word: F.xxhash64(word)),
    }).drop("_words")
    following = ", ".join(f"get(_hashes, i + {k})" for k in range(1, WINDOW))
    rows = rows.withColumn("_windows", F.expr(
        f"CASE WHEN size(_hashes) >= {WINDOW} THEN "
        f"transform(slice(_hashes, 1, size(_hashes) - {WINDOW - 1}), (h, i) -> xxhash64(h, {following})) END"
    )).drop("_hashes")
    # Windows found twice or more, by sorting hashes beside their places; most texts have none.
    rows = rows.withColumn("_sorted", F.expr(
        "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN "
        "array_sort(transform(_windows, (h, i) -> named_struct('h', h, 'i', i))) END")).drop("_windows")
    rows = rows.withColumn("_places", F.expr(
        "CASE WHEN _sorted IS NOT NULL THEN array_sort(transform(filter(transform(_sorted, (e, j) -> named_struct('i', e.i, "
        "'again', e.h <=> get(_sorted, j - 1).h OR e.h <=> get(_sorted, j + 1).h)), e -> e.again), e -> e.i)) END"
    )).drop("_sorted")
    failed = F.filter("_filled", lambda line: line_fails(line))
    rows = rows.withColumns({
        f"{p}n_symbols": F.when(body.rlike(f"[{SYMBOLS}]"), _count(body, SYMBOLS)).otherwise(0).cast("long"),
        f"{p}n_dup_lines": (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long"),
        f"{p}n_repeat_words": F.expr(
            f"CAST(CASE WHEN _places IS NULL THEN 0 ELSE aggregate(transform(_places, (x, j) -> "
            f"least({WINDOW}, coalesce(get(_places, j + 1) - x, {WINDOW}))), 0, (a, x) -> a + x) END AS BIGINT)"),
        f"{p}n_lost_chars": F.aggregate(
            failed, F.lit(0).cast("long"),
            lambda total, line: total + F.length(F.translate(line, WHITE, ""))),
        f"{p}clean_text": F.array_join(
            F.filter("_lines", lambda line: (F.btrim(line, F.lit(WHITE)) == "") | ~line_fails(line)), "\n"),
    }).drop("_filled", "_lines", "_places")
    words, repeats = F.col(f"{p}n_words"), F.col(f"{p}n_repeat_words")
    rows = rows.withColumn(f"{p}base_failed", (words < min_words) | (100 * repeats > max_repeat_percent * words))
    lost = F.col(f"{p}n_lost_chars") > max_lost * F.col(f"{p}word_chars")
    return rows.withColumn(f"{p}kept", ~F.col(f"{p}base_failed") & ~lost).select(*columns, *figures)


def quality_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of figures and verdict per document, without its text."""
    measured = measure(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_text")), "_text")
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def clean(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The documents that pass, with the columns of ``docs``; failed lines are cut from the text and
    ``chars``, where there is such a column, follows the new text."""
    # A filter isn't pushed below a running number; pushed down to the scan, it would evaluate the
    # windows again for each of their words.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = measure(docs.select(row.alias("row"), F.col(text).alias("text")), "text").withColumn("place", F.monotonically_increasing_id())
    kept = numbered.where("kept AND place >= 0")
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {text: F.col("clean_text")}
    if chars in docs.columns and chars != text:
        columns[chars] = F.length("clean_text").cast(docs.schema[chars].dataType)
    return kept.select(*[columns[c].alias(c) for c in docs.columns])
