"""Column expressions for identifiers, track numbers, durations, names and dates.

Everything here is built from Spark functions, so it stays inside code generation.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleeveworks.schema import CONTINENTS, MISSING, NA_SPELLINGS, SHELFMARK_SUFFIX

BLANKS = " \n\t\r\f\x0b"


def strip(text: Column) -> Column:
    """Remove white space, line ends included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def null_spellings(text: Column) -> Column:
    """Null for every spelling that stands for "no value"."""
    return F.when(~text.isin(NA_SPELLINGS), text)


def zero_pad(text: Column, width: int = 2) -> Column:
    """Pad with zeros on the left; longer texts are left whole (a bare lpad would cut them)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def track_number(raw: Column, is_text: Column | None = None) -> Column:
    """First digit run padded to two digits; null when there is none.

    ``is_text`` tells whether the source value was a string. Given, numbers are refused.
    """
    number = zero_pad(empty_to_null(F.regexp_extract(raw, "[0-9]+", 0)))
    return number if is_text is None else F.when(is_text, number)


def natural_key(name: Column) -> Column:
    """First digit run as a number, null when there is none."""
    return F.regexp_extract(name, "[0-9]+", 0).try_cast("decimal(38,0)")


def duration_text(seconds: Column) -> Column:
    """Seconds as ``M'SS``, rounded down; ``missing`` when unknown."""
    rest = seconds % 60
    # seconds - rest is an exact multiple of 60, so the division cannot round up a minute.
    minutes = ((seconds - rest) / 60).cast("bigint").cast("string")
    text = F.concat(minutes, F.lit("'"), zero_pad(rest.cast("int").cast("string")))
    return F.coalesce(text, F.lit(MISSING))


def audio_name(lp_id: Column, face: Column, number: Column, parity: bool = False) -> Column:
    """Expected audio file ``{lp}_1z1_{face}{NN}.mp3``.

    Null when a part is unknown. With ``parity`` an unknown part is printed as ``None``.
    """
    if parity:
        face, number = (F.coalesce(c, F.lit("None")) for c in (face, number))
    return F.concat(lp_id, F.lit("_1z1_"), face, number, F.lit(".mp3"))


def legacy_slot_code(lp_id: Column, file_name: Column) -> Column:
    """Face and number, such as ``A1``, of a file named ``{lp}_{A|B}{N}.mp3``; null otherwise."""
    rest = F.when(
        F.startswith(file_name, F.concat(lp_id, F.lit("_"))),
        F.substring(file_name, F.length(lp_id) + 2, F.length(file_name)),
    )
    return empty_to_null(F.regexp_extract(rest, r"^([AB][0-9]+)\.mp3", 1))


def slot_code(file_name: Column) -> Column:
    """Face and number, such as ``A01``, from the last underscore part of a file name."""
    return empty_to_null(F.regexp_extract(file_name, r"(?:^|_)([^_][0-9]+)\.mp3$", 1))


def code_face(code: Column) -> Column:
    return F.left(code, F.lit(1))


def code_number(code: Column) -> Column:
    """Digits of a slot code."""
    return F.substring(code, F.lit(2), F.length(code))


def lp_id_of_file(file_name: Column) -> Column:
    """Album id: file name up to the first underscore."""
    return F.substring_index(file_name, "_", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def output_name(file_name: Column) -> Column:
    """Name of the extraction file that belongs to a recognised-text file."""
    return F.replace(file_name, F.lit("_combined.txt"), F.lit("_ai_output.json"))


def capitalise(text: Column) -> Column:
    """First letter upper, all others lower (not word by word)."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, F.lit(2), F.length(text))))


def shelfmark(lp_id: Column) -> Column:
    return F.concat(lp_id, F.lit(SHELFMARK_SUFFIX))


def shelfmark_of_folder(folder: Column) -> Column:
    """``LP2836_1z1`` -> ``LP2836-1/1``."""
    return F.translate(folder, "_z", "-/")


def name_and_composer(name: Column, composer: Column, parity: bool = False) -> Column:
    """``name-composer``. Unknown parts are left out, or printed ``nan`` with ``parity``."""
    if parity:
        name, composer = (F.coalesce(c, F.lit("nan")) for c in (name, composer))
    return F.concat_ws("-", name, composer)


def full_date(as_of: Column) -> Column:
    return F.date_format(as_of, "dd.MM.yyyy")


def curation_comment(note: str, curator: str, as_of: Column) -> Column:
    """``{note} ({curator} MM.yyyy)``."""
    return F.concat(F.lit(f"{note} ({curator} "), F.date_format(as_of, "MM.yyyy"), F.lit(")"))


def data_url(content: Column, mime: str = "image/jpeg") -> Column:
    # A session may be set to break base64 into lines; a URL has none.
    return F.concat(F.lit(f"data:{mime};base64,"), F.translate(F.base64(content), "\r\n", ""))


def render_prompt(template: str, document: Column) -> Column:
    return F.concat(F.lit(template), document)


def continent(country: Column, names: dict[str, tuple[str, str]] = CONTINENTS) -> tuple[Column, Column]:
    """(continent, sub-continent) by exact spelling from a small literal dictionary."""

    def pick(i: int) -> Column:
        values: dict[str, list[str]] = {}
        for spelling, pair in names.items():
            values.setdefault(pair[i], []).append(spelling)
        start = F.when(F.lit(False), F.lit(None).cast("string"))
        return reduce(lambda c, kv: c.when(country.isin(kv[1]), F.lit(kv[0])), values.items(), start)

    return pick(0), pick(1)
