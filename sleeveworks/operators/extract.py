"""From response texts to parsed documents, album rows, track rows and a quarantine.

Documents are decoded once, as VARIANT. Rows are kept or dropped with ``explode`` over an array
that is empty for unusable documents, never with a filter on a decoded value: the optimizer would
push such a filter below the projection and decode every text twice.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeveworks.functions import text as X
from sleeveworks.functions import scalars as S
from sleeveworks.schema import (
    GENERAL_FIELDS, GENERAL_SECTION, MISSING, TRACK_FIELDS, TRACK_SECTION,
)

# How the JSON text is found in a response.
SPANS = {
    "greedy": X.brace_span,
    "fenced": X.fenced_object,
    "body": X.fenced_body,
    "unfenced": X.drop_fences,
    "whole": lambda c: c,
}

# A section that holds one of these counts as not there.
_FALSY = ["", "0", "false", "[]", "{}"]


def get(value: Column | str, *names: str, kind: str = "string") -> Column:
    """A member of a VARIANT, null when absent or not convertible."""
    return F.try_variant_get(value, "$" + "".join(f'["{n}"]' for n in names), kind)


def has(value: Column | str, name: str) -> Column:
    """Whether the key exists, be its value null or not."""
    return get(value, name, kind="variant").isNotNull()


def is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def members(value: Column | str) -> Column:
    """The members of an object as a map, null for anything else."""
    return get(value, kind="map<string,variant>")


def is_object(value: Column | str) -> Column:
    """Cheaper than ``members``: reading one member as a struct fails for anything but an object."""
    return get(value, kind="struct<Face:variant>").isNotNull()


def parse_documents(df: DataFrame, text: str = "response", how: str = "greedy") -> DataFrame:
    """Add ``doc`` (the decoded object, null if there is none) and ``status``.

    The text must hold exactly one JSON value. Spark's parser stops after the first value and
    ignores what follows, so the text is put in an array in front of its own hash: whatever
    closes that array early, or adds a value, leaves something other than [value, hash].
    """
    digest = F.xxhash64("_span")
    boxed = F.concat(F.lit("["), F.col("_span"), F.lit(","), digest.cast("string"), F.lit("]"))
    alone = (F.try_variant_get("_box", "$[1]", "bigint") == digest) & F.try_variant_get(
        "_box", "$[2]", "variant").isNull()
    return (
        df.withColumn("_span", SPANS[how](F.col(text)))
        .withColumn("_box", F.try_parse_json(boxed))
        .withColumn("doc", F.when(alone, F.try_variant_get("_box", "$[0]", "variant")))
        .withColumn("status", _status(F.col("_span"), F.col("doc")))
        .drop("_span", "_box")
    )


def _status(span: Column, doc: Column) -> Column:
    """``ok``, ``empty`` (an object without members), or why the document is unusable."""

    def misplaced(section: str, fits: Callable[[Column], Column]) -> Column:
        value = get(doc, section, kind="variant")
        # The costly look at the text comes last and only for values of the wrong type.
        return value.isNotNull() & ~fits(value) & ~F.is_variant_null(value) & ~get(value).isin(_FALSY)

    elements = get(doc, TRACK_SECTION, kind="array<variant>")
    return (
        F.when(span.isNull() | (span == ""), "no_json")
        .when(doc.isNull(), "invalid_json")
        .when(~is_object(doc), "not_object")
        .when(F.size(members(doc)) == 0, "empty")
        .when(misplaced(GENERAL_SECTION, is_object), "general_not_object")
        .when(misplaced(TRACK_SECTION, lambda v: get(v, kind="array<variant>").isNotNull()), "tracks_not_array")
        .when(F.exists(elements, lambda t: ~is_object(t)), "track_not_object")
        .otherwise("ok")
    )


def usable() -> Column:
    """Whether a parsed document has nothing wrong."""
    return F.col("status").isin("ok", "empty")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Documents that could not be used, whole or in part, with the ``reason``."""
    reasons = F.when(usable(), F.array().cast("array<string>")).otherwise(F.array("status"))
    return parsed.withColumn("reason", F.explode(reasons)).drop("doc", "status")


def found_documents(parsed: DataFrame, column: str = "doc_json") -> DataFrame:
    """Documents that hold anything, as JSON text in ``column``."""
    keep = F.when(F.size(members("doc")) > 0, F.array(F.to_json("doc")))
    return parsed.withColumn(column, F.explode(keep)).drop("doc", "status")


def general_rows(parsed: DataFrame, key: str = "lp_id", fields: list[str] = GENERAL_FIELDS,
                 defaults: dict[str, str] | None = None, extra: str | None = None) -> DataFrame:
    """One row per document that has a general section.

    ``LP_ID`` is the album key, whatever the document says. Absent members are null, or what
    ``defaults`` gives for them. ``extra`` names a column for a map of all other members.
    """
    defaults = defaults or {}
    section = get("doc", GENERAL_SECTION, kind="variant")
    filled = F.when(F.size(members(section)) > 0, F.array(section))
    rows = parsed.select(F.col(key).alias("LP_ID"), F.explode(filled).alias("_general"))
    section = F.col("_general")
    return rows.select("LP_ID", *[
        (default_if_absent(section, f, defaults[f]) if f in defaults else get(section, f)).alias(f)
        for f in fields if f != "LP_ID"],
        *([other_members(section, fields).alias(extra)] if extra else []))


def track_rows(parsed: DataFrame, key: str = "lp_id", coerce_numbers: bool = True,
               default_length: str | None = None, extra: str | None = None) -> DataFrame:
    """One row per track entry, in document order (``seq``).

    A name or composer whose key is absent becomes ``missing``; an explicit null stays null.
    ``track_no`` is the number in two digits; with ``coerce_numbers=False`` only numbers given
    as text count. ``default_length`` replaces an absent model length. ``extra`` names a column for
    a map of all members that have no column.
    """
    entries = get("doc", TRACK_SECTION, kind="array<variant>")
    rows = parsed.select(F.col(key).alias("LP_ID"), F.posexplode(entries).alias("seq", "_track"))
    rows = rows.where(is_object("_track"))
    t = F.col("_track")
    length = get(t, "Track_Length")
    # Own columns for what is used several times, so that it is computed once.
    rows = rows.withColumn("_number", number_field(t)).withColumn(
        "_digits", F.regexp_extract(get("_number"), "[0-9]+", 0))
    number = S.zero_pad(S.empty_to_null(F.col("_digits")))
    return rows.select(
        "LP_ID", "seq",
        get(t, "Face").alias("Face"),
        get("_number").alias("Track Number"),
        default_if_absent(t, "Track_Name").alias("Track_Name"),
        default_if_absent(t, "Track_Composer").alias("Track_Composer"),
        (length if default_length is None
         else default_if_absent(t, "Track_Length", default_length)).alias("Track_Length"),
        (number if coerce_numbers else F.when(is_text(F.col("_number")), number)).alias("track_no"),
        *([other_members(t, [*TRACK_FIELDS, "Track Number"]).alias(extra)] if extra else []),
    )


#: Members that a schema may have; what has more is no set of columns.
MOST_MEMBERS = 2_000


def member_schema(parsed: DataFrame, section: str = GENERAL_SECTION) -> DataFrame:
    """``member, type``: all members that any document has in a section, with a type that fits all their values.

    Whole numbers are ``bigint``, with others among them ``double``; ``boolean`` and ``string`` stay; objects, arrays and
    members whose types clash become ``string``. A member that is always null is a ``string``. Values are
    reduced to one row per member and type before the shuffle.
    """
    values = parsed.select(F.explode(members(get("doc", section, kind="variant"))).alias("member", "value"))
    # A variant can't be compared, its type can.
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kinds = values.select("member", kind.alias("kind")).where("kind <> 'VOID'").distinct()
    only = kinds.groupBy("member").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))
    names = values.select("member").distinct()
    numbers = F.size(F.array_except("kinds", F.array(F.lit("BIGINT"), F.lit("DECIMAL"), F.lit("DOUBLE"), F.lit("FLOAT")))) == 0
    chosen = (
        F.when(F.col("kinds") == F.array(F.lit("BIGINT")), "bigint")
        .when(F.col("kinds") == F.array(F.lit("BOOLEAN")), "boolean")
        .when(numbers, "double").otherwise("string")
    )
    return names.join(only, "member", "left").select("member", F.coalesce(F.when(F.col("kinds").isNotNull(), chosen), F.lit("string")).alias("type"))


def wide_rows(parsed: DataFrame, schema: DataFrame, key: str = "lp_id", section: str = GENERAL_SECTION) -> DataFrame:
    """One row per document that has the section: ``LP_ID`` and a column per member of ``schema``, by name.

    ``schema`` is what ``member_schema`` found, in these documents or in earlier ones; it is small and comes to the
    driver, as columns must. A member called LP_ID is left out, as the album key counts.
    """
    columns = schema.where("member <> 'LP_ID'").orderBy("member").limit(MOST_MEMBERS + 1).collect()
    if len(columns) > MOST_MEMBERS:
        raise ValueError(f"more than {MOST_MEMBERS} members are no columns")
    value = get("doc", section, kind="variant")
    filled = F.when(F.size(members(value)) > 0, F.array(value))
    rows = parsed.select(F.col(key).alias("LP_ID"), F.explode(filled).alias("_section")).withColumn("_members", members("_section"))
    # By way of the map, as a path can't name every member.
    return rows.select("LP_ID", *[get(F.col("_members")[c["member"]], kind=c["type"]).alias(c["member"]) for c in columns])


def other_members(section: Column, declared: list[str]) -> Column:
    """Members of an object that are not declared, as a map of texts; null for anything but an object."""
    others = F.map_filter(members(section), lambda name, _: ~name.isin(declared))
    return F.transform_values(others, lambda _, value: get(value))


def number_field(track: Column) -> Column:
    """``Track Number``, or ``Track_Number`` where the former does not exist."""
    return F.coalesce(get(track, "Track Number", kind="variant"), get(track, "Track_Number", kind="variant"))


def default_if_absent(value: Column, name: str, default: str = MISSING) -> Column:
    """The member as text; ``default`` only where the key does not exist."""
    return F.when(has(value, name), get(value, name)).otherwise(default)


def rows_from_array(df: DataFrame, array: str, element: str) -> DataFrame:
    """One row per array element; the other columns repeat."""
    return df.withColumn(element, F.explode(array)).drop(array)


def rows_from_parallel_arrays(df: DataFrame, arrays: dict[str, str], position: str = "pos") -> DataFrame:
    """One row per position of several arrays; shorter arrays yield null.

    ``arrays`` maps array columns to the names of their elements.
    """
    zipped = F.arrays_zip(*[F.col(a).alias(a) for a in arrays])
    rest = [c for c in df.columns if c not in arrays]
    rows = df.select(*rest, F.posexplode(zipped).alias(position, "_zipped"))
    return rows.select(*rest, position, *[F.col("_zipped")[a].alias(e) for a, e in arrays.items()])


def union_sparse(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames whose columns differ; gaps are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
