"""Column expressions that cut JSON out of responses and put texts together."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sleeveworks.functions.scalars import empty_to_null, strip

# --- JSON inside a response -------------------------------------------------------------------


def brace_span(response: Column) -> Column:
    """From the first ``{`` to the last ``}``; null when there is no such span."""
    return empty_to_null(F.regexp_extract(response, r"(?s)\{.*\}", 0))


def fenced_object(response: Column) -> Column:
    """Body of the first json fence that holds an object; null when there is none."""
    return empty_to_null(F.regexp_extract(response, r"(?s)```json\s*(\{.*?\})\s*```", 1))


def fenced_body(response: Column) -> Column:
    """Stripped body of the first json fence, whatever it holds; null when there is none."""
    found = F.regexp_like(response, F.lit("(?s)```json.*?```"))
    return F.when(found, strip(F.regexp_extract(response, r"(?s)```json(.*?)```", 1)))


def drop_fences(response: Column) -> Column:
    """The response without its fence marks."""
    return F.replace(F.replace(response, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))


def chat_content(envelope: Column) -> Column:
    """Message text of the first choice of a chat answer."""
    return F.get_json_object(envelope, "$.choices[0].message.content")


def chat_usage(envelope: Column, counter: str) -> Column:
    """One counter of a chat answer, such as ``total_tokens``."""
    return F.get_json_object(envelope, f"$.usage.{counter}").cast("bigint")


# --- Assembly ---------------------------------------------------------------------------------


def blocks_in_reading_order(blocks: Column) -> Column:
    """Text blocks of one image, top to bottom, one per line.

    ``blocks`` is the array one recognition call returns: ``struct<x, y, seq, text>``. The blocks
    of an image arrive in one row, so ordering them needs no shuffle. Equal heights keep their
    order of detection (``seq``).
    """
    ordered = F.array_sort(F.transform(blocks, lambda b: F.struct(b["y"], b["seq"], b["text"])))
    return F.array_join(F.transform(ordered, lambda b: b["text"]), "\n")


def join_chunks(chunks: Column) -> Column:
    """Chunks of one streamed response, in order, without separator."""
    return F.array_join(chunks, "")


def cover_text(front: Column, back: Column) -> Column:
    """The two recognised covers as one document; an unread cover counts as empty."""
    return F.concat(
        F.lit("Front Cover:\n"), F.coalesce(front, F.lit("")),
        F.lit("\nBack Cover:\n"), F.coalesce(back, F.lit("")),
    )
