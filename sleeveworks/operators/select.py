"""Natural order of albums and selection by position."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sleeveworks.functions.scalars import natural_key
from sleeveworks.session import shared_dir


@dataclass(frozen=True)
class Selection:
    """Positions ``first..last`` counted from 1, from the end if ``reverse``; None is unbounded."""

    first: int = 1
    last: int | None = None
    reverse: bool = False


def parse_selection(text: str, parity: bool = False) -> Selection:
    """``all``, ``N``, ``first-N``, ``last-N`` or ``A-B``; positions, not album numbers."""
    usage = ValueError(f"not a selection: {text!r}; use all, N, first-N, last-N or A-B")
    if text == "all":
        return Selection()
    head, dash, tail = (part.strip() for part in text.partition("-"))
    if not dash:
        head, tail = "first", head
    if not (tail.isascii() and tail.isdigit()):
        raise usage
    n = int(tail)
    if head == "last":
        # A count of 0 from the end used to mean everything.
        return Selection() if parity and n == 0 else Selection(1, n, reverse=True)
    if head == "first":
        return Selection(1, n)
    if not (head.isascii() and head.isdigit()) or int(head) < 1:
        raise usage
    return Selection(int(head), n)


def album_names(df: DataFrame, key: str = "lp_id", prefix: str = "LP") -> DataFrame:
    return df.where(F.col(key).startswith(prefix)).select(key).distinct()


def natural_order(key: str = "lp_id", reverse: bool = False) -> list[Column]:
    """By first number, then by name; names without a number come last."""
    number, name = natural_key(F.col(key)), F.col(key)
    if reverse:
        return [number.desc_nulls_first(), name.desc()]
    return [number.asc_nulls_last(), name.asc()]


def natural_sort(albums: DataFrame, key: str = "lp_id") -> DataFrame:
    return albums.orderBy(*natural_order(key))


def with_position(albums: DataFrame, key: str = "lp_id", reverse: bool = False) -> DataFrame:
    """Add ``position`` (from 1) in natural order, or from its end, without one task that sees all rows.

    A range sort gives every row a partition and an index in it; that is written down when it is
    first needed, so that a repeated task cannot move rows. What remains is a running sum over
    partition sizes.
    """
    shared_dir(albums.sparkSession)
    index_bits = 33
    ordered = albums.orderBy(*natural_order(key, reverse))
    placed = ordered.withColumn("_slot", F.monotonically_increasing_id()).checkpoint(eager=False)
    part = F.shiftright("_slot", index_bits)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    # One row per partition of the sort.
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    index = F.col("_slot").bitwiseAND(F.lit((1 << index_bits) - 1))
    return joined.withColumn("position", F.col("_before") + index + 1).drop("_slot", "_part", "_before")


#: Up to this position albums are selected without ordering the others.
TOP = 100_000


def select_positions(albums: DataFrame, selection: str | Selection, key: str = "lp_id",
                     parity: bool = False) -> DataFrame:
    """Albums at the selected positions of the natural order.

    What is asked for decides how: for positions up to ``TOP`` every task keeps its own first ones and the
    first of these are taken; beyond, all albums are placed (``with_position``).
    """
    chosen = parse_selection(selection, parity) if isinstance(selection, str) else selection
    if chosen.last is None:
        return natural_sort(albums, key)
    if chosen.last <= TOP:
        first = albums.orderBy(*natural_order(key, chosen.reverse)).limit(chosen.last).offset(chosen.first - 1)
        return natural_sort(first, key) if chosen.reverse else first
    placed = with_position(albums, key, chosen.reverse)
    return natural_sort(placed.where(F.col("position").between(chosen.first, chosen.last)).drop("position"), key)
