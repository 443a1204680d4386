"""Mixing sources to target weights by iterative proportional fitting, in SQL functions only.

Documents fall into cells of source, language and topic. The cells' token weights are raked: in turn, the
cells of every source, language and topic are scaled to that one's target share, for a fixed number of
rounds. A document is then kept with its cell's probability: the fitted share over the cell's own,
times the share of tokens to keep. The draw depends on the seed and the id alone.

No cell can give more tokens than it has. A cell whose scaled share passes that bound is held there, and
the others of the same value are scaled on, so that the draw meets the targets and not only the weights.
A value whose target is above all its tokens is taken whole, and the rest of its target goes to the other
values of its dimension, in proportion.

Only cells are raked, so the work of the rounds doesn't grow with the documents.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sleeveworks.session import new_shared_path

DIMENSIONS = ("source", "lang", "topic")
#: Topics by what a text holds, the first that fits; the rest is prose.
TOPICS = {"legal": "(?i)licen[sc]e|copyright", "contact": "@", "tabular": " [|] ", "markup": "[#*$%&<>]{2,}"}
#: Target share of a value is its tokens to this power; 1 keeps the mixture, 0 makes all values equal.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.9}
ROUNDS = 12
#: The draw is a number of so many bits.
DRAW_BITS = 48


def topic_of(text: Column, topics: dict[str, str] = TOPICS) -> Column:
    found = F.lit("prose")
    for name, pattern in reversed(topics.items()):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return found


def draw(id: Column, seed: int) -> Column:
    """A number from 0 up to 1 for an id; null ids have one number."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), id.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("double") / F.lit(float(2**DRAW_BITS))


def with_factor(rows: DataFrame, value: str, bound: Column, total: Column, group: list[str]) -> DataFrame:
    """``rows`` with ``_factor``: what to scale ``value`` by, so that least(``value`` * factor, ``bound``) sums
    up to ``total`` in each group.

    Rows reach their bounds in the order of bound to value. Were the first so many held, the others would
    need (total - held) / (sum of the others); the sum is concave, so the largest of these is the factor.
    """
    ratio = F.try_divide(bound, F.col(value))
    rising = W.partitionBy(*group).orderBy(ratio.asc(), *DIMENSIONS).rowsBetween(W.unboundedPreceding, -1)
    falling = W.partitionBy(*group).orderBy(ratio.desc(), *[F.col(d).desc() for d in DIMENSIONS]).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    held = F.coalesce(F.sum(F.when(F.col(value) > 0, bound).otherwise(0.0)).over(rising), F.lit(0.0))
    rows = rows.withColumn("_factor", F.try_divide(total - held, F.sum(value).over(falling)))
    largest = F.max("_factor").over(W.partitionBy(*group))
    return rows.withColumn("_factor", F.greatest(F.coalesce(largest, F.lit(0.0)), F.lit(0.0)))


def rake(cells: DataFrame, temper: dict[str, float], targets: dict[str, dict[str, float]], rounds: int,
         keep: float | None = None) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``weight``: the fitted share of all tokens.

    ``targets`` gives shares of single values outright, relative to the tempered ones of the others.
    With ``keep``, the share of tokens to draw, no weight is above what its cell can give to the draw.
    """
    rows = cells.withColumn("weight", F.col("tokens").cast("double"))
    if keep:
        rows = rows.withColumn("_bound", F.coalesce(F.try_divide(
            F.col("tokens"), F.sum("tokens").over(W.partitionBy()) * F.lit(float(keep))), F.lit(0.0)))
    for name, power in temper.items():
        own = F.sum("tokens").over(W.partitionBy(name)).cast("double")
        share = F.when(own > 0, F.pow(own, F.lit(float(power)))).otherwise(0.0)
        fixed = targets.get(name, {})
        for value, weight in fixed.items():
            share = F.when(F.col(name) == value, F.lit(float(weight)) * (own > 0).cast("double")).otherwise(share)
        rows = rows.withColumn(f"_{name}", share)
    for name in temper:
        # One row per value carries the value's share into the total.
        first = F.row_number().over(W.partitionBy(name).orderBy(*DIMENSIONS)) == 1
        rows = rows.withColumn("_once", F.when(first, F.col(f"_{name}")).otherwise(0.0))
        rows = rows.withColumn(f"_{name}", F.try_divide(F.col(f"_{name}"), F.sum("_once").over(W.partitionBy()))).drop("_once")
        if keep:
            supply = F.sum("_bound").over(W.partitionBy(name))
            rows = rows.withColumn("_supply", supply).withColumn("_once", F.when(first, F.col(f"_{name}")).otherwise(0.0))
            rows = with_factor(rows, "_once", F.col("_supply"), F.lit(1.0), [])
            rows = rows.withColumn(f"_{name}", F.least(F.col(f"_{name}") * F.col("_factor"), F.col("_supply"))).drop("_once", "_supply")
    for _ in range(rounds):
        if keep:
            # Written down each round: the plan of all rounds at once is too deep.
            path = new_shared_path(cells.sparkSession, "cells")
            rows.write.parquet(path)
            rows = cells.sparkSession.read.schema(rows.schema).parquet(path).coalesce(1)
        for name in temper:
            if keep:
                rows = with_factor(rows, "weight", F.col("_bound"), F.col(f"_{name}"), [name])
                rows = rows.withColumn("weight", F.col("weight") * F.col("_factor"))
                continue
            total = F.sum("weight").over(W.partitionBy(name))
            rows = rows.withColumn("weight", F.coalesce(F.try_divide(F.col("weight") * F.col(f"_{name}"), total), F.lit(0.0)))
    if keep:
        rows = rows.withColumn("weight", F.least("weight", "_bound"))
    return rows.drop("_bound", "_factor", *[f"_{n}" for n in temper])


def calibrated(docs: DataFrame, keep: float = 0.5, seed: int = 7, id: str = "doc_id", text: str = "text",
               source: str = "source", lang: str = "lang", temper: dict[str, float] | None = None,
               targets: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS, prefix: str = "",
               bounded: bool = True) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and kept, each name after ``prefix``.

    Tokens are words between white space; a null text has none. Null sources and languages are values
    of their own. Repeated rows are drawn alike. Columns with the new names are replaced; an empty
    table stays empty. Unless ``bounded``, weights are raked without regard to what cells can give, and
    probabilities above 1 are cut off: then the draw misses the targets of such cells.
    """
    p = prefix
    # The row travels as one, whatever its columns' names.
    names = [c for c in docs.columns if c not in [f"{p}{n}" for n in ("topic", "n_tokens", "probability", "kept")]]
    row = F.struct(*[F.col(f"`{c}`") for c in names] or [F.lit(0).alias("none")])
    docs = docs.select(row.alias("row"), F.col(id).alias("id"), F.col(source).alias("source"), F.col(lang).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = docs.select("row", "id", "source", "lang", topic_of(F.col("body")).alias("topic"),
                       F.size(F.array_remove(F.split("body", "[\\x20\\x09-\\x0D]+"), "")).cast("long").alias("n_tokens"))
    cells = rows.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"))
    fitted = rake(cells, temper or TEMPER, targets or {}, rounds, keep if bounded else None)
    share = F.col("tokens") / F.sum("tokens").over(W.partitionBy())
    chance = F.least(F.lit(1.0), F.coalesce(F.lit(float(keep)) * F.try_divide(F.col("weight"), share), F.lit(1.0)))
    table = fitted.select(F.col("source").alias("s"), F.col("lang").alias("l"), F.col("topic").alias("t"), F.round(chance, 9).alias("probability"))
    same = F.col("source").eqNullSafe(F.col("s")) & F.col("lang").eqNullSafe(F.col("l")) & (F.col("topic") == F.col("t"))
    new = {"topic": F.col("topic"), "n_tokens": F.col("n_tokens"), "probability": F.col("probability"),
           "kept": draw(F.col("id"), seed) < F.col("probability")}
    return rows.join(table, same).select(*[F.col(f"row.`{c}`").alias(c) for c in names], *[c.alias(f"{p}{n}") for n, c in new.items()])


def mixture_report(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Topic, tokens, probability and decision for every document, without its text."""
    rows = docs.select(F.col(id).alias("doc_id"), F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    return calibrated(rows).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept")


def sample_mixture(docs: DataFrame) -> DataFrame:
    """The documents drawn, with the columns of ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    drawn = calibrated(docs.select(row.alias("whole"), "doc_id", "text", "source", "lang")).where("kept")
    return drawn.select("whole.*")
