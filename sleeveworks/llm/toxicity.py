"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs with one word between them of a whole text,
lower-cased, hashed into 2^18 places. The model is fitted on a bounded sample of labelled texts;
per-coordinate rates let rare features learn fast and the L1 penalty leaves most weights at zero, so
what is broadcast is a table of a megabyte whatever the corpus.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleeveworks.llm.flatbytes import flat, mix, pieces
from sleeveworks.llm.words import word_hashes, word_spans

BITS = 18
#: Labelled rows that the model is fitted on at most; they are those with the least hashes.
TRAINED = 10_000
#: Of the FTRL rule: rate, its smoothing, L1 and L2 penalties, and passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 16.0, 1.0, 4
#: Bytes of text worked on at a time.
BLOCK = 1 << 21
PAIR, SKIP = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of every feature of the texts in a flat array, repeats included, and its text."""
    begin, end, first = word_spans(data, at)
    words = word_hashes(data, begin, end)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    found, owners = [words], [text]
    for gap, salt in ((1, PAIR), (2, SKIP)):
        together = text[gap:] == text[:-gap] if len(text) > gap else np.zeros(0, bool)
        pairs = mix(words[:-gap][together] * salt + words[gap:][together]) if len(text) > gap else words[:0]
        found.append(pairs)
        owners.append(text[:-gap][together] if len(text) > gap else text[:0])
    place = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    return place, np.concatenate(owners)


def _distinct(place: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(owner << BITS | place)
    return key & ((1 << BITS) - 1), key >> BITS


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (order, label, text): order, label, places."""
    for batch in pieces(batches, 2, BLOCK):
        place, owner = _distinct(*features(*flat(batch.column(2))))
        offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["order", "label", "places"])


def fit(rows: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, places) in the order given."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    rows = [(label, np.append(places, size)) for label, places in rows]

    def weights(at) -> np.ndarray:
        part, root = z[at], np.sqrt(n[at])
        return np.where(np.abs(part) <= L1, 0.0, -(part - np.sign(part) * L1) / ((BETA + root) / ALPHA + L2))

    for _ in range(PASSES):
        for label, places in rows:
            w = weights(places)
            slope = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            step = (np.sqrt(n[places] + slope * slope) - np.sqrt(n[places])) / ALPHA
            z[places] += slope - step * w
            n[places] += slope * slope
    all_weights = weights(slice(None))
    return all_weights[:-1], float(all_weights[-1])


def _train(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("order")
    found, bias = fit([(int(y), np.asarray(x, np.int64)) for y, x in zip(rows["label"], rows["places"], strict=True)])
    used = np.flatnonzero(found)
    return pd.DataFrame({"place": np.append(used, -1), "weight": np.append(found[used], bias)})


def held_out(id: Column) -> Column:
    """Rows that are never learned from; a null id is not among them, but has no label either."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
          label: str = "toxic", rows: int = TRAINED) -> np.ndarray:
    """Weights by place, the bias last: at most ``rows`` labelled texts, none of them held out.

    Several labels of an id count as the highest; labels that are null, or whose id is, are left out. Rows
    that repeat an id are texts of their own and count towards the bound.
    Without any labelled text all weights are zero.
    """
    marked = labels.select(F.col(label_id).alias("_id"), F.col(label).alias("_label")).where(
        "_id IS NOT NULL AND _label IS NOT NULL").groupBy("_id").agg(F.max("_label").cast("int").alias("_label"))
    chosen = marked.where(~held_out(F.col("_id"))).withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(rows)
    # At most ``rows`` rows of two numbers are broadcast.
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id")
    texts = texts.orderBy("_order", "_id", F.xxhash64("_text")).limit(rows)
    sparse = texts.select("_order", "_label", "_text").mapInArrow(_featurise, "order long, label int, places array<int>")
    table = sparse.withColumn("sample", F.lit("all")).groupBy("sample").applyInPandas(_train, "place long, weight double").collect()
    model = np.zeros((1 << BITS) + 1)
    for place, weight in table:
        model[place] = weight
    return model


def _score(model, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        weights, bias = model.value[:-1], model.value[-1]
        for batch in pieces(batches, 2, BLOCK):
            place, owner = features(*flat(batch.column(2)))
            heavy = weights[place] != 0
            place, owner = _distinct(place[heavy], owner[heavy])
            total = np.bincount(owner, weights[place], minlength=batch.num_rows) + bias
            score = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], schema=schema)
    return run


def score(docs: DataFrame, model: np.ndarray, id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; a null or empty text gets the bias's score.

    Only the text is scored, so repeated texts score alike. Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), held_out(F.col(id)).alias("held_out"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_score(sent, threshold), "doc_id long, held_out boolean, score double, predicted int")
