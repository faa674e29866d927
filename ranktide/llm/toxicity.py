"""Operator 8: toxicity by a counterfactual-regularised classifier.

A sparse logistic regression over hashed words and beginnings of words. For every labelled text that names a group of
people, a counterfactual is made by swapping each such term for another of its kind; training penalises the squared
change of the score, so that the mention of a group alone does not move it.

The classifier is fitted on at most ``per_class`` labelled documents of each class, those with the smallest id hash
(documented parameter). Every whole text is scored in tasks without a shuffle.

Defined results: null and empty texts have no features and get the score of the intercept; a document with several
labels is toxic if one says so; labels other than 0 and 1 and labels of unknown documents are ignored; without any
usable label every score is 0; repeated rows get a row each; an empty table gives an empty result; columns besides
doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktide.llm.language import remainder
from ranktide.llm.linear import Leader, sigmoid
from ranktide.llm.runtime import documents, ready, slices, table, to_batches
from ranktide.llm.textscan import LOWER, find_words, span_hashes, utf8

FEATURES = 1 << 18
PREFIXES = (4, 5, 6)
PER_CLASS = (3000, 1500)  # not toxic, toxic
EPOCHS = 8
FAIRNESS = 1.0
TOXIC_WEIGHT = 2.0  # toxic rows are the rarer class

# Terms that name groups of people, by kind; a counterfactual swaps a term for the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "arab"),
    ("immigrants", "natives", "refugees"),
)

# Words are runs of letters and digits; bytes of longer characters count as letters.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[48:58] = BETWEEN[65:91] = BETWEEN[97:123] = BETWEEN[128:] = False


def swaps(kinds: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> dict[str, str]:
    return {term: kind[(i + 1) % len(kind)] for kind in kinds for i, term in enumerate(kind)}


def _lower(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented capitals of Latin-1."""
    lowered = LOWER[data]
    accented = np.zeros(len(data), dtype=bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lowered[accented] += 0x20
    return lowered


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of every word and its beginnings, and the text of each; with repetitions."""
    data = _lower(data)
    words = find_words(data, bounds, BETWEEN)
    parts = [span_hashes(data, words.starts, words.ends)]
    for k in PREFIXES:
        head = span_hashes(data, words.starts, np.minimum(words.starts + k, words.ends))
        parts.append(head * np.uint64(2 * k + 1))
    index = (np.concatenate(parts) >> np.uint64(40)) % np.uint64(FEATURES)
    return index.astype(np.int64), np.tile(words.text, len(parts))


def distinct_features(text: str) -> np.ndarray:
    data, bounds = utf8(pa.array([text], pa.string()))
    return np.unique(features(data, bounds)[0])


def counterfactual(text: str, swap: dict[str, str]) -> str | None:
    """The text in lower case with every group term swapped; None if it has none."""
    data, bounds = utf8(pa.array([text], pa.string()))
    words = find_words(data, bounds, BETWEEN)
    lowered = _lower(data).tobytes()
    pieces, end, found = [], 0, False
    terms = {k.encode(): v.encode() for k, v in swap.items()}
    for s, e in zip(words.starts.tolist(), words.ends.tolist(), strict=True):
        if (other := terms.get(lowered[s:e])) is not None:
            pieces += [lowered[end:s], other]
            end, found = e, True
    return b"".join([*pieces, lowered[end:]]).decode("utf-8", "replace") if found else None


@dataclass
class ToxicityModel:
    index: np.ndarray  # features with a weight, ascending
    weights: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        found, owner = features(data, bounds)
        dense = np.zeros(FEATURES, dtype=np.float32)
        dense[self.index] = self.weights
        weighted = dense[found] != 0
        key = np.unique(owner[weighted] * FEATURES + found[weighted])
        return sigmoid(self.intercept + np.bincount(key // FEATURES, weights=dense[key % FEATURES], minlength=n))


def _examples(swap: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("toxic", pa.int32()), ("_hash", pa.int64()), ("features", pa.binary()), ("swapped", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            other = [counterfactual(t, swap) for t in texts]
            yield to_batches(
                {
                    "toxic": batch.column("toxic"),
                    "_hash": batch.column("_hash"),
                    "features": [distinct_features(t).astype("<u4").tobytes() for t in texts],
                    "swapped": [None if o is None else distinct_features(o).astype("<u4").tobytes() for o in other],
                },
                schema,
            )

    return make


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_class: tuple[int, int] = PER_CLASS,
    fairness: float = FAIRNESS,
    kinds: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
) -> ToxicityModel | None:
    """Learns from the documents of ``docs`` that ``labels`` (doc_id, toxic) marks; None without a usable label."""
    spark = ready(docs.sparkSession)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = Window.partitionBy("toxic").orderBy("_hash", "doc_id")
    ranked = marked.withColumn("_hash", F.xxhash64(F.col("doc_id").cast("string"))).withColumn("_n", F.row_number().over(order))
    bound = F.when(F.col("toxic") == 1, F.lit(per_class[1])).otherwise(F.lit(per_class[0]))
    chosen = ranked.where((F.col("_n") <= max(per_class)) & (F.col("_n") <= bound)).drop("_n").collect()  # bounded by per_class
    if not chosen:
        return None
    sample = spark.createDataFrame(chosen, "doc_id long, toxic int, _hash long")
    texts = documents(docs).join(F.broadcast(sample), "doc_id")
    schema = "toxic int, _hash long, features binary, swapped binary"
    rows = texts.select("text", "toxic", "_hash").mapInArrow(_examples(swaps(kinds)), schema=schema).collect()
    return fit(rows, fairness) if rows else None


def fit(rows: list, fairness: float) -> ToxicityModel:
    numbers = lambda packed: np.frombuffer(bytes(packed), dtype="<u4").astype(np.int64)
    rows = sorted(rows, key=lambda r: (r["_hash"], bytes(r["features"])))
    # No weight is negative, so that no amount of harmless text around an insult hides it.
    leader = Leader(FEATURES, 1, rate=0.5, smooth=1.0, l1=6.0, l2=0.1, rising=True)
    for _ in range(EPOCHS):
        for row in rows:
            here = numbers(row["features"])
            index, values = leader.extend((here, np.ones(len(here))))
            weights = leader.rows(index)
            error = (sigmoid(values @ weights)[0] - row["toxic"]) * (TOXIC_WEIGHT if row["toxic"] else 1.0)
            leader.step(index, weights, (values * error)[:, None])
            if row["swapped"] is not None and fairness:
                there = numbers(row["swapped"])
                moved = np.setxor1d(here, there)
                sign = np.where(np.isin(moved, here), 1.0, -1.0)
                weights = leader.rows(moved)
                change = float(sign @ weights[:, 0])
                leader.step(moved, weights, (2 * fairness * change * sign)[:, None])
    weights, intercept = leader.weights()
    index = np.flatnonzero(weights[:, 0])
    return ToxicityModel(index, weights[index, 0], float(intercept[0]))


def _scorer(model: ToxicityModel | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, bounds = utf8(batch.column("text"))
            scores = model.scores(data, bounds) if model else np.zeros(batch.num_rows)
            yield to_batches({"doc_id": batch.column("doc_id"), "score": scores}, schema)

    return score


def score(df: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every row of ``df``."""
    ready(df.sparkSession)
    scored = documents(df).mapInArrow(_scorer(model), schema="doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs.where(remainder(5) != 0), labels.where(remainder(5) != 0))
    return score(docs, model).select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")
