"""Operator 4: language identification.

Texts become TF-IDF vectors of hashed character 2- and 3-grams. A sparse multinomial logistic regression is
trained on them with follow-the-regularised-leader and elastic-net penalties, and a temperature, fitted on
sample rows that the training did not see, calibrates its probabilities.

Document frequencies are counted over all training documents. The classifier is fitted on at most ``per_language``
documents of each language, those with the smallest hash of their id (documented parameter). Every whole text is scored,
in tasks without a shuffle; the model of FEATURES x languages numbers travels with the code.

Defined results: null texts and texts without a letter get ``und`` with score 0, as does everything if no row has
a language to learn from; a null ``doc_id`` counts as the empty string in the split; repeated rows get a row each; an
empty table gives an empty result; columns besides doc_id, text and (for learning) lang are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ranktide.llm.linear import Example, Leader, softmax
from ranktide.llm.runtime import documents, give_back, lean, ready, slices, table, to_batches
from ranktide.llm.textscan import mix

FEATURES = 1 << 14
ORDERS = (2, 3)
PER_LANGUAGE = 500
EPOCHS = 4
UNKNOWN = "und"
ROWS_AT_ONCE = 32  # a row takes 128 KB of counts, and some tables of half that size beside them


def remainder(modulus: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, lower-cased, and the index of the text of each; none crosses texts."""
    lowered = [t.lower() + "\n\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    hashes, texts_of = [], []
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            continue
        value = np.zeros(n, dtype=np.uint64)
        for j in range(order):
            value = (value << np.uint64(21)) | points[j : j + n]
        inside = owner[:n] == owner[order - 1 :]
        hashes.append((mix(value[inside] + np.uint64(order)) % np.uint64(FEATURES)).astype(np.int64))
        texts_of.append(owner[:n][inside])
    if not hashes:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(texts_of)


def counts(texts: list[str]) -> np.ndarray:
    """One row of n-gram counts per text."""
    hashed, owner = grams(texts)
    return np.bincount(owner * FEATURES + hashed, minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in _pieces(batches):
        total += (counts(_texts(batch)) > 0).sum(axis=0)
        rows += batch.num_rows
    schema = pa.schema([("feature", pa.int32()), ("df", pa.int64())])
    if rows:
        there = np.flatnonzero(total)
        yield to_batches({"feature": np.append(there, -1), "df": np.append(total[there], rows)}, schema)


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("features", pa.binary()), ("counts", pa.binary())])
    for batch in _pieces(batches):
        table = counts(_texts(batch))
        there = [np.flatnonzero(row) for row in table]
        yield to_batches(
            {
                "doc_id": batch.column("doc_id"),
                "lang": batch.column("lang"),
                "features": [i.astype("<u2").tobytes() for i in there],
                "counts": [row[i].astype("<u4").tobytes() for row, i in zip(table, there, strict=True)],
            },
            schema,
        )


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    intercept: np.ndarray
    temperature: float = 1.0

    def vectors(self, table: np.ndarray) -> np.ndarray:
        """TF-IDF with damped frequencies, of unit length."""
        values = np.log1p(table.astype(np.float32)) * self.idf
        return values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-9)

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return softmax((self.vectors(counts(texts)) @ self.weights + self.intercept) / self.temperature)


def _temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of least log loss, to a hundredth of its logarithm."""
    grid = np.exp(np.arange(-3.0, 3.0, 0.01))
    loss = [-np.log(softmax(scores / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _cutoffs(labelled: DataFrame, per_language: int) -> list[tuple[str, int]]:
    """For each language the id hash up to which rows are in the sample."""
    order = Window.partitionBy("lang").orderBy("_hash")
    ranked = labelled.select("lang", "_hash").withColumn("_n", F.row_number().over(order))
    kept = ranked.where(F.col("_n") <= per_language).groupBy("lang").agg(F.max("_hash").alias("cut"))
    return [(r["lang"], r["cut"]) for r in kept.orderBy("lang").collect()]


def train(df: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Learns from the rows of ``df`` (doc_id, text, lang) with a language; None if there are none."""
    ready(df.sparkSession)
    labelled = documents(df, "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.withColumn("_hash", F.xxhash64(F.col("doc_id").cast("string")))
    cutoffs = _cutoffs(labelled, per_language)
    if not cutoffs:
        return None
    partial = labelled.select("text").mapInArrow(lean(_document_frequencies), schema="feature int, df long")
    frequency = {r["feature"]: r["df"] for r in partial.groupBy("feature").agg(F.sum("df").alias("df")).collect()}
    rows = frequency.pop(-1)
    df_of = np.zeros(FEATURES)
    df_of[list(frequency)] = list(frequency.values())
    idf = (np.log((1 + rows) / (1 + df_of)) + 1).astype(np.float32)

    chosen = labelled.join(F.broadcast(df.sparkSession.createDataFrame(cutoffs, "lang string, _cut long")), "lang")
    chosen = chosen.where(F.col("_hash") <= F.col("_cut")).select("doc_id", "text", "lang")
    packed = chosen.mapInArrow(lean(_sparse_counts), schema="doc_id long, lang string, features binary, counts binary")
    sample = packed.select(F.xxhash64(F.col("doc_id").cast("string")).alias("_hash"), "*").collect()
    # Ties of the hash, as repeated ids make them, could exceed the bound; the content then decides.
    sample.sort(key=lambda r: (r["_hash"], r["lang"], bytes(r["features"]), bytes(r["counts"])))
    taken: dict[str, int] = {}
    bounded = []
    for row in sample:
        taken[row["lang"]] = taken.get(row["lang"], 0) + 1
        if taken[row["lang"]] <= per_language:
            bounded.append(row)
    model = _fit([lang for lang, _ in cutoffs], idf, bounded)
    del sample, bounded
    give_back()
    return model


def _fit(languages: list[str], idf: np.ndarray, sample: list) -> LanguageModel:
    def vector(row) -> tuple[Example, int]:
        index = np.frombuffer(bytes(row["features"]), dtype="<u2").astype(np.int64)
        values = np.log1p(np.frombuffer(bytes(row["counts"]), dtype="<u4").astype(np.float64)) * idf[index]
        return (index, values / max(np.linalg.norm(values), 1e-9)), languages.index(row["lang"])

    # Vectors are made anew each time, as they take several times what the packed rows do.
    kept_back = sample[::5] if len(sample) >= 50 else sample
    training = [row for i, row in enumerate(sample) if i % 5] if len(sample) >= 50 else sample
    leader = Leader(FEATURES, len(languages), rate=0.5, smooth=1.0, l1=0.02, l2=0.01)
    for _ in range(EPOCHS):
        for example, label in map(vector, training):
            index, values = leader.extend(example)
            weights = leader.rows(index)
            error = softmax(values @ weights)
            error[label] -= 1
            leader.step(index, weights, np.outer(values, error))
    weights, intercept = leader.weights()
    scores = np.array([v @ weights[i] + intercept for (i, v), _ in map(vector, kept_back)])
    truth = np.array([languages.index(row["lang"]) for row in kept_back])
    return LanguageModel(languages, idf, weights, intercept, _temperature(scores, truth))


def _scorer(model: LanguageModel | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            texts = _texts(batch)
            known = np.array([any(map(str.isalpha, t)) for t in texts]) & (model is not None)
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known.any():
                chances = model.probabilities(texts)
                best = chances.argmax(axis=1)
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores = np.where(known, chances[np.arange(len(texts)), best], 0.0)
            added = [pa.array(names, pa.string()), pa.array(scores.astype(float), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "lang_pred", "score"])

    return score


def identify(df: DataFrame, model: LanguageModel | None) -> DataFrame:
    """All columns of ``df`` with ``lang_pred`` and its calibrated probability ``score``, for every row.

    Columns of these names that ``df`` may have are replaced.
    """
    ready(df.sparkSession)
    typed = df.drop("lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    added = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return typed.mapInArrow(lean(_scorer(model)), schema=T.StructType(typed.schema.fields + added.fields))


def accepted(df: DataFrame, model: LanguageModel | None, min_score: float = 0.35) -> DataFrame:
    """The rows of ``df`` whose language is recognised; a missing ``lang`` is filled in."""
    known = identify(df, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*df.columns)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(remainder(3) != 1))
    scored = identify(documents(docs), model)
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")
