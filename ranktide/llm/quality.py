"""Operator 9: quality by weak supervision.

Rules look at a whole text and vote good, bad or abstain. Expectation-maximisation over the counts of all
vote patterns estimates, without labels, how often each rule is right about good and about bad documents;
a document is kept if the posterior probability of being good reaches the threshold.

The statistics come from one numpy pass in each task. What travels is one row of counts per document; what
the driver sees is the table of vote patterns, of at most 3 ** len(RULES) rows whatever the input.

Defined results: null and empty texts, and texts of white space, have zero words and counts and fail the base
rules; repeated rows and repeated ids give a row each; a null ``doc_id`` stays null; an empty table gives an empty
result with the same columns; columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.runtime import documents, ready, slices, table, to_batches
from ranktide.llm.textscan import SPACE, find_lines, find_words, mix, owners, per_text, runs_of, span_hashes, utf8

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.5

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"[#*$%&|<>]")] = True
SYMBOL[list(b"[]")] = False
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
ASCII_LETTER = UPPER.copy()
ASCII_LETTER[97:123] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
END_MARK = np.zeros(256, dtype=bool)
END_MARK[list(b".!?;:,")] = True
BANG = np.zeros(256, dtype=bool)
BANG[list(b"!?")] = True

SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [
        (name, pa.int64())
        for name in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_ascii_letters", "n_letters", "n_digits", "n_bangs", "n_line_ends", "n_distinct_words",
        )
    ]
)


def _duplicates(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def _distinct(keys: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct keys of each text."""
    order = np.lexsort((keys, texts))
    keys, texts = keys[order], texts[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1])
    return np.bincount(texts[fresh], minlength=n)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, bounds = utf8(batch.column("text"))
        n = batch.num_rows
        words = find_words(data, bounds)
        hashes = span_hashes(data, words.starts, words.ends)
        windows, first = runs_of(hashes, words, WINDOW)
        repeated = first[_duplicates(mix(windows + words.text[first].astype(np.uint64)))]
        change = np.zeros(len(hashes) + 1, dtype=np.int64)
        np.add.at(change, repeated, 1)
        np.add.at(change, repeated + WINDOW, -1)
        starts, ends = find_lines(data, bounds)
        spoken = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
        starts, ends = starts[spoken], ends[spoken]
        line_of = owners(bounds, starts)
        lines = np.bincount(line_of, minlength=n)
        letter = ASCII_LETTER[data]
        head = data >= 0xC3
        yield to_batches(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": words.bounds[1:] - words.bounds[:-1],
                "word_chars": per_text((data & 0xC0 != 0x80) & ~SPACE[data], bounds),
                "n_symbols": per_text(SYMBOL[data], bounds),
                "n_dup_lines": lines - _distinct(span_hashes(data, starts, ends), line_of, n),
                "n_repeat_words": per_text(np.cumsum(change[:-1]) > 0, words.bounds),
                "n_lines": lines,
                "n_upper": per_text(UPPER[data], bounds),
                "n_ascii_letters": per_text(letter, bounds),
                "n_letters": per_text(letter | head, bounds),
                "n_digits": per_text(DIGIT[data], bounds),
                "n_bangs": per_text(BANG[data], bounds),
                "n_line_ends": np.bincount(line_of[END_MARK[data[np.maximum(_last(words, ends), 0)]]], minlength=n),
                "n_distinct_words": _distinct(hashes, words.text, n),
            },
            SCHEMA,
        )


def _last(words, ends: np.ndarray) -> np.ndarray:
    """The last byte of the last word before each line's end; the line has a word."""
    return words.ends[np.searchsorted(words.starts, ends) - 1] - 1 if len(ends) else np.zeros(0, dtype=np.int64)


def measures(df: DataFrame) -> DataFrame:
    """One row of counts per document, with ``base_failed``."""
    ready(df.sparkSession)
    counted = documents(df).mapInArrow(_measure, schema=_ddl(SCHEMA))
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} long" for f in schema)


def _vote(good, bad):
    return F.when(good, F.lit(1)).when(bad, F.lit(-1)).otherwise(F.lit(0))


def _share(part: str, whole: str):
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


def rules() -> dict[str, object]:
    """The votes: 1 good, -1 bad, 0 abstains.

    A rule that looks for one fault votes bad where it finds it and otherwise abstains, as the lack of one fault
    says little; good votes come from prose-like lines, plain words and a varied vocabulary.
    """
    length, long_enough = _share("word_chars", "n_words"), F.col("n_words") >= 40
    never = F.lit(False)
    return {
        "v_prose": _vote(
            (_share("n_line_ends", "n_lines") >= 0.6)
            & (_share("n_letters", "word_chars") >= 0.8)
            & (_share("n_symbols", "n_words") <= 0.1)
            & (_share("n_upper", "n_ascii_letters") <= 0.15),
            never,
        ),
        "v_variety": _vote(
            long_enough & (_share("n_distinct_words", "n_words") >= 0.3),
            long_enough & (_share("n_distinct_words", "n_words") < 0.15),
        ),
        "v_word_length": _vote(length.between(3, 9), (length < 2) | (length > 14)),
        "v_short": _vote(never, F.col("n_words") < MIN_WORDS),
        "v_symbols": _vote(never, _share("n_symbols", "n_words") > 0.1),
        "v_dup_lines": _vote(never, _share("n_dup_lines", "n_lines") > 0.3),
        "v_repeats": _vote(never, _share("n_repeat_words", "n_words") > 0.2),
        "v_upper": _vote(never, _share("n_upper", "n_ascii_letters") > 0.4),
        "v_letters": _vote(never, _share("n_letters", "word_chars") < 0.75),
        "v_bangs": _vote(never, _share("n_bangs", "n_words") > 0.2),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, weight: float = 5.0) -> np.ndarray:
    """Posterior probability of "good" for each vote pattern.

    ``patterns`` holds distinct votes and how many documents have them. The model has a class prior and, for each
    rule and class, the chances of its three votes; ``weight`` pseudo-counts favour the vote that fits the class,
    which names the classes. It starts from the balance of votes.
    """
    if not patterns:
        return np.zeros(0)
    votes = np.array([p for p, _ in patterns])
    counts = np.array([n for _, n in patterns], dtype=float)
    good = 1 / (1 + np.exp(-2.0 * votes.sum(axis=1)))
    for _ in range(rounds):
        prior = (counts @ good + weight) / (counts.sum() + 2 * weight)
        score = np.full(len(votes), math.log(prior) - math.log(1 - prior))
        for j in range(votes.shape[1]):
            seen = [[counts @ (p * (votes[:, j] == v)) for v in (-1, 0, 1)] for p in (good, 1 - good)]
            chance = np.array(seen) + weight * np.array([[0.1, 0.5, 0.4], [0.4, 0.5, 0.1]])
            chance /= chance.sum(axis=1, keepdims=True)
            score += (np.log(chance[0]) - np.log(chance[1]))[votes[:, j] + 1]
        fresh = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        if np.max(np.abs(fresh - good)) < 1e-9:
            return fresh
        good = fresh
    return good


def judge(df: DataFrame, threshold: float = KEEP_AT) -> DataFrame:
    """All counts and votes, the posterior ``quality`` and the verdict ``kept`` of each document."""
    votes = rules()
    voted = measures(df).withColumns(votes)
    counted = voted.groupBy(*votes).count().orderBy(*votes).collect()  # at most 3 ** len(votes) rows
    patterns = [(tuple(row[name] for name in votes), row["count"]) for row in counted]
    code = lambda row: sum((v + 1) * 3**i for i, v in enumerate(row))
    by_pattern = {code(p): float(q) for (p, _), q in zip(patterns, fit(patterns), strict=True)}
    spark = df.sparkSession
    posterior = spark.createDataFrame(sorted(by_pattern.items()), "_pattern long, quality double")
    key = sum((F.col(name) + 1) * 3**i for i, name in enumerate(votes)).cast("long")
    scored = voted.withColumn("_pattern", key).join(F.broadcast(posterior), "_pattern", "left").drop("_pattern")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


CONTRACT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(*CONTRACT, "quality")
