"""Operator 11: grouping of spelling variants by pivotal grams.

Words are counted over the whole corpus. Two words are near if one inserted, deleted or replaced code point makes one of the
other. Candidates come from pivotal grams: a word's bigrams are ordered from the rarest to the most frequent over all words;
its first three are its prefix, and dynamic programming picks the two disjoint ones of them with the least frequency as
pivots. One edit can destroy only one of two disjoint bigrams, so of two near words the one whose prefix ends earlier in the
order has a pivot that is also in the other's prefix, shifted by one position at most.

Postings are also dealt out by halves: where one edit lies, either the first or the last half of the shorter word is untouched
and is found in both. A pivot and a gram meet only if one of these halves is the same too, which loses no pair and keeps a
frequent bigram from gathering its words in one place. Pairs that meet within the position limit are verified exactly.

A word's form is its near word of the largest count, if that count is at least twice its own; counts at least double along
forms, so following them ends, and doubling the steps finds every root in a logarithmic number of rounds.

Defined results: null and empty texts have no words; a null doc_id counts as an empty string before the colon of the hash;
rows that repeat a doc_id count each; an empty table gives an empty result; texts of any length are worked through in sections; other
columns are ignored, whatever their names; ties between forms go to the smallest word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.runtime import documents, ready, slices, table, to_batches
from ranktide.session import freeze

MIN_CHARS = 5
MIN_COUNT = 3
DAMAGE_EVERY = 97  # a run whose hash this divides loses one code point
TIMES = 2  # how much more frequent a form is than its variant
GRAM, EDITS = 2, 1
PREFIX = GRAM * EDITS + 1  # bigrams that one edit can reach, and one more
HELD = 400_000
SECTION_BYTES = 1 << 22

# Letters of UTF-8 text with A-Z lowered: a-z, and U+00C0 to U+00FF, which are the bytes C3 80 to C3 BF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
PART_OF_RUN = re.compile(rb"[a-z\x80-\xbf\xc3]*")


def runs(text: str | None, size: int = SECTION_BYTES) -> Counter:
    """How often each maximal run of letters occurs, as UTF-8 with A-Z lowered."""
    data = (text or "").encode().lower()  # bytes.lower changes A-Z only
    found, start = Counter(), 0
    while start < len(data):
        end = PART_OF_RUN.match(data, min(start + size, len(data))).end()
        found.update(RUN.findall(data, start, end))
        start = end
    return found


def damaged(run: bytes, hashed: int) -> bytes:
    """The run without the code point that its hash names."""
    letters = run.decode()
    at = hashed % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counted(every: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def passed_on(total: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(total), type=pa.binary()).cast(pa.string())
        return to_batches({"word": words, "n": list(total.values())}, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                for run, n in runs(text, size).items():
                    if len(run) < MIN_CHARS:
                        continue
                    hashed = zlib.crc32(run, start)
                    if hashed % every == 0:
                        run = damaged(run, hashed)
                    total[run] = total.get(run, 0) + n
            if len(total) > HELD:
                yield passed_on(total)
                total = {}
        yield passed_on(total)

    return count


def word_counts(df: DataFrame, every: int = DAMAGE_EVERY, size: int = SECTION_BYTES) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough."""
    counted = documents(df).mapInArrow(_counted(every, size), schema="word string, n long")
    total = counted.where(F.length("word") >= MIN_CHARS).groupBy("word").agg(F.sum("n").alias("n"))
    return freeze(total.where(F.col("n") >= MIN_COUNT))


def gram_ranks(words: DataFrame) -> dict[str, int]:
    """The place of every bigram in the order from rare to frequent, by words that hold it.

    Words have letters of 90 code points only, so there are at most 8,100 bigrams whatever the input.
    """
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.select(F.explode(F.transform(starts, lambda i: F.substring("word", i, GRAM))).alias("gram"))
    counts = grams.groupBy("gram").count().collect()
    return {row["gram"]: i for i, row in enumerate(sorted(counts, key=lambda row: (row["count"], row["gram"])))}


def prefix_of(word: str, ranks: dict[str, int]) -> list[tuple[int, int]]:
    """Rank and position of the first bigrams in the order, with all that tie with the last of them."""
    grams = sorted((ranks[word[i : i + GRAM]], i) for i in range(len(word) - GRAM + 1))
    last = grams[PREFIX - 1][0]
    return [gram for gram in grams if gram[0] <= last]


def pivots_of(prefix: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The disjoint bigrams of a prefix with the least sum of ranks, one more than there are edits.

    ``best[k]`` is the cheapest choice of k grams among those that end before the current one.
    """
    by_place = sorted((at, rank) for rank, at in prefix[:PREFIX])
    picks: list[list[tuple[int, list[tuple[int, int]]] | None]] = []
    for i, (at, rank) in enumerate(by_place):
        before = next((picks[j] for j in range(i - 1, -1, -1) if by_place[j][0] + GRAM <= at), [(0, []), *[None] * (EDITS + 1)])
        now = list(picks[i - 1]) if i else [(0, []), *[None] * (EDITS + 1)]
        for k in range(1, EDITS + 2):
            if before[k - 1] is not None:
                cost, chosen = before[k - 1]
                if now[k] is None or (cost + rank, [*chosen, (rank, at)]) < now[k]:
                    now[k] = (cost + rank, [*chosen, (rank, at)])
        picks.append(now)
    return picks[-1][EDITS + 1][1]


def halves(word: str, shorter: int) -> tuple[str, str]:
    """The first and the last half of which one stands in both words of a pair whose shorter one has ``shorter`` letters."""
    half = shorter // 2
    return "<" + word[:half], ">" + word[len(word) - half :]


def _postings(ranks: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [("pivot", pa.bool_()), ("key", pa.string()), ("word", pa.string()), ("place", pa.int32()), ("last", pa.int32())]
    )

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for word in batch.column("word").to_pylist():
                prefix = prefix_of(word, ranks)
                last, n = prefix[-1][0], len(word)
                for pivot, grams in ((True, pivots_of(prefix)), (False, prefix)):
                    # Which lengths meet: equal ones, a longer gram's word, or a longer pivot's word.
                    kinds = (("=", n), ("+", n), ("-", n - 1)) if pivot else (("=", n), ("+", n - 1), ("-", n))
                    for kind, shorter in kinds:
                        if shorter >= MIN_CHARS:
                            for half in halves(word, shorter):
                                for rank, at in grams:
                                    found.append((pivot, f"{kind}{shorter}{half}{rank}", word, at, last))
            yield to_batches(dict(zip(schema.names, zip(*found, strict=True), strict=True)) if found else {n: [] for n in schema.names}, schema)

    return post


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of near words, both ways round: ``word``, ``near``."""
    ranks = gram_ranks(words)
    posted = words.select("word").mapInArrow(
        _postings(ranks), schema="pivot boolean, key string, word string, place int, last int"
    )
    posted = freeze(posted)
    pivots = posted.where("pivot").select("key", F.col("word").alias("a"), F.col("place").alias("at"), F.col("last").alias("last_a"))
    grams = posted.where("not pivot").select("key", F.col("word").alias("b"), F.col("place").alias("bt"), F.col("last").alias("last_b"))
    within = (F.col("last_a") <= F.col("last_b")) & (F.abs(F.col("at") - F.col("bt")) <= EDITS) & (F.col("a") != F.col("b"))
    met = pivots.join(grams, "key").where(within & (F.levenshtein("a", "b", EDITS) == EDITS))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = freeze(pairs)
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"))
    )


def roots(forms: DataFrame, most_rounds: int = 10) -> DataFrame:
    """``word`` and ``root`` for every word that has a form (``word``, ``form``); each round doubles the steps taken.

    A form is never near more than a few thousand words, the number of edits of its letters, so no key is hot.
    """
    steps = freeze(forms.select("word", F.col("form").alias("root")))
    for _ in range(most_rounds):
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = freeze(steps.join(onward, "root", "left").select("word", "root", "_next"))
        steps = moved.select("word", F.coalesce("_next", "root").alias("root"))
        if moved.where(F.col("_next").isNotNull()).isEmpty():
            return steps
    raise RuntimeError(f"forms did not settle in {most_rounds} rounds")


def spelling_variants(df: DataFrame, every: int = DAMAGE_EVERY, size: int = SECTION_BYTES) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word."""
    ready(df.sparkSession)
    words = word_counts(df, every, size)
    near = near_pairs(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    has = -F.col("best.minus") >= TIMES * F.col("n")
    known = freeze(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best.near")).alias("form"),
            F.when(has, -F.col("best.minus")).alias("form_n"),
        )
    )
    ends = roots(known.where(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
