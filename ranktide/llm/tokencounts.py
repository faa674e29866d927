"""Operator 12: tokens per document, from the counts of distinct pre-tokens.

The merges of the model can only build pieces of its vocabulary. Two neighbouring characters that stand next to each other
in no piece are therefore never merged, and a text may be cut between them without changing its tokens: every part between
such cuts is a pre-token. Pre-tokens are counted over the whole corpus by partial aggregation, and each distinct one is
encoded once. Documents then meet those counts in two ways, which together cover all of their pre-tokens:

- frequent ones, at most ``KNOWN`` of them whatever the input, are broadcast and summed where the document is read;
- the others leave their document as (pre-token, frequency) and are joined with their counts by a shuffle. None of them is
  a hot key: each is rarer than every broadcast one.

No document's ids are ever made. Distinct pre-tokens of a slice of text are told apart by a 64-bit hash of their characters
(two different ones among a slice's n count as equal with a probability of n^2 / 2^65); beyond a slice by their characters.

Defined results: null and empty texts have no bytes and no tokens; a text of white space has the tokens of its spaces, like
any other; rows that repeat a doc_id, or have none, give a row each; an empty table gives an empty result; a text of any length is worked
through in sections of ``SECTION_CHARS`` characters; columns besides doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.pretokens import Pretokenizer, text_slices
from ranktide.llm.runtime import documents, ready, table, to_batches
from ranktide.llm.textscan import mix
from ranktide.session import freeze

LIMIT = 4096
KNOWN = 1 << 18  # pre-tokens that are broadcast at most
HELD = 400_000  # distinct pre-tokens that a task holds before it passes them on
SECTION_CHARS = 1 << 20
SPACE_MARK = "▁"  # stands for a space in the pieces of the vocabulary
BETWEEN = "\n"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


class PieceCutter(Pretokenizer):
    """Cuts texts where no piece of a vocabulary has the two characters side by side."""

    def __init__(self, model) -> None:
        self.values = mix(np.arange(1, 0x10001, dtype=np.uint64)) | np.uint64(1)
        ids = range(model.get_piece_size())
        if not any(model.is_byte(i) for i in ids):
            raise ValueError("unknown characters of a model without byte pieces are joined over cuts")
        special = (model.is_control, model.is_unknown, model.is_byte)
        pieces = [model.id_to_piece(i).replace(SPACE_MARK, " ") for i in ids if not any(kind(i) for kind in special)]
        known = sorted({ord(c) for piece in pieces for c in piece})
        self.index = np.zeros(0x110000, dtype=np.uint16)
        self.index[known] = np.arange(1, len(known) + 1)
        self.together = np.zeros((len(known) + 1, len(known) + 1), dtype=bool)
        for piece in pieces:
            at = self.index[[ord(c) for c in piece]]
            self.together[at[:-1], at[1:]] = True
        between = self.index[ord(BETWEEN)]
        if self.together[between].any() or self.together[:, between].any():
            raise ValueError("the vocabulary has pieces over a line feed")

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) for t in texts], out=bounds[1:])
        if not len(points):
            return points, bounds, np.zeros(0, dtype=np.int64), bounds
        at = self.index[points]
        begins = np.ones(len(points), dtype=bool)
        begins[1:] = ~self.together[at[:-1], at[1:]]
        begins[bounds[:-1][bounds[:-1] < len(points)]] = True
        starts = np.flatnonzero(begins)
        return points, bounds, starts, np.searchsorted(starts, bounds)

    def sections(self, text: str, size: int) -> list[str]:
        """The text as the model sees it, cut into sections of about ``size`` characters at places where it may be cut."""
        if not text:
            return []
        text = " " + text.replace(SPACE_MARK, " ")
        found, start = [], 0
        while len(text) - start > size:
            end = start + size
            while end < len(text) and self.together[self.index[ord(text[end - 1])], self.index[ord(text[end])]]:
                end += 1
            found.append(text[start:end])
            start = end
        return [*found, text[start:]]


def _sections(batches: Iterator[pa.RecordBatch], cutter: PieceCutter, size: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[list[str], list[int]]]]]:
    """Batches with groups of sections that are worked on at once, and the row of each section."""
    for batch, texts in text_slices(batches):
        groups: list[tuple[list[str], list[int]]] = [([], [])]
        held = 0
        for row, text in enumerate(texts):
            for section in cutter.sections(text, size):
                if held > 4 * size:
                    groups.append(([], []))
                    held = 0
                groups[-1][0].append(section)
                groups[-1][1].append(row)
                held += len(section)
        yield batch, groups


def _listed(path: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("piece", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, total = PieceCutter(load(path)), {}
        for _, groups in _sections(batches, cutter, size):
            for sections, _ in groups:
                pieces, _, number, _ = cutter.distinct(sections)
                for piece, n in zip(pieces, np.bincount(number, minlength=len(pieces)).tolist(), strict=True):
                    total[piece] = total.get(piece, 0) + n
                if len(total) > HELD:
                    yield to_batches({"piece": list(total), "n": list(total.values())}, schema)
                    total = {}
        yield to_batches({"piece": list(total), "n": list(total.values())}, schema)

    return count


def _encoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("piece", pa.string()), ("n", pa.int64()), ("tokens", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        # Behind a line feed a piece gets no space of its own; the line feed's tokens are taken off again.
        before = len(model.encode(BETWEEN))
        for batch in batches:
            found = model.encode([BETWEEN + piece for piece in batch.column("piece").to_pylist()], num_threads=1)
            tokens = [len(ids) - before for ids in found]
            yield to_batches({"piece": batch.column("piece"), "n": batch.column("n"), "tokens": tokens}, schema)

    return encode


def piece_table(docs: DataFrame, path: str, size: int = SECTION_CHARS) -> DataFrame:
    """Every distinct pre-token of the corpus: ``piece``, its occurrences ``n`` and its number of ``tokens``."""
    listed = docs.mapInArrow(_listed(path, size), schema="piece string, n long")
    distinct = listed.groupBy("piece").agg(F.sum("n").alias("n"))
    return freeze(distinct.mapInArrow(_encoded(path), schema="piece string, n long, tokens long"))


def frequent_from(pieces: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pre-tokens occur at least so often."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int").alias("level")
    by_level = dict(pieces.groupBy(level).count().collect())  # at most 63 rows
    least, held = max(by_level, default=-1) + 1, 0
    while least > 0 and held + by_level.get(least - 1, 0) <= most:
        least -= 1
        held += by_level.get(least, 0)
    return 1 << least


def _summed(path: str, known: Broadcast, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, tokens_of = PieceCutter(load(path)), known.value
        row = TaskContext.get().partitionId() << 33
        for batch, groups in _sections(batches, cutter, size):
            n = batch.num_rows
            total = np.zeros(n, dtype=np.int64)
            rare: list[list[tuple[str, int]]] = [[] for _ in range(n)]
            for sections, owner in groups:
                pieces, _, number, by_section = cutter.distinct(sections)
                if not pieces:
                    continue
                tokens = np.array([tokens_of.get(piece, -1) for piece in pieces], dtype=np.int64)[number]
                row_of = np.repeat(np.array(owner, dtype=np.int64), np.diff(by_section))
                there = tokens >= 0
                total += np.bincount(row_of[there], weights=tokens[there], minlength=n).astype(np.int64)
                pairs, times = np.unique(row_of[~there] * len(pieces) + number[~there], return_counts=True)
                for of, piece, count in zip((pairs // len(pieces)).tolist(), (pairs % len(pieces)).tolist(), times.tolist(), strict=True):
                    rare[of].append((pieces[piece], count))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rare])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(n)),
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array(total),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array([p for x in rare for p, _ in x], type=pa.string())),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array([c for x in rare for _, c in x], type=pa.int64())),
                ],
                names=["row", "doc_id", "n_bytes", "known", "pieces", "times"],
            )
            row += n

    return add_up


def token_counts(df: DataFrame, path: str | None = None, limit: int = LIMIT, most: int = KNOWN, size: int = SECTION_CHARS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``df``.

    ``path`` is a sentencepiece BPE model with byte pieces and no normalisation; ``most`` bounds what is broadcast.
    """
    spark = ready(df.sparkSession)
    path = path or vocabulary_path()
    docs = documents(df)
    pieces = piece_table(docs, path, size)
    least = frequent_from(pieces, most)
    frequent = pieces.where(F.col("n") >= least).select("piece", "tokens").toPandas()  # at most `most` rows
    known = spark.sparkContext.broadcast(dict(zip(frequent["piece"].tolist(), frequent["tokens"].tolist(), strict=True)))
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    ddl = "row long, doc_id long, n_bytes long, known long, pieces array<string>, times array<long>"
    # Written once: a row's number must be the same for both readers below.
    rows = freeze(sized.mapInArrow(_summed(path, known, size), schema=ddl))
    left = rows.where(F.size("pieces") > 0).select("row", F.explode(F.arrays_zip("pieces", "times")).alias("of"))
    left = left.select("row", F.col("of.pieces").alias("piece"), F.col("of.times").alias("times"))
    others = pieces.where(F.col("n") < least).select("piece", "tokens")
    rest = left.join(others, "piece").groupBy("row").agg(F.sum(F.col("times") * F.col("tokens")).alias("rest"))
    counted = rows.select("row", "doc_id", "n_bytes", "known").join(rest, "row", "left")
    n_tokens = (F.col("known") + F.coalesce("rest", F.lit(0))).cast("long").alias("n_tokens")
    return counted.select("doc_id", "n_bytes", n_tokens).withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
