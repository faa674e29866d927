"""Operator 5: byte-level BPE encoding and decoding.

The texts are cut into pieces (``pretokens``), and distinct pieces that are no tokens of their own go through the merges,
which in each step join the leftmost pair of the lowest rank. The ``KNOWN`` most frequent ones of all documents do so once
and are broadcast; the others, which few tasks have, once in each task that has them. The documents' ids are put together
from the pieces' ids, and decoding concatenates the tokens' bytes. Only words and their counts are shuffled; a task's
word table is cleared at ``MOST_WORDS``.

Two forms of the merges give the same ids. ``merges="fold"``, the default and what the queries use, is a fold of Spark's
higher-order functions over the ids of a word's bytes; the ranks are a literal, a hash table in one array, in which the
ranks of all pairs of tokens that join to a token are found by position, so that a lookup does not search.
``merges="task"`` does the same steps in the Python worker that cuts the texts.

Pieces over FOLD_BYTES, for which the work of these forms would grow with the square of their length, are merged by the
same rule with a heap.

Defined results: null and empty texts have no ids; special tokens are not recognised; repeated rows and ids get a row
each; an empty table gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.pretokens import Numbers, Pretokenizer, Vocabulary, gather
from ranktide.llm.runtime import documents, drop, give_back, lean, ready, slices, table, to_batches, written
from ranktide.llm.tokencounts import frequent_from

FOLD_BYTES = 48
MOST_WORDS = 1_000_000
KNOWN = 1 << 21  # words that are folded once for all documents, and broadcast, with some 30 bytes each
BATCH_ROWS = 32  # rows of the assembled slices are large
CUT_BYTES = 1 << 18  # of text in such a row, and of text whose words are counted at once
NO_RANK = 0xFFFF
EDGE = 0xFFFF  # before and behind the ids of a word, where it gives every pair a neighbour; the id of no token, joins with nothing
BELOW = 1 << 16  # taken from the ranks that stand between ids, which makes them negative
SENT_ROWS = 1 << 16  # words that a worker passes on in one batch
MULTIPLIERS = (1_000_003, 998_244_353)  # of the two hash functions; products of pairs stay below 2 ** 63


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are also their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def joins(ranks: dict[bytes, int]) -> dict[int, int]:
    """For every two tokens whose bytes make a token, as ``left * 65536 + right``: that token's rank."""
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found[(left << 16) + right] = rank
    return found


def _places(pair: int, size: int) -> tuple[int, int]:
    return pair * MULTIPLIERS[0] % size, size + pair * MULTIPLIERS[1] % (size + 2)


def rank_table(pairs: dict[int, int]) -> list[int]:
    """The pairs in a hash table of two halves, with a place in each (cuckoo hashing); an entry is ``pair * 65536 + rank``."""
    size = max(11, len(pairs) * 3 // 2) | 1
    while True:
        places: dict[int, int] = {}
        for pair in pairs:
            at = _places(pair, size)[0]
            for _ in range(500):
                other, places[at] = places.get(at), pair
                if other is None:
                    break
                pair = other
                first, second = _places(pair, size)
                at = second if at == first else first
            else:
                break
        else:
            return [(places[i] << 16) + pairs[places[i]] if i in places else 0 for i in range(2 * size + 2)]
        size += size // 8 * 2 + 2


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: interpreted expressions compute each mention anew."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def folded(word: Column, table: Column, half: int) -> Column:
    """The ids of a word, given as ``begun`` gives it, by a fold that joins one pair in each step.

    Ids and the ranks of the pairs between them stand in one array, ranks lowered by ``BELOW``, so that its least value is the
    lowest rank. A step looks up the two pairs that it changes only.
    """
    none = F.lit(NO_RANK - BELOW).cast("long")

    def rank(left: Column, right: Column) -> Column:
        def found(pair: Column) -> Column:
            first = F.get(table, (pair * MULTIPLIERS[0] % half).cast("int"))
            second = F.get(table, (pair * MULTIPLIERS[1] % (half + 2) + half).cast("int"))
            value = lambda slot: slot.bitwiseAND(0xFFFF) - BELOW
            return (
                F.when(F.shiftright(first, 16) == pair, value(first))
                .when(F.shiftright(second, 16) == pair, value(second))
                .otherwise(none)
            )

        return _named(left * 65536 + right, found)

    def step(state: Column, low: Column) -> Column:
        def joined(at: Column) -> Column:  # the place of the pair's rank, from 1
            both = low + BELOW
            changed = F.array(rank(F.get(state, at - 4), both), both, rank(both, F.get(state, at + 2)))
            return F.concat(F.slice(state, F.lit(1), at - 3), changed, F.slice(state, at + 3, F.size(state)))

        return _named(F.array_position(state, low).cast("int"), joined)

    return F.aggregate(
        F.sequence(F.lit(7), F.greatest(F.size(word), F.lit(7)), F.lit(2)),  # one step less than bytes, at least one
        word,
        lambda state, _: _named(F.array_min(state), lambda low: F.when(low == none, state).otherwise(step(state, low))),
        lambda state: _named(F.filter(state, lambda x: x >= 0), lambda ids: F.slice(ids, F.lit(2), F.size(ids) - 2)),
    )


def folded_words(words: str | Column, table: list[int]) -> Column:
    """``folded`` over an array of words; the table is one literal, parsed when the plan is optimised."""
    literal = F.from_json(F.lit("[" + ",".join(map(str, table)) + "]"), "array<bigint>")
    half = len(table) // 2 - 1
    return _named(literal, lambda t: F.transform(words, lambda w: folded(w, t, half)))


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word of at least two bytes."""
    if len(word) > FOLD_BYTES:
        return merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    rank = ranks.get
    pairs = [rank(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs and (low := min(pairs)) != NO_RANK:
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
    return [ranks[p] for p in parts]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs, for long words."""
    parts = [word[i : i + 1] for i in range(len(word))]
    after, before, alive = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1)), [True] * len(parts)
    heap = [(r, i, word[i : i + 2]) for i in range(len(parts) - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if alive[i] else len(parts)
        if j >= len(parts) or parts[i] + parts[j] != pair:
            continue
        parts[i], alive[j] = pair, False
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and (right := after[left]) < len(parts):
                both = parts[left] + parts[right]
                if (r := ranks.get(both)) is not None:
                    heapq.heappush(heap, (r, left, both))
    return [ranks[p] for p, there in zip(parts, alive, strict=True) if there]


LISTED = pa.schema([("word", pa.binary()), ("n", pa.int64())])
SPELLED = pa.schema([("name", pa.int64()), ("word", pa.list_(pa.int64()))])


def _lister(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The words to fold, with their occurrences."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, cutter, numbers, words, total = None, None, Numbers(), [], np.zeros(0, dtype=np.int64)
        for batch in _gathered(batches, CUT_BYTES):
            if ranks is None:
                ranks, cutter = read_ranks(path), Pretokenizer()
            spell, names, number, _ = cutter.spelled_later([t or "" for t in batch.column("text").to_pylist()])
            place, new = numbers.of(names)
            words += [_to_fold(piece, ranks) for piece in spell(new)]
            total = np.append(total, np.zeros(len(new), dtype=np.int64))
            total[place] += np.bincount(number, minlength=len(names))
            if len(words) > MOST_WORDS:
                yield from _counted(words, total)
                numbers, words, total = Numbers(), [], total[:0]
        yield from _counted(words, total)

    return listed


def _to_fold(piece: str, ranks: dict[bytes, int]) -> bytes | None:
    """The bytes of a piece, if the fold is to merge them."""
    word = piece.encode("utf-8", "surrogatepass")
    return word if len(word) <= FOLD_BYTES and word not in ranks else None


def _counted(words: list[bytes | None], total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(words), SENT_ROWS):
        some = pa.array(words[start : start + SENT_ROWS], pa.binary())
        batch = pa.RecordBatch.from_arrays([some, pa.array(total[start : start + SENT_ROWS])], schema=LISTED)
        yield batch.filter(some.is_valid())


def _speller(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Names of words, as the cutter gives them, and the words as the fold takes them."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, cutter = None, None
        for batch in batches:
            if begin is None:
                begin, cutter = Begin(read_ranks(path)), Pretokenizer()
            words = batch.column("word").to_pylist()
            names = cutter.named([w.decode("utf-8", "surrogatepass") for w in words])
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), begin.words(words)], schema=SPELLED)

    return spelled


class Begin:
    """What the fold begins with: a word's byte ids, the ranks of their pairs between them, and an edge at either end."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        single = [ranks.get(bytes([b]), NO_RANK) for b in range(256)]
        self.single = np.array(single, dtype=np.int64)
        pairs = [ranks.get(bytes([a, b]), NO_RANK) for a in range(256) for b in range(256)]
        self.pairs = np.array(pairs, dtype=np.int64) - BELOW
        # Bytes that are no tokens join with nothing.
        alone = self.single == NO_RANK
        self.pairs[(alone[:, None] | alone).ravel()] = NO_RANK - BELOW

    def words(self, words: list[bytes]) -> pa.Array:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(2 * lengths + 3, out=ends[1:])
        flat = np.full(ends[-1], NO_RANK - BELOW, dtype=np.int64)
        flat[ends[:-1]] = flat[ends[1:] - 1] = EDGE
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        first = np.cumsum(lengths) - lengths
        place = 2 * np.arange(len(data)) + np.repeat(ends[:-1] + 2 - 2 * first, lengths)
        flat[place] = self.single[data]
        inside = np.ones(len(data), dtype=bool)
        inside[first + lengths - 1] = False
        left = np.flatnonzero(inside)
        flat[place[left] + 1] = self.pairs[data[left] * 256 + data[left + 1]]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


class Folded:
    """Ids of words by the words' names, in some 20 bytes a word."""

    def __init__(self, names: np.ndarray, ids: pa.ListArray) -> None:
        order = np.argsort(names)
        self.names = names[order]
        ids = ids.take(pa.array(order))
        self.offsets, self.flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype(np.uint16)

    def places(self, names: np.ndarray) -> np.ndarray:
        """The place of each name, -1 for those that are not here."""
        at = np.searchsorted(self.names, names)
        there = at < len(self.names)
        there[there] = self.names[at[there]] == names[there]
        return np.where(there, at, -1)

    def ids(self, place: int) -> np.ndarray:
        return self.flat[self.offsets[place] : self.offsets[place + 1]]

    def all_ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of several words, one after the other, and how many each has."""
        lengths = (self.offsets[places + 1] - self.offsets[places]).astype(np.int64)
        return gather(self.flat, self.offsets[places].astype(np.int64), lengths), lengths


def frequent_words(docs: DataFrame, path: str, table: list[int], most: int = KNOWN) -> Folded:
    """The ids of at most ``most`` words, the most frequent ones of all documents, each folded once."""
    counted = written(docs.mapInArrow(lean(_lister(path)), schema="word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    least = frequent_from(counted, most)
    spelled = counted.where(F.col("n") >= least).mapInArrow(lean(_speller(path)), schema="name long, word array<long>")
    ids = F.get(folded_words(F.array("word"), table), F.lit(0)).cast("array<int>").alias("ids")
    found = spelled.select("name", ids).toArrow().combine_chunks()  # at most `most` rows
    drop(counted)
    names = found.column("name").to_numpy().view(np.uint64)
    kind = pa.list_(pa.int32())
    return Folded(names, pa.concat_arrays([c.cast(kind) for c in found.column("ids").chunks] or [pa.array([], kind)]))


# Where the ids of a new word come from, in the order in which a row has them.
KNOWN_BEFORE, MADE_HERE, TO_FOLD = 0, 1, 2
CUT = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("bounds", pa.binary()),  # of each document's pieces
        ("pieces", pa.binary()),  # number of the word of each piece
        ("cleared", pa.bool_()),  # words are numbered from 0 again
        ("kinds", pa.binary()),  # of each new word
        ("lengths", pa.binary()),  # of the ids that are there, those of words known before first
        ("ready", pa.binary()),  # these ids
        ("words", pa.list_(pa.list_(pa.int64()))),  # the others, as the fold takes them
    ]
)
CUT_SCHEMA = (
    "doc_ids array<long>, bounds binary, pieces binary, cleared boolean, kinds binary, lengths binary, ready binary, words array<array<long>>"
)


def _cutter(path: str, frequent: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, cutter, numbers = None, None, Numbers()
        for batch in _gathered(batches, CUT_BYTES):
            if ranks is None:
                ranks, cutter, once = read_ranks(path), Pretokenizer(), frequent.value
                begin = Begin(ranks)
            spell, names, number, by_text = cutter.spelled_later([t or "" for t in batch.column("text").to_pylist()])
            cleared = len(numbers) + len(names) > MOST_WORDS
            if cleared:
                numbers = Numbers()
            place, new = numbers.of(names)
            at = once.places(names[new])
            kinds = np.full(len(new), KNOWN_BEFORE, dtype=np.uint8)
            made, words, others = [], [], np.flatnonzero(at < 0)
            for i, piece in zip(others.tolist(), spell(new[others]), strict=True):
                word = piece.encode("utf-8", "surrogatepass")
                whole = ranks.get(word)
                if whole is None and len(word) <= FOLD_BYTES:
                    kinds[i] = TO_FOLD
                    words.append(word)
                else:
                    kinds[i] = MADE_HERE
                    made.append(merge_long(word, ranks) if whole is None else [whole])
            ready, lengths = once.all_ids(at[at >= 0])
            ready = np.append(ready, np.fromiter(chain.from_iterable(made), dtype=np.uint16))
            lengths = np.append(lengths, np.fromiter(map(len, made), dtype=np.int64, count=len(made)))
            row = {
                "doc_ids": [batch.column("doc_id").to_pylist()],
                "bounds": [by_text.astype("<i8").tobytes()],
                "pieces": [place[number].astype("<u4").tobytes()],
                "cleared": [cleared],
                "kinds": [kinds.tobytes()],
                "lengths": [lengths.astype("<u4").tobytes()],
                "ready": [ready.astype("<u2").tobytes()],
                "words": [None],
            }
            listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), begin.words(words))
            yield to_batches(row, CUT).set_column(CUT.names.index("words"), CUT.field("words"), listed)

    return cut


def _gathered(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text, over the borders of batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in slices(batches, limit=limit):
        held.append(part)
        size += part.column("text").nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Pieces:
    """The bytes of all tokens, to decode ids by concatenation."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        by_rank = {rank: token for token, rank in ranks.items()}
        tokens = [by_rank.get(i, b"") for i in range(max(by_rank) + 1)]
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.flat, self.offsets[ids], self.lengths[ids]).tobytes()


ENCODED = "doc_id long, ids binary, decoded binary"
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
WHOLE = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _assembler(path: str, digests: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = None
        used = count = 0
        flat, offsets, lengths = np.zeros(1 << 20, np.uint16), np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int32)
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r] for name in batch.schema.names}
                if pieces is None:
                    pieces = Pieces(read_ranks(path))
                if row["cleared"].as_py():
                    used = count = 0
                kinds = np.frombuffer(row["kinds"].as_py(), dtype=np.uint8)
                words = row["folded"].values  # a list of ids for each word
                bounds = words.offsets.to_numpy()
                ids = words.values.to_numpy()[bounds[0] : bounds[-1]].astype(np.uint16)
                both = np.append(np.frombuffer(row["ready"].as_py(), dtype="<u2"), ids)
                sizes = np.append(np.frombuffer(row["lengths"].as_py(), dtype="<u4").astype(np.int64), np.diff(bounds))
                while used + len(both) > len(flat):
                    flat = np.append(flat, flat)
                while count + len(kinds) > len(offsets):
                    offsets, lengths = np.append(offsets, offsets), np.append(lengths, lengths)
                flat[used : used + len(both)] = both
                order = count + np.argsort(kinds, kind="stable")
                offsets[order] = used + np.cumsum(sizes) - sizes
                lengths[order] = sizes
                used, count = used + len(both), count + len(kinds)
                place = np.frombuffer(row["pieces"].as_py(), dtype="<u4")
                cuts = np.frombuffer(row["bounds"].as_py(), dtype="<i8")
                total = np.zeros(len(place) + 1, dtype=np.int64)
                np.cumsum(lengths[place], out=total[1:])
                ids = gather(flat, offsets[place], lengths[place]).astype("<u4")
                yield _documents(row["doc_ids"].as_py(), ids, total[cuts], pieces, digests)

    return assemble


def _documents(doc_ids: list, ids: np.ndarray, cuts: np.ndarray, pieces: Pieces, digests: bool) -> pa.RecordBatch:
    own = [ids[cuts[i] : cuts[i + 1]] for i in range(len(doc_ids))]
    decoded = [pieces.decode(x) for x in own]
    if not digests:
        return to_batches({"doc_id": doc_ids, "ids": [x.tobytes() for x in own], "decoded": decoded}, WHOLE)
    hexes = lambda contents: [hashlib.sha256(c).hexdigest() for c in contents]
    columns = {"doc_id": doc_ids, "n_tokens": [len(x) for x in own], "ids_sha256": hexes(own), "decoded_sha256": hexes(decoded)}
    return to_batches(columns, DIGESTS)


def _encoder(path: str, digests: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cutting, merging, assembling and decoding in one worker."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in _gathered(batches):
            if words is None:
                ranks = read_ranks(path)
                words, cutter, pieces = Vocabulary(lambda new: _merged(new, ranks), MOST_WORDS), Pretokenizer(), Pieces(ranks)
            ids, cuts = words.ids([t or "" for t in batch.column("text").to_pylist()], cutter)
            yield _documents(batch.column("doc_id").to_pylist(), ids.astype("<u4"), cuts, pieces, digests)

    return encode


def _merged(words: list[str], ranks: dict[bytes, int]) -> list[np.ndarray]:
    found = []
    for word in words:
        content = word.encode("utf-8", "surrogatepass")
        whole = ranks.get(content)
        found.append(np.array([whole] if whole is not None else merge(content, ranks), dtype=np.uint32))
    return found


def _encoded(df: DataFrame, path: str | None, merges: str, digests: bool, schema: str) -> DataFrame:
    spark = ready(df.sparkSession)
    if merges == "task":
        return documents(df).mapInArrow(_encoder(path or vocabulary_path(), digests), schema=schema)
    if merges != "fold":
        raise ValueError(f"unknown form of merges: {merges}")
    path, docs = path or vocabulary_path(), documents(df)
    ranks = rank_table(joins(read_ranks(path)))
    frequent = spark.sparkContext.broadcast(frequent_words(docs, path, ranks))
    give_back()  # the driver has passed the words through
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    cut = docs.mapInArrow(lean(_cutter(path, frequent)), schema=CUT_SCHEMA)
    words = cut.withColumn("folded", folded_words("words", ranks)).drop("words")
    return words.mapInArrow(lean(_assembler(path, digests)), schema=schema)


def encode(df: DataFrame, path: str | None = None, merges: str = "fold") -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit integers) and the ``decoded`` bytes of every row."""
    return _encoded(df, path, merges, False, ENCODED)


def digest(df: DataFrame, path: str | None = None, merges: str = "fold") -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and of decoded bytes of every row."""
    return _encoded(df, path, merges, True, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))
