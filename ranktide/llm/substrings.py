"""Operator 7: removal of repeated byte strings by grouping equal strings of LENGTH bytes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller doc_id. Positions
are ordered by their next LENGTH bytes, and each group of equal strings gets its smallest doc_id. No longest-previous-factor
array is computed: whether its factor reaches LENGTH is all that the removal asks, and longer factors would need the bytes
beyond a run, which are not sent.

No machine can sort all suffixes, so they are dealt out by their anchors. The anchor of a position is the smallest hash of
the KMER-byte strings within its LENGTH bytes; equal strings have equal anchors, and neighbouring positions mostly share
one. Anchors that occur in one document alone are found first, from 4-byte digests (chance agreement there only adds work),
and left out. For the others, the bytes of every run of positions with one anchor meet in the bucket of the anchor. There
copies of a run are made one, its positions are put in the order of their LENGTH bytes, and equal strings are compared
as bytes; every copy gets the ranges that have an earlier match.

Copies are reduced before they are sent: a run whose bytes a smaller doc_id of its block also has is removed there. Hot
anchors, with more than HOT_POSITIONS positions over all blocks, are not sent as runs: each string of LENGTH bytes goes, once
per block and with its smallest doc_id, to a bucket by its own hash, so that equal strings still meet while one anchor
spreads over all buckets.

Disk is bounded by steps: digests are let go when the shared anchors are found, and the buckets meet in ROUNDS rounds, so that only
the runs of one round are on disk. Strings of KMER bytes are long enough that prose seldom repeats one by chance, however much of it
there is; shorter ones would have most runs sent in the end, longer ones cut the text into more runs.

Documents travel in compressed blocks of about BLOCK_BYTES. The number of buckets grows with the input, for about
BUCKET_BYTES of text each; beyond that a bucket can get an anchor of up to HOT_POSITIONS, and of one hot string one copy per
block. Blocks, digests and ranges are joined by block, so a document is never gathered with others than those of its block.

Defined results: null and empty texts have 0 bytes and nothing removed; texts under LENGTH bytes are kept whole; rows with
a null doc_id are kept whole and remove nothing elsewhere; equal doc_ids are not smaller than each other; an empty table
gives an empty result; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.llm.pretokens import gather
from ranktide.llm.runtime import documents, give_back, input_bytes, lean, ready, slices, table, to_batches
from ranktide.llm.textscan import BYTE_VALUES, POWERS, mix, owners, per_text, span_hashes, utf8
from ranktide.session import forget_shuffles, freeze

LENGTH = 50
KMER = 24
BLOCK_BYTES = 3_500_000
BUCKET_BYTES = 8 << 20
HOT_POSITIONS = 1 << 16
ROUNDS = 2
COMPARED = 1 << 15  # strings that are compared at a time
BATCH_ROWS = 8  # blocks in an Arrow batch

BLOCK_DDL = "block long, doc_ids array<long>, bounds binary, content binary"
BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("bounds", pa.binary()), ("content", pa.binary())])


def _pack(content: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(content)


def _unpack(content: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(content)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, limit=BLOCK_BYTES // 8):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield _block(held, number)
            held, size, number = [], 0, number + 1
    if held:
        yield _block(held, number)


def _block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
    whole = pa.Table.from_batches(held).combine_chunks().to_batches()
    if not whole:
        return to_batches({name: [] for name in BLOCK.names}, BLOCK)
    data, bounds = utf8(whole[0].column("text"))
    row = {"block": [number], "doc_ids": [whole[0].column("doc_id").to_pylist()], "bounds": [bounds.astype("<i8").tobytes()]}
    return to_batches(row | {"content": [_pack(data.tobytes())]}, BLOCK)


class Block:
    """A block's documents and the runs of positions with one anchor."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.doc_ids = row["doc_ids"]
        self.bounds = np.frombuffer(row["bounds"], dtype="<i8")
        self.data = np.frombuffer(_unpack(row["content"]), dtype=np.uint8)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first position, number of positions, and row of the document."""
        data, n = self.data, len(self.data)
        none = np.zeros(0, dtype=np.int64)
        if n < LENGTH:
            return none.astype(np.uint64), none, none, none
        up, down = POWERS.get(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[:n], out=total[1:])
        least = mix((total[KMER:] - total[:-KMER]) * down[: n - KMER + 1])
        width, span = LENGTH - KMER + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: span - width], least[width - span :])
        known = np.array([d is not None for d in self.doc_ids])
        long = known & (np.diff(self.bounds) >= LENGTH)
        change = np.zeros(n + 2, dtype=np.int64)
        np.add.at(change, self.bounds[:-1][long], 1)
        np.add.at(change, self.bounds[1:][long] - LENGTH + 1, -1)
        inside = np.cumsum(change)[: len(least)] > 0
        edge = np.ones(len(least) + 1, dtype=bool)
        edge[1:-1] = (least[1:] != least[:-1]) | ~inside[1:] | ~inside[:-1]
        edge[self.bounds[:-1][self.bounds[:-1] < len(least)]] = True
        starts = np.flatnonzero(edge[:-1] & inside)
        ends = np.flatnonzero(edge)[np.searchsorted(np.flatnonzero(edge), starts) + 1]
        return least[starts], starts, ends - starts, owners(self.bounds, starts)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _by_bucket(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of sorted distinct anchors, and their order by bucket."""
    bucket = ((anchors >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    return bucket, np.argsort(bucket, kind="stable")


def _digester(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("digests", pa.binary()), ("several", pa.binary()), ("sizes", pa.binary())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            anchors, _, lengths, owner = block.runs()
            if not len(anchors):
                continue
            order = np.lexsort((owner, anchors))
            ranked, owner = anchors[order], owner[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            last = np.append(first[1:], len(ranked)) - 1
            distinct, several = ranked[first], owner[first] != owner[last]
            sizes = np.minimum(np.add.reduceat(lengths[order], first), 0xFFFF).astype("<u2")
            bucket, order = _by_bucket(distinct, buckets)
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            short = (distinct & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
            several, sizes = several[order], sizes[order]
            filled = np.flatnonzero(np.diff(cuts))
            yield to_batches(
                {
                    "bucket": filled,
                    "block": [block.number] * len(filled),
                    "digests": [short[cuts[b] : cuts[b + 1]].tobytes() for b in filled],
                    "several": [np.packbits(several[cuts[b] : cuts[b + 1]]).tobytes() for b in filled],
                    "sizes": [_pack(sizes[cuts[b] : cuts[b + 1]].tobytes()) for b in filled],
                },
                schema,
            )

    return digest


def _shared(bucket: pa.Table, hot_positions: int) -> pa.Table:
    """For each block of a bucket, which of its anchors occur in several documents, and which of them are hot."""
    digests = [np.frombuffer(x, dtype="<u4") for x in bucket.column("digests").to_pylist()]
    several = bucket.column("several").to_pylist()
    marks = [np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(d)).astype(bool) for s, d in zip(several, digests, strict=True)]
    # By digest, so that every block decides alike. Two anchors of one block with the same digest count as shared too.
    every, marked = np.concatenate(digests), np.concatenate(marks)
    found, number = np.unique(every, return_inverse=True)
    common = np.bincount(number, minlength=len(found)) > 1
    common[number[marked]] = True
    sizes = np.concatenate([np.frombuffer(_unpack(x), dtype="<u2") for x in bucket.column("sizes").to_pylist()])
    hot = np.bincount(number, weights=sizes, minlength=len(found)) > hot_positions
    cuts = np.cumsum([0, *map(len, digests)])
    own = [number[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    flags = [np.packbits(common[o]).tobytes() + np.packbits(hot[o]).tobytes() for o in own]
    return pa.table(
        {"block": bucket.column("block"), "bucket": bucket.column("bucket"), "flags": pa.array(flags, pa.binary())},
        schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("flags", pa.binary())]),
    )


def _copies(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte range, the index of the equal range that stands for it, one with the smallest id.

    Ranges that agree only in their hash stand for themselves. Also returns the indices that stand for any.
    """
    if not len(at):
        return at, at
    names = mix(span_hashes(data, at, at + sizes) + sizes.astype(np.uint64))
    order = np.lexsort((ids, names))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = names[order][1:] != names[order][:-1]
    stands = np.empty(len(order), dtype=np.int64)
    stands[order] = order[fresh][np.cumsum(fresh) - 1]
    other = np.flatnonzero((stands != np.arange(len(at))) & (sizes == sizes[stands]))
    if len(other):
        unlike = gather(data, at[other], sizes[other]) != gather(data, at[stands[other]], sizes[other])
        begin = np.cumsum(sizes[other]) - sizes[other]
        differs = np.add.reduceat(unlike.astype(np.int64), begin) > 0
        stands[other[differs]] = other[differs]
    mixed = sizes != sizes[stands]
    stands[mixed] = np.flatnonzero(mixed)
    return stands, np.flatnonzero(stands == np.arange(len(at)))


def _sender(buckets: int, turn: int, rounds: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sends the runs of every ``rounds``-th bucket, from number ``turn`` on."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("runs", pa.binary()), ("ranges", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row)
            anchors, starts, lengths, owner = block.runs()
            if not len(anchors):
                continue
            distinct, number = np.unique(anchors, return_inverse=True)
            bucket, order = _by_bucket(distinct, buckets)
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            shared, hot = np.zeros(len(distinct), dtype=bool), np.zeros(len(distinct), dtype=bool)
            for part in row["shared"]:
                own = order[cuts[part["bucket"]] : cuts[part["bucket"] + 1]]
                flags = np.frombuffer(part["flags"], dtype=np.uint8)
                shared[own] = np.unpackbits(flags[: len(flags) // 2], count=len(own)).astype(bool)
                hot[own] = np.unpackbits(flags[len(flags) // 2 :], count=len(own)).astype(bool)
            ids = np.array([0 if d is None else d for d in block.doc_ids], dtype=np.int64)[owner]
            # Strings of hot anchors go by hashes of their own, so that each round looks at all of them.
            kept = np.flatnonzero((shared & (hot | (bucket % rounds == turn)))[number])
            decided = [np.zeros((2, 0), dtype=np.int64)]

            def first_ones(at: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
                """All but those with an equal one of a smaller id in this block, whose ranges are decided."""
                stands, _ = _copies(block.data, at, lengths + LENGTH - 1, ids)
                later = ids[stands] < ids
                decided.append(np.stack([at[later], at[later] + lengths[later] + LENGTH - 1]))
                return np.flatnonzero(~later)

            kept = kept[first_ones(starts[kept], lengths[kept], ids[kept])]
            to = bucket[number[kept]]
            is_hot = hot[number[kept]]
            warm, split = kept[~is_hot], kept[is_hot]
            at, sizes, ids_of, to = starts[warm], lengths[warm], ids[warm], to[~is_hot]
            if len(split):
                within = np.arange(int(lengths[split].sum())) - np.repeat(np.cumsum(lengths[split]) - lengths[split], lengths[split])
                single, single_ids = np.repeat(starts[split], lengths[split]) + within, np.repeat(ids[split], lengths[split])
                left = first_ones(single, np.ones_like(single), single_ids)
                single, single_ids = single[left], single_ids[left]
                names = mix(span_hashes(block.data, single, single + LENGTH))
                at, sizes = np.concatenate([at, single]), np.concatenate([sizes, np.ones_like(single)])
                ids_of = np.concatenate([ids_of, single_ids])
                to = np.concatenate([to, ((names >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)])
            by = np.lexsort((at, to))
            by = by[to[by] % rounds == turn]
            at, sizes, ids_of, to = at[by], sizes[by], ids_of[by], to[by]
            cuts = np.searchsorted(to, np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(cuts))
            packed: list[bytes | None] = []
            for b in filled:
                own = slice(cuts[b], cuts[b + 1])
                content = gather(block.data, at[own], sizes[own] + LENGTH - 1)
                steps = np.diff(at[own], prepend=0)
                arrays = (steps.astype("<u4"), sizes[own].astype("<u4"), ids_of[own].astype("<i8"), content)
                packed.append(_pack(len(steps).to_bytes(8, "little") + b"".join(a.tobytes() for a in arrays)))
            to, ranges = filled.tolist(), [None] * len(filled)
            ready_made = np.concatenate(decided, axis=1)
            if ready_made.size:
                # Decided ranges pass through some bucket on their way back to the block.
                to.append(block.number % buckets)
                packed.append(None)
                ranges.append(_pack(ready_made.astype("<u4").tobytes()))
            yield to_batches({"bucket": to, "block": [block.number] * len(to), "runs": packed, "ranges": ranges}, schema)

    return send


def _received(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = _unpack(packed)
    n, at = int.from_bytes(raw[:8], "little"), 8
    steps = np.frombuffer(raw, "<u4", n, at)
    lengths = np.frombuffer(raw, "<u4", n, at + 4 * n)
    ids = np.frombuffer(raw, "<i8", n, at + 8 * n)
    return np.cumsum(steps, dtype=np.int64), lengths.astype(np.int64), ids, np.frombuffer(raw, np.uint8, offset=at + 16 * n)


def _smallest(order: np.ndarray, fresh: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id of the first of each group, for positions in order; ``fresh`` says where a group begins."""
    result = np.empty(len(order), dtype=np.int64)
    result[order] = ids[order[fresh]][np.cumsum(fresh) - 1]
    return result


def earliest(data: np.ndarray, positions: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each position the smallest id among the positions whose next LENGTH bytes are the same.

    The positions are ordered by a hash of those bytes, and by id within equal ones; the first of each group has the smallest id.
    Neighbours in a group are compared as bytes, some at a time; should a hash stand for two strings, all are ordered by bytes.
    """
    if not len(positions):
        return np.zeros(0, dtype=np.int64)
    names = span_hashes(data, positions, positions + LENGTH)
    order = np.lexsort((ids, names))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = names[order[1:]] != names[order[:-1]]
    del names
    within = np.arange(LENGTH)
    for start in range(1, len(order), COMPARED):
        again = np.flatnonzero(~fresh[start : start + COMPARED]) + start
        one, other = positions[order[again - 1]], positions[order[again]]
        if (data[one[:, None] + within] != data[other[:, None] + within]).any():
            return earliest_by_bytes(data, positions, ids)
    return _smallest(order, fresh, ids)


def earliest_by_bytes(data: np.ndarray, positions: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The same, by the order of the strings themselves."""
    words = np.zeros(max(len(data) - 7, 0), dtype=np.uint64)
    for j in range(8):
        words = words << np.uint64(8) | data[j : j + len(words)]
    keys = [words[positions + at] for at in (*range(0, LENGTH - 8, 8), LENGTH - 8)]
    order = np.lexsort((ids, *keys[::-1]))
    fresh = np.ones(len(order), dtype=bool)
    if len(order):
        fresh[1:] = False
    for key in keys:
        ranked = key[order]
        fresh[1:] |= ranked[1:] != ranked[:-1]
    return _smallest(order, fresh, ids)


def _met(bucket: pa.Table) -> pa.Table:
    """``_matched``, after which memory goes back to the system."""
    try:
        return _matched(bucket)
    finally:
        give_back()


def _matched(bucket: pa.Table) -> pa.Table:
    """For each block of a bucket the byte ranges that have an earlier match."""
    schema = pa.schema([("block", pa.int64()), ("ranges", pa.binary())])
    decided = bucket.filter(pc.is_valid(bucket.column("ranges"))).select(["block", "ranges"]).cast(schema)
    bucket = bucket.filter(pc.is_valid(bucket.column("runs")))
    if not bucket.num_rows:
        return decided
    parts = [_received(x) for x in bucket.column("runs").to_pylist()]
    starts, lengths, ids, data = (np.concatenate([p[i] for p in parts]) for i in range(4))
    sizes = lengths + LENGTH - 1
    at = np.cumsum(sizes) - sizes
    # Copies of a run: one stands for all, with their smallest id.
    stands, one = _copies(data, at, sizes, ids)
    which = np.searchsorted(one, stands)
    first = np.cumsum(lengths[one]) - lengths[one]
    positions = np.repeat(at[one] - first, lengths[one]) + np.arange(int(lengths[one].sum()))
    smallest = earliest(data, positions, np.repeat(ids[one], lengths[one]))
    # Every copy compares its own id.
    own = gather(smallest, first[which], lengths) < np.repeat(ids, lengths)
    begin = np.cumsum(lengths) - lengths
    run_edge = np.zeros(len(own) + 1, dtype=bool)
    run_edge[begin] = True
    run_edge[-1] = True
    opens = np.flatnonzero(own & np.concatenate([[True], ~own[:-1] | run_edge[1:-1]]))
    closes = np.flatnonzero(own & np.concatenate([~own[1:] | run_edge[1:-1], [True]]))
    run = np.searchsorted(begin, opens, side="right") - 1
    low = starts[run] + opens - begin[run]
    high = starts[run] + closes - begin[run] + LENGTH
    cuts = np.searchsorted(run, np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]))
    ranges = [
        _pack(np.stack([low[a:b], high[a:b]]).astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    found = pa.table({"block": bucket.column("block"), "ranges": pa.array(ranges, pa.binary())}, schema=schema)
    return pa.concat_tables([found, decided])


REMOVED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block = Block(row)
        n = len(block.data)
        # The ranges of all buckets at once: a block has some from most buckets, whose number grows with the input.
        ranges = [np.frombuffer(_unpack(packed), dtype="<u4").reshape(2, -1) for packed in row["ranges"] or []]
        low, high = np.concatenate([np.zeros((2, 0), dtype="<u4"), *ranges], axis=1).astype(np.int64)
        change = np.bincount(low, minlength=n + 1) - np.bincount(high, minlength=n + 1)
        gone = np.cumsum(change[:-1]) > 0
        before = np.concatenate([[False], gone[:-1]]) if n else gone
        after = np.concatenate([gone[1:], [False]]) if n else gone
        if n:
            before[block.bounds[:-1][block.bounds[:-1] < n]] = False
            after[block.bounds[1:][block.bounds[1:] > 0] - 1] = False
        opens, closes = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
        owner = owners(block.bounds, opens)
        cuts = np.searchsorted(owner, np.arange(len(block.doc_ids) + 1))
        left = block.data[~gone].tobytes()
        kept = np.concatenate([[0], np.cumsum(per_text(~gone, block.bounds))])
        offsets = block.bounds[:-1]
        inner = pa.StructArray.from_arrays(
            [pa.array(opens - offsets[owner], pa.int64()), pa.array(closes - offsets[owner], pa.int64())], names=["start", "end"]
        )
        columns = [
            pa.array(block.doc_ids, pa.int64()),
            pa.array(np.diff(block.bounds), pa.int64()),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), inner),
            pa.array([left[a:b] for a, b in zip(kept[:-1], kept[1:], strict=True)], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=REMOVED)


def _flags(blocks: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket, which anchors are shared and which hot; written, so that the digests can go."""
    hot_positions = HOT_POSITIONS
    digests = blocks.mapInArrow(
        lean(_digester(buckets)), schema="bucket int, block long, digests binary, several binary, sizes binary"
    )
    flags = digests.groupBy("bucket").applyInArrow(
        lambda bucket: _shared(bucket, hot_positions), schema="block long, bucket int, flags binary"
    )
    return freeze(flags)


def _ranges(blocks: DataFrame, flags: DataFrame, buckets: int, turn: int, rounds: int) -> DataFrame:
    """For each block the byte ranges that the buckets of a round have found; written, so that their runs can go."""
    by_block = flags.groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("shared"))  # bounded by the block
    sent = blocks.join(by_block, "block").mapInArrow(
        lean(_sender(buckets, turn, rounds)), schema="bucket int, block long, runs binary, ranges binary"
    )
    return freeze(sent.groupBy("bucket").applyInArrow(_met, schema="block long, ranges binary"))


def without_repeats(df: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` (bytes from start up to end) and the ``kept`` bytes of every row."""
    spark = ready(df.sparkSession)
    docs = documents(df)
    buckets = max(1, -(-input_bytes(docs) // BUCKET_BYTES))
    blocks = freeze(docs.mapInArrow(lean(_to_blocks), schema=BLOCK_DDL))
    # From here on rows are blocks; the setting also holds for the returned plan.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    flags = _flags(blocks, buckets)
    forget_shuffles(spark)
    rounds, found = min(ROUNDS, buckets), []
    for turn in range(rounds):
        found.append(_ranges(blocks, flags, buckets, turn, rounds))
        forget_shuffles(spark)
    ranges = reduce(DataFrame.unionByName, found)
    ranges = ranges.groupBy("block").agg(F.collect_list("ranges").alias("ranges"))
    ddl = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return blocks.join(ranges, "block", "left").mapInArrow(lean(_remover), schema=ddl)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
