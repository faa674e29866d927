"""Operator 10: token ids in files of independent zstandard frames.

A file holds documents in ascending doc_id order, one frame each, and ends with two skippable frames: the directory of
the documents (ids) and a seek table in the layout of the public zstandard seekable format, whose entries give the
compressed size, the size and the checksum of every frame (the low 32 bits of XXH64 of its content). A reader finds
the directory from the end of the file and decompresses only the frames it is asked for; any zstandard decoder can also
decompress the whole file, since skippable frames are skipped.

Documents are range-partitioned by doc_id, in as many partitions as their bytes and their number need, so that each task
writes one file of bounded size; files grow with the input until they are large, so that their number stays moderate. A file
is written under the name of its attempt, and no file is replaced: the manifest, one row per file, is what a repeated
task replaces, and names the files to read and how many ids came before each.

Ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``: pieces are encoded once each, but a text that holds
one of the file's added tokens, such as <|endoftext|>, is encoded by the library as a whole and gets that token's id.

Defined results: null and empty texts hold only the end id; null ids come first; repeated ids keep their rows, in the order
of their texts' hashes; an empty table gives no files and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktide.llm.pretokens import Pretokenizer, Vocabulary, text_slices
from ranktide.llm.runtime import documents, ready, table, to_batches
from ranktide.session import application_folder, freeze

END_ID = 2
FILE_BYTES, MOST_FILE_BYTES = 24 << 20, 1 << 30  # of text behind one file, and of the files of a large input
FILE_ROWS = 250_000
FILES = 4096  # that an input has before its files grow
HELD_WORDS = 1_500_000  # in each worker, about 50 bytes each
LEVEL = 3

# Fixed values of the zstandard frame and seekable formats.
SKIPPABLE_DIRECTORY, SKIPPABLE_SEEK_TABLE = 0x184D2A50, 0x184D2A5E
SEEKABLE_MAGIC, HAS_CHECKSUMS = 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
DOCUMENT = np.dtype([("known", "u1"), ("doc_id", "<i8")])


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{os.path.abspath(folder)}"
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return pafs.FileSystem.from_uri(folder)


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class FrameWriter:
    """Writes documents one by one into an open file."""

    def __init__(self, sink) -> None:
        self.sink, self.packer = sink, zstandard.ZstdCompressor(level=LEVEL)
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int]] = []

    def add(self, doc_id: int | None, content: bytes) -> None:
        packed = self.packer.compress(content)
        self.sink.write(packed)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.documents.append((doc_id is not None, doc_id or 0))

    def finish(self) -> None:
        self.sink.write(_skippable(SKIPPABLE_DIRECTORY, np.array(self.documents, dtype=DOCUMENT).tobytes()))
        footer = FOOTER.pack(len(self.entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.sink.write(_skippable(SKIPPABLE_SEEK_TABLE, np.array(self.entries, dtype=ENTRY).tobytes() + footer))


class FrameReader:
    """Finds documents in a file by its trailing tables; ``source`` is a seekable file."""

    def __init__(self, source) -> None:
        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - FOOTER.size)
        frames, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("not a file of seekable frames with checksums")
        table_bytes, names_bytes = frames * ENTRY.itemsize, frames * DOCUMENT.itemsize
        table_at = size - FOOTER.size - table_bytes
        source.seek(table_at - 8 - names_bytes)
        tail = source.read(names_bytes + 8 + table_bytes)
        self.documents = np.frombuffer(tail[:names_bytes], dtype=DOCUMENT)
        self.entries = np.frombuffer(tail[names_bytes + 8 :], dtype=ENTRY)
        ends = np.cumsum(self.entries["packed"], dtype=np.int64)
        self.offsets = ends - self.entries["packed"]

    def __len__(self) -> int:
        return len(self.entries)

    def doc_id(self, i: int) -> int | None:
        return int(self.documents["doc_id"][i]) if self.documents["known"][i] else None

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document, checked."""
        self.source.seek(int(self.offsets[i]))
        content = self.unpacker.decompress(self.source.read(int(self.entries["packed"][i])))
        if len(content) != self.entries["size"][i] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.entries["checksum"][i]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(content, dtype="<u4")

    def find(self, doc_ids: list[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The asked documents that are here; no other frame is read."""
        there = np.flatnonzero(np.isin(self.documents["doc_id"], doc_ids) & (self.documents["known"] == 1))
        for i in there.tolist():
            yield self.doc_id(i), self.ids(i)


def word_encoder(tokenizer) -> Callable[[list[str]], list[list[int]]]:
    """Ids of single words by the tokenizers library."""

    def encode(words: list[str]) -> list[list[int]]:
        tokenizer.encode_special_tokens = True
        return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    return encode


def text_encoder(tokenizer) -> Callable[[list[str]], dict[int, np.ndarray]]:
    """Ids of the texts that hold an added token of the vocabulary, by their index."""
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def encode(texts: list[str]) -> dict[int, np.ndarray]:
        holding = [i for i, text in enumerate(texts) if any(token in text for token in added)]
        tokenizer.encode_special_tokens = False
        found = tokenizer.encode_batch_fast([texts[i] for i in holding], add_special_tokens=False)
        return {i: np.array(e.ids, dtype="<u4") for i, e in zip(holding, found, strict=True)}

    return encode


_tools: dict[str, tuple] = {}


def tools(path: str) -> tuple[Vocabulary, Pretokenizer, Callable[[list[str]], dict[int, np.ndarray]]]:
    """What encoding by a vocabulary file needs, made once in each Python worker; the words it has met stay from task to task."""
    if path not in _tools:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _tools[path] = Vocabulary(word_encoder(tokenizer), HELD_WORDS), Pretokenizer(), text_encoder(tokenizer)
    return _tools[path]


def _writer(folder: str, path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, base = open_folder(folder)
        # Each attempt has a file of its own; the manifest names that of the attempt which counts.
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.ids.zst"
        count = total = 0
        writer = sink = None
        for batch, texts in text_slices(batches):
            if writer is None:
                words, cutter, with_added = tools(path)
                system.create_dir(base, recursive=True)
                sink = system.open_output_stream(f"{base}/{name}", compression=None)
                writer = FrameWriter(sink)
            whole = with_added(texts)
            ids, bounds = words.ids(["" if i in whole else t for i, t in enumerate(texts)] if whole else texts, cutter)
            ids = ids.astype("<u4")
            end = np.array([end_id], dtype="<u4").tobytes()
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                own = whole[i] if i in whole else ids[bounds[i] : bounds[i + 1]]
                writer.add(doc_id, own.tobytes() + end)
            count += len(texts)
            total += len(ids) + sum(map(len, whole.values())) + len(texts)
        if writer is not None:
            writer.finish()
            sink.close()
            yield to_batches({"part": [context.partitionId()], "file": [name], "documents": [count], "n_tokens": [total]}, schema)

    return write


def file_count(size: int, rows: int) -> int:
    """Into how many files documents go, by the bytes of their texts and their number."""
    of_file = min(max(FILE_BYTES, size // FILES), MOST_FILE_BYTES)
    return max(1, -(-size // of_file), -(-rows // FILE_ROWS))


def write_tokens(df: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes all documents of ``df`` to files in ``folder``, which every executor must reach.

    Returns the manifest: part, file, documents, n_tokens and ``before``, the ids in all files before it.
    """
    ready(df.sparkSession)
    docs = documents(df)
    size, count = docs.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = file_count(size or 0, count)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = "part int, file string, documents long, n_tokens long"
    manifest = freeze(ranged.mapInArrow(_writer(folder, path or vocabulary_path(), end_id), schema=schema))
    # One row per file: a window over all of them is small.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))


def _reader(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{base}/{row['file']}") as source:
                    reader = FrameReader(source)
                    rows, start = [], row["before"]
                    for i in range(len(reader)):
                        ids = reader.ids(i)
                        rows.append((reader.doc_id(i), start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                columns = list(zip(*rows, strict=True))
                yield to_batches(dict(zip(schema.names, columns, strict=True)), schema)

    return read


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """Reads every frame of every file: doc_id, start, n_tokens and the checksum of its ids."""
    files = manifest.count()
    spread = manifest.select("file", "before").repartition(max(1, files))
    return spread.mapInArrow(_reader(folder), schema="doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = application_folder(spark, "token-files")
    return read_digests(write_tokens(table(spark, sf_dir, "documents"), folder), folder)
