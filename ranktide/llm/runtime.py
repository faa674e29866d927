"""What every operator of this subpackage shares: session settings, typed inputs, bounded slices."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.session import forget_shuffles, freeze, prepare
from ranktide.sources.files import remove

# Rows that one Arrow batch carries to a Python worker, and bytes of text that are worked on at once.
BATCH_ROWS = 1000
SLICE_BYTES = 1 << 20

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Adaptive execution, small Arrow batches, and Python workers that find this package."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])
    return spark


def written(df: DataFrame) -> DataFrame:
    """``df`` frozen, and the shuffle files behind it dropped: Spark's cleaner removes them once the driver has collected its garbage."""
    kept = freeze(df)
    forget_shuffles(df.sparkSession)
    return kept


def drop(*tables: DataFrame) -> None:
    """Removes the files of frozen tables that no later step reads."""
    for kept in tables:
        for folder in {os.path.dirname(file) for file in kept.inputFiles()}:
            remove(kept.sparkSession, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` as a long and ``text`` as a string, with the named columns; whatever else comes along is left out."""
    kept = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    return df.select(*kept, *(F.col(c) for c in columns))


def input_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column over the whole input, to size partitions by; one aggregation."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of ``column``; a longer text makes a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def lean(work: Work) -> Work:
    """``work``, after which a Python worker gives the memory that it no longer uses back to the system.

    Spark keeps workers and deals tasks out to them in turn, so that each would go on holding what its largest task took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Returns memory that is free in this process, but still held by Arrow or the C library, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def to_batches(arrays: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """Arrays, by column name, as a batch of the schema."""
    return pa.RecordBatch.from_arrays([pa.array(arrays[f.name], type=f.type) for f in schema], schema=schema)
