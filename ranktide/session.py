"""Session settings and the one place where intermediate results are persisted."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Settings a run needs to behave well on a large cluster; none depends on the size of the machine.
SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over several tasks at run time, also when that costs a further shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Recording a Python call site for every column costs more than building the column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


# The part of them that a session made elsewhere can still take on.
ADAPTIVE = tuple(key for key in SETTINGS if key.startswith("spark.sql.adaptive."))


SMALL_PARTITION, PARTITIONS_FACTOR = "8MB", 4


def prepare(spark: SparkSession) -> SparkSession:
    """Turns on adaptive execution with splitting of hot join keys in a session made elsewhere."""
    for key in ADAPTIVE:
        spark.conf.set(key, SETTINGS[key])
    return spark


def build_session(master: str | None = None, app_name: str = "ranktide", **overrides: str) -> SparkSession:
    """A session with ``SETTINGS``; ``overrides`` uses ``__`` for the dots of a setting name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def with_small_partitions(spark: SparkSession) -> SparkSession:
    """A session beside ``spark``, with its settings, whose shuffles make more and smaller partitions.

    For plans that hold several entries for each row they have read: what a task holds then follows ``SMALL_PARTITION``
    and not the input.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    partitions = PARTITIONS_FACTOR * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", SMALL_PARTITION)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may go without it: there a fresh temporary folder is the shared folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="ranktide-")
    spark.sparkContext.setCheckpointDir(f"file://{folder}")
    return spark.sparkContext.getCheckpointDir()


def application_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, under the application's own, which may go when it has ended."""
    return "/".join([shared_folder(spark).rstrip("/"), spark.sparkContext.applicationId, kind, uuid.uuid4().hex])


def observed(seen: Observation, column: str) -> int:
    """A count that a write has observed; 0 where the optimizer found that there was nothing to run, and nothing to observe."""
    try:
        return int(seen.get[column])
    except Py4JJavaError as error:
        if "AssertionError" in error.java_exception.getClass().getName():  # an empty row of figures
            return 0
        raise


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """What ``freeze`` writes inside goes when the block ends; by then whoever reads it must have written its own result."""
    from ranktide.sources.files import remove

    written: list[str] = []
    token = _passing.set(written)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in written:
            remove(spark, path)


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a value must not change when a task is run again (row numbers), or where the size of
    an intermediate result should be known to the planner. Losing executors afterwards loses nothing.
    """
    path = application_folder(df.sparkSession, "frozen")
    passing = _passing.get()
    if passing is not None:
        passing.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffle files behind tables that no plan holds any more."""
    spark.sql("SELECT 1").collect()  # the end of the query before is what Spark's listeners hold until there is another one
    gc.collect()  # Python's references to plans of the JVM
    # A thread beside this one tells the JVM of them, now and then; what it has not come to would outlive the collection.
    told = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    while told:
        try:
            client, target = told.pop()
        except (IndexError, ValueError):  # the thread was faster, or is about to end
            break
        client.garbage_collect_object(target, False)
    time.sleep(0.05)  # for what the thread, or the queue of Spark's events, has in hand
    spark.sparkContext._jvm.System.gc()
