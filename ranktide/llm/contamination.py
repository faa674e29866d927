"""Operator 1: benchmark decontamination, in DataFrame functions only.

Words are the runs of letters and digits of the lower-cased text; an item's set has its distinct runs of five words. An
item of one to four words is one run of that many. A document contains an item if at least 80 % of the item's set
occurs in it.

The search is a MinHash containment search over partitions of the items by size. An item of n shingles may lack at most
floor(n / 5) of them, so of the floor(u / 5) + 1 shingles with the smallest hashes, u being the largest size of its
partition, a document that contains it has at least one; that sketch is what all shingles of all documents are
looked up in. As the bound is certain, the search loses nothing however long the documents are. Candidates with enough
hits are verified: their documents' shingles, as strings, are counted against the item's.

Sketches and item shingles are broadcast if they have at most ``BROADCAST_ROWS`` rows, likewise the candidates; beyond
that the same joins shuffle, and Spark splits hot keys. Documents are exploded to hashes only inside a task: what is
shuffled are hits.

Defined results: texts without words, null texts, and rows with a null doc_id or item_id give no pair; several rows of one
doc_id (or item_id) count as one document (item) with the shingles of all; empty tables give an empty result; columns
besides doc_id, item_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ranktide.llm.runtime import documents, ready, table
from ranktide.session import freeze

WORDS = 5
PERCENT = 80
BROADCAST_ROWS = 200_000
NOT_WORDS = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    """The words of a text; an empty text has one empty word, which the callers leave out by its length."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), NOT_WORDS, " ")), " ")


def _starts(width: int) -> Column:
    last = F.size("_words") - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashes(widths: list[int]) -> Column:
    """Hashes of all runs of the given numbers of words."""

    def of(width: int) -> Column:
        words = lambda i: (F.get(F.col("_words"), i + j) for j in range(width))
        return F.transform(_starts(width), lambda i: F.xxhash64(F.lit(width), *words(i)))

    return F.concat(*map(of, widths))


def _strings(widths: list[int]) -> Column:
    def of(width: int) -> Column:
        return F.transform(_starts(width), lambda i: F.array_join(F.slice("_words", i + 1, width), " "))

    return F.concat(*map(of, widths))


def _if_small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame) -> DataFrame:
    """``item_id``, ``width``, ``shingle``, ``hash``: distinct per item."""
    worded = items.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text").cast("string")).alias("_words"))
    worded = worded.where(F.col("item_id").isNotNull() & (F.element_at("_words", 1) != ""))
    parts = []
    for width in range(1, WORDS + 1):
        of_width = F.size("_words") >= WORDS if width == WORDS else F.size("_words") == width
        both = F.arrays_zip(_strings([width]).alias("shingle"), _hashes([width]).alias("hash"))
        parts.append(
            worded.where(of_width)
            .select("item_id", F.lit(width).alias("width"), F.explode(both).alias("_s"))
            .select("item_id", "width", F.col("_s.shingle").alias("shingle"), F.col("_s.hash").alias("hash"))
        )
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.distinct()


def _allowance(size: Column) -> Column:
    """How many of so many shingles a document may lack."""
    return F.floor(size * (100 - PERCENT) / 100).cast("long")


def sketches(shingles: DataFrame) -> DataFrame:
    """``hash``, ``item_id`` and the hits ``needed`` for a candidate."""
    item = Window.partitionBy("item_id")
    sized = shingles.withColumn("_n", F.count("*").over(item))
    # Sizes up to 1, 3, 7, 15 ... make a partition; its largest size gives the sketch length.
    largest = F.pow(F.lit(2), F.floor(F.log2("_n")) + 1).cast("long") - 1
    length = F.least(_allowance(largest) + 1, F.col("_n"))
    ranked = sized.withColumn("_place", F.row_number().over(item.orderBy("hash", "shingle")))
    kept = ranked.where(F.col("_place") <= length)
    needed = F.greatest(length - _allowance(F.col("_n")), F.lit(1))
    return kept.select("hash", "item_id", needed.alias("needed"))


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_shared`` and ``containment`` of every contained item."""
    ready(docs.sparkSession)
    shingles = freeze(item_shingles(items))
    widths = sorted(r["width"] for r in shingles.select("width").distinct().collect()) or [WORDS]
    n_shingles = shingles.count()

    worded = documents(docs).where(F.col("doc_id").isNotNull()).select("doc_id", _words(F.col("text")).alias("_words"))
    looked_up = worded.select("doc_id", F.explode(_hashes(widths)).alias("hash"))
    hits = looked_up.join(_if_small(sketches(shingles), n_shingles), "hash")
    hits = hits.groupBy("doc_id", "item_id", "hash").agg(F.max("needed").alias("needed"))
    counted = hits.groupBy("doc_id", "item_id").agg(F.count("*").alias("_hits"), F.max("needed").alias("needed"))
    candidates = freeze(counted.where(F.col("_hits") >= F.col("needed")).select("doc_id", "item_id"))
    n_candidates = candidates.count()

    suspected = worded.join(_if_small(candidates.select("doc_id").distinct(), n_candidates), "doc_id", "left_semi")
    found = suspected.select("doc_id", F.explode(_strings(widths)).alias("shingle"))
    found = found.join(_if_small(shingles.select("shingle", "item_id"), n_shingles), "shingle")
    found = found.join(_if_small(candidates, n_candidates), ["doc_id", "item_id"], "left_semi")
    shared = found.distinct().groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_item"))
    both = shared.join(_if_small(sizes, n_shingles), "item_id")
    return both.where(100 * F.col("n_shared") >= PERCENT * F.col("n_item")).select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    found = contained_items(docs, items).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), sized AS (SELECT item_id, w, least(5, len(w)) AS width FROM item_words WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS shingle
  FROM (SELECT item_id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM sized)
), doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + width - 1), ' ') AS shingle
  FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM doc_words, (SELECT DISTINCT width FROM sized))
), sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id),
shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared
  FROM doc_shingles JOIN item_shingles USING (shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""
