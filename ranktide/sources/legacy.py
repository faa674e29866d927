"""Copying the older tables into parquet, whole and checked."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEGACY_TABLES = ("dim_keyword", "dim_date", "fact_keyword_performance", "raw_keywords")


def copy_tables(
    spark: SparkSession, source: str, target: str, tables: Iterable[str] = LEGACY_TABLES, source_format: str = "parquet"
) -> DataFrame:
    """Each table from ``source`` to ``target``, replacing an earlier copy; one row of counts per table.

    The source rows are counted while they are copied, the target rows from the files written.
    """
    report = []
    for name in tables:
        seen = Observation(f"copy {name}")
        frame = spark.read.format(source_format).option("header", True).load(f"{source.rstrip('/')}/{name}")
        path = f"{target.rstrip('/')}/{name}"
        frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        report.append((name, int(seen.get["rows"]), spark.read.parquet(path).count()))
    counts = spark.createDataFrame(report, "table string, source_rows bigint, target_rows bigint")
    return counts.withColumn("equal", F.col("source_rows") == F.col("target_rows"))
