"""What the physical plans must and must not contain, with dimensions too large to be broadcast."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from ranktide.operators import quality
from ranktide.plans import loaded
from ranktide.plans.catalog import QUERIES
from ranktide.sources import trade

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")

# Queries that run jobs of their own before they return.
EAGER = {"batch_load", "copy_tables", *loaded.QUERIES}
# Its one ordered window is over the run log, which has a row per run.
SMALL_WINDOW = {"run_alerts"}


@pytest.fixture
def large_tables(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_nested_loops_and_no_python_rows(large_tables, name):
    plan = plan_of(entry_points.queries()[name](large_tables, FOLDER))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    if name in SMALL_WINDOW:
        return
    # Rows meet in one task only when they have been counted, as partial results, as a bounded number of ranges or as the first
    # few of an order.
    for place in re.finditer(r"Exchange SinglePartition[^\n]*\n[^\n]*", plan):
        below = place[0].split("\n")[1]
        assert re.search(r"partial_|GlobalLimit|LocalLimit|HashAggregate\(keys=\[_range#", below), below


def test_top_ten_is_not_a_full_sort(spark):
    plan = plan_of(entry_points.queries()["quick_wins_top10"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_newest_row_of_a_pair_is_a_group_limit(spark):
    plan = plan_of(entry_points.queries()["quick_wins"](spark, FOLDER))
    assert "WindowGroupLimit" in plan


def test_copies_are_cut_before_the_shuffle(spark):
    plan = plan_of(entry_points.queries()["dedupe_positions"](spark, FOLDER))
    assert re.search(r"WindowGroupLimit[^\n]*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit[^\n]*Partial", plan)


def test_only_needed_columns_are_read(spark):
    plan = plan_of(entry_points.queries()["clicks_trend"](spark, FOLDER))
    lineitem = next(m for m in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_suppkey" in m)
    columns = {c.split("#")[0] for c in lineitem.split(",")}
    assert columns == {"l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"}


def test_whole_tables_of_lines_and_events_are_read(spark):
    assert "PushedFilters: [IsNotNull(event_type)" not in plan_of(entry_points.queries()["issue_impact"](spark, FOLDER))
    links = trade.backlinks(trade.Trade(spark, FOLDER))
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").join(
        spark.read.parquet(f"{FOLDER}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    page = F.greatest(F.floor(F.col("l_suppkey") / 4), F.lit(1)) * 4
    assert links.count() == lines.select(page, "o_custkey").distinct().count()
    issues = trade.issues(trade.Trade(spark, FOLDER))
    assert issues.count() == spark.read.parquet(f"{FOLDER}/events.parquet").count()


def test_fact_is_read_once_for_counts_and_rows(large_tables):
    df = entry_points.queries()["cannibalization"](large_tables, FOLDER)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_constraints_have_small_partitions_and_other_queries_do_not(spark):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    report = entry_points.queries()["constraint_report"](spark, FOLDER)
    assert report.sparkSession.conf.get(size) != before == spark.conf.get(size)
    initial = int(report.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))
    assert initial > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(report.collect()) == set(quality.constraint_checks(trade.star(spark, FOLDER)).collect())
