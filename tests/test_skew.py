"""One key with a third of all rows: results stay whole and its rows are spread over tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ranktide.operators import cleaning
from ranktide.operators.numbering import number_rows
from ranktide.plans import analyses, views

ROWS, PAGES, KEYWORDS = 120_000, 3_000, 5_000

SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "24KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def star(spark):
    """Page 0 has a third of the facts and keyword 1 another; the rest is spread evenly."""
    fact = spark.range(ROWS).selectExpr(
        "id AS position_id",
        f"if(id % 3 = 1, 1L, (id * 7919) % {KEYWORDS}) AS keyword_id",
        f"if(id % 3 = 0, 0L, (id * 104729) % {PAGES}) AS page_id",
        "concat('20', 10 + cast(id DIV 12000 AS int), '-01-01') AS snapshot_date",
        "cast(id % 40 AS int) AS position",
        "cast(id % 37 AS int) AS previous_position",
        "id % 11 AS clicks_30d",
        "id % 101 AS impressions_30d",
        "0.1D AS ctr_30d",
    ).dropDuplicates(["keyword_id", "page_id", "snapshot_date"])
    return {
        "fact_keyword_position": fact.cache(),
        "dim_keyword": spark.range(KEYWORDS).selectExpr(
            "id AS keyword_id", "concat('keyword ', id) AS keyword", "'comercial' AS category", "id AS monthly_search_volume",
            "cast(id % 100 AS int) AS keyword_difficulty"),
        "dim_page": spark.range(PAGES).selectExpr(
            "id AS page_id", "id % 5 AS site_id", "concat('https://x.example/', id) AS url",
            "if(id % 4 = 0, 0, 1) AS indexable", "50 AS page_speed_score"),
        "dim_site": spark.range(5).selectExpr("id AS site_id", "concat('s', id, '.example') AS domain"),
    }


@pytest.fixture
def small_limits(spark):
    for key, value in SMALL_LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_LIMITS:
        spark.conf.unset(key)


PLANS = {
    "position_changes": views.position_changes,
    "clicks_trend": analyses.clicks_trend,
    "noindex_impressions": analyses.noindex_impressions,
}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_hot_join_keys_are_split(spark, star, small_limits, name):
    df = PLANS[name](star)
    got = sorted(map(repr, df.collect()))
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert re.search(r"SortMergeJoin\(skew=true\)", final), final
    for key in SMALL_LIMITS:
        spark.conf.unset(key)
    assert got == sorted(map(repr, PLANS[name](star).collect()))


def test_hot_keyword_lists_all_its_pages(star):
    newest = star["fact_keyword_position"].filter("snapshot_date = '2019-01-01' AND position > 0")
    expected = {r.keyword_id: r.n for r in newest.groupBy("keyword_id").agg(F.count("*").alias("n")).collect()}
    found = analyses.cannibalization(star).groupBy("keyword").agg(F.count_distinct("url").alias("n"))
    got = {row.keyword: row.n for row in found.collect()}
    assert got == {f"keyword {key}": n for key, n in expected.items() if n > 1}
    assert max(got.values()) > 900


def test_copies_of_one_key_are_cut_in_every_task(spark):
    raw = spark.range(0, 60_000, 1, 12).selectExpr(
        "if(id % 3 > 0, 'hot', concat('k', id)) AS keyword", "'comercial' AS category", "'x' AS search_intent",
        "cast(id AS string) AS monthly_search_volume", "'5' AS keyword_difficulty", "'f' AS src_file", "0L AS src_block",
        "id AS src_row")
    valid = cleaning.clean_keywords(raw).valid
    assert valid.count() == 20_001
    assert valid.filter("keyword = 'hot'").first().monthly_search_volume == 1


def test_range_numbering_stays_even_with_a_hot_leading_value(spark):
    frame = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 > 0, 'hot', cast(id AS string)) AS k", "id")
    numbered = number_rows(frame, ["k", "id"], "n")
    got = numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(got) == (1, 40_000, 40_000)
    ranked = frame.repartitionByRange(8, F.asc("k"), F.asc("id")).groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in ranked.collect()) < 40_000 / 8 * 2
