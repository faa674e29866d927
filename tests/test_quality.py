"""Planted violations, alerts, scoring edges and the mart."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ranktide.functions.numeric import ratio_or_zero, round_half_up
from ranktide.functions.scoring import ctr_benchmark, ice, tier_of
from ranktide.operators import quality
from ranktide.plans import mart, views
from ranktide.schemas import FACT_PERFORMANCE, RUN_LOG
from sample import sample_star


def report(df):
    return {r["check"]: (r["status"], r["violations"]) for r in df.collect()}


def test_load_checks_catch_planted_rows(spark):
    star = sample_star(spark)
    bad = dict(star)
    bad["dim_keyword"] = star["dim_keyword"].filter("keyword_id <> 8")
    bad["dim_page"] = star["dim_page"].withColumn("indexable", F.expr("CASE page_id WHEN 1 THEN 2 WHEN 2 THEN NULL ELSE 1 END"))
    bad["fact_keyword_position"] = star["fact_keyword_position"].withColumn("ctr_30d", F.expr("if(position_id < 4, 1.5D, 1D)"))
    got = report(quality.load_checks(bad))
    assert got["fact_keyword_position.ctr_30d at most 1"] == ("FAIL", 3)
    assert got["dim_page.indexable in accepted values"] == ("FAIL", 1)  # NULL is not a wrong value
    assert got["fact_keyword_position.keyword_id has parent"] == ("FAIL", 2)
    assert got["dim_keyword not empty"] == ("PASS", 0)
    empty = report(quality.load_checks(bad | {"dim_keyword": star["dim_keyword"].limit(0)}))
    assert empty["dim_keyword not empty"] == ("FAIL", 1)
    unnamed = dict(star) | {"fact_keyword_position": star["fact_keyword_position"].withColumn("keyword_id", F.expr("nullif(keyword_id, 8)"))}
    assert report(quality.load_checks(unnamed))["fact_keyword_position.keyword_id has parent"] == ("FAIL", 2)
    with pytest.raises(ValueError, match="has parent: 2"):
        quality.require(quality.load_checks(bad))
    quality.require(quality.load_checks(star))


def test_constraints_catch_planted_rows(spark):
    star = sample_star(spark)
    page = star["dim_page"]
    bad = dict(star) | {
        "dim_page": page.unionByName(page.filter("page_id = 3").withColumn("page_speed_score", F.lit(101)).withColumn("site_id", F.lit(9)))
    }
    bad["fact_technical_issue"] = star["fact_technical_issue"].withColumn("severity", F.expr("if(issue_id = 1, 'huge', severity)"))
    bad["fact_backlink"] = star["fact_backlink"].withColumn("referring_domain", F.lit("same"))
    failures = {r["check"]: r["violations"] for r in quality.failed(quality.constraint_checks(bad)).collect()}
    assert failures == {
        "dim_page.page_id unique": 1,
        "dim_page.url unique": 1,
        "dim_page.page_speed_score in range": 1,
        "dim_page.site_id has parent": 1,
        "fact_technical_issue.severity in accepted values": 1,
        "fact_backlink.page_id+referring_domain unique": 1,
    }


def test_freshness(spark):
    star = sample_star(spark)
    assert report(quality.freshness(star, "2026-03-10")) == {"newest snapshot at most 8 days old": ("PASS", 0)}
    assert report(quality.freshness(star, "2026-03-11")) == {"newest snapshot at most 8 days old": ("FAIL", 1)}
    none = {"fact_keyword_position": star["fact_keyword_position"].limit(0)}
    assert report(quality.freshness(none, "2026-03-11"))["newest snapshot at most 8 days old"][0] == "FAIL"


def test_run_alerts(spark):
    rows = [(1, "success", 100), (2, "success", 51), (3, "failed", None), (4, "success", 25), (5, "running", None),
            (6, "success", 13)]
    runs = spark.createDataFrame([(i, "t", "t", s, n, n, None) for i, s, n in rows], RUN_LOG.struct)
    got = {(r.run_id, r.reason) for r in quality.run_alerts(runs).collect()}
    assert got == {(3, "run failed"), (4, "rows extracted fell")}


def test_tier_limit_and_drop_alerts(spark):
    star = sample_star(spark)
    wins = views.quick_wins(star)
    n = wins.filter("priority_tier = 'P3 - Medium'").count()
    assert n > 1
    assert report(quality.active_tier_limit(wins, "P3 - Medium", limit=n - 1)) == {f"at most {n - 1} rows of P3 - Medium": ("FAIL", 1)}
    assert report(quality.active_tier_limit(wins)) == {"at most 10 rows of P1 - Critical": ("PASS", 0)}
    drops = quality.drop_alerts(views.position_changes(star))
    assert sorted(r.position_delta for r in drops.collect()) == [-16, -6, -6]


def test_scores_at_their_edges(spark):
    cases = [(0, 0, 4), (1, 100, 30), (100000, 0, 4), (10**9, 50, 31), (100, 50, 60)]
    frame = spark.createDataFrame(cases, "v bigint, d int, p int")
    score = ice(F.col("v"), F.col("d"), F.col("p"))
    got = frame.select(score.impact, score.confidence, score.ease, score.score).collect()
    for (v, d, p), (impact, confidence, ease, total) in zip(cases, got):
        assert impact == pytest.approx(min(10, 1 + 9 * math.log10(max(v, 1)) / 5))
        assert confidence == pytest.approx(1 + 9 * (100 - d) / 100)
        assert ease == pytest.approx(max(1, 1 + 9 * (31 - p) / 30))
        assert total == pytest.approx(impact * confidence * ease / 100)
    assert got[2][3] == pytest.approx(9.1) and got[4][2] == 1.0


def test_tiers_and_benchmarks_at_their_bounds(spark):
    tiers = spark.createDataFrame([(7.0,), (6.999,), (4.0,), (3.999,), (2.0,), (1.999,)], "x double")
    assert [r[0][:2] for r in tiers.select(tier_of(F.col("x"))).collect()] == ["P1", "P2", "P2", "P3", "P3", "P4"]
    places = spark.createDataFrame([(p,) for p in (0, 1, 2, 3, 4, 5, 6, 10, 11)], "p int")
    assert [r[0] for r in places.select(ctr_benchmark(F.col("p"))).collect()] == [28, 28, 15, 15, 8, 8, 4, 4, 1.5]


def test_rounding_and_ratios(spark):
    frame = spark.createDataFrame([(0.125, 2), (2.5, 0), (0.0, 0)], "x double, n int")
    assert [r[0] for r in frame.select(round_half_up(F.col("x"))).collect()] == [0.13, 2.5, 0.0]
    assert [r[0] for r in frame.select(round_half_up(F.col("x"), 0)).collect()] == [0.0, 3.0, 0.0]
    assert [r[0] for r in frame.select(ratio_or_zero(F.col("x"), F.col("n"))).collect()] == [0.0625, 0.0, 0.0]


@pytest.fixture(scope="module")
def performance(spark):
    # fact, date, keyword, volume, difficulty, position, ctr, traffic
    rows = [
        (1, 1, 1, 10, 49, 4, 0.1, 100), (2, 1, 2, 10, 50, 4, 0.1, 100), (3, 1, 3, 10, 10, 3, 0.1, 50),
        (4, 1, 4, 10, 10, 11, 0.1, 200), (5, 1, 5, 10, 10, 0, 0.1, 50), (6, 2, 1, 10, 10, 10, 0.1, 7),
        (7, 1, 99, 10, 10, 5, 0.1, 900),
    ]
    facts = spark.createDataFrame(rows, FACT_PERFORMANCE.struct)
    keywords = spark.range(1, 6).selectExpr("id AS keyword_id", "concat('kw ', id) AS keyword_text", "'any' AS search_intent", "'comercial' AS category")
    return {"fact_keyword_performance": facts, "dim_keyword": keywords}


def test_mart(spark, performance, tmp_path):
    table = mart.build(performance, str(tmp_path / "mart"))
    got = {(r.date_id, r.keyword_id): r for r in table.collect()}
    assert len(got) == 6 and len(table.columns) == 15  # keyword 99 is unknown
    assert {k[1]: v.traffic_rank for k, v in got.items() if k[0] == 1} == {4: 1, 1: 2, 2: 2, 3: 4, 5: 4}
    assert {k[1]: v.position_rank for k, v in got.items() if k[0] == 1} == {5: 1, 3: 2, 1: 3, 2: 4, 4: 5}
    assert got[1, 1].classification == mart.QUICK_WIN and got[1, 2].classification == mart.NEEDS_WORK
    assert got[1, 3].classification == got[1, 5].classification == mart.ALREADY_RANKED
    assert (got[1, 1].oportunidad_mejora, got[1, 1].prioridad_score, got[1, 2].prioridad_score) == (400.0, 400, 0)
    assert got[2, 1].traffic_rank == got[2, 1].position_rank == 1
    assert spark.table("stg_fact_keyword_performance").count() == 7
    assert quality.failed(quality.mart_checks(table)).count() == 0
    single_date = quality.failed(quality.mart_checks(table, keys=("keyword_id",))).collect()
    assert [r["check"] for r in single_date] == ["mart.keyword_id unique"]
    summary = {r.classification: (r.n, r.prioridad_total) for r in mart.class_summary(performance).collect()}
    assert summary == {mart.QUICK_WIN: (2, 428), mart.ALREADY_RANKED: (2, 0), mart.NEEDS_WORK: (2, 0)}
