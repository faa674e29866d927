"""Views, analyses and rules on the sample: against their SQL, and in the parts that can be followed by hand."""

from __future__ import annotations

import duckdb
import pytest

from check_oracle import bag
from oracle.queries import BODIES
from oracle.tables import with_tables
from ranktide.operators import quality, rules
from ranktide.plans import analyses, views
from sample import sample_star, url

PLANS = {
    "quick_wins": views.quick_wins,
    "quick_wins_top10": analyses.quick_wins_top,
    "position_changes": views.position_changes,
    "category_summary": views.category_summary,
    "indexation_health": views.indexation_health,
    "backlink_gaps": views.backlink_gaps,
    "executive_summary": views.executive_summary,
    "almost_winning": analyses.almost_winning,
    "decay": analyses.decay,
    "issue_impact": analyses.issue_impact,
    "noindex_impressions": analyses.noindex_impressions,
    "cannibalization": analyses.cannibalization,
    "ctr_below_benchmark": analyses.ctr_below_benchmark,
    "ranking_without_backlinks": analyses.ranking_without_backlinks,
    "clicks_trend": analyses.clicks_trend,
    "page_health": analyses.page_health,
}


@pytest.fixture(scope="module")
def star(spark):
    return {name: df.cache() for name, df in sample_star(spark).items()}


@pytest.fixture(scope="module")
def connection(star):
    connection = duckdb.connect()
    for name, df in star.items():
        connection.register(name, df.toArrow())
    return connection


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(PLANS))
def test_view_equals_its_sql_on_the_sample(star, connection, name):
    df = PLANS[name](star)
    result = connection.execute(with_tables(BODIES[name], frozenset(star)))
    names, expected = [d[0] for d in result.description], result.fetchall()
    assert expected and sorted(names) == sorted(df.columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(names, expected)


def test_quick_wins_by_hand(star):
    got = rows(views.quick_wins(star).filter("keyword_id = 4 OR keyword_id = 1"), "keyword_id", "page_id", "position_delta",
               "confidence_score", "ease_score")
    # Position 1 is no quick win; difficulty 20 and position 4 give 1 + 9 * 80 / 100 and 1 + 9 * 27 / 30.
    assert sorted(got) == [(1, 1, 3, 8.2, 9.1), (1, 5, 0, 8.2, 6.4)]


def test_quick_wins_takes_each_pairs_newest_row_before_the_zone(spark, star):
    before = {r[0] for r in rows(views.quick_wins(star), "position")}
    later = star["fact_keyword_position"].filter("keyword_id = 3").selectExpr(
        "100 AS position_id", "keyword_id", "page_id", "'2026-03-09' AS snapshot_date", "2 AS position",
        "8 AS previous_position", "clicks_30d", "impressions_30d", "ctr_30d")
    moved = dict(star) | {"fact_keyword_position": star["fact_keyword_position"].unionByName(later)}
    assert before - {r[0] for r in rows(views.quick_wins(moved), "position")} == {8}


def test_position_changes_by_hand(star):
    changes = views.position_changes(star, ordered=True)
    trends = [r[0] for r in rows(changes, "trend")]
    # Place 0 compares as the best one, and a pair without an earlier place is new.
    assert {t: trends.count(t) for t in trends} == {"improved": 4, "stable": 3, "declined": 4, "new": 1}


def test_executive_summary_keeps_sites_without_pages(spark, star):
    lonely = star["dim_site"].unionByName(spark.createDataFrame([(3, "new.example", "New", "es", "ES", 1)],
                                                                star["dim_site"].schema))
    got = rows(views.executive_summary(dict(star) | {"dim_site": lonely}).filter("domain = 'new.example'"), "*")
    assert got == [("new.example", 0, 0, 0, 0, None, None, 0, 0)]


def test_views_answer_sql(spark, star):
    views.register(spark, star)
    best = analyses.quick_wins_top(star, limit=1).first()
    top = spark.sql("SELECT keyword, ice_score FROM vw_quick_wins_priority ORDER BY ice_score DESC LIMIT 1").first()
    assert tuple(top) == (best.keyword, best.ice)
    assert spark.sql("SELECT count(*) FROM vw_executive_summary").first()[0] == 2


def test_decay_by_hand(star):
    got = rows(analyses.decay(star), "keyword", "pos_antes", "pos_ahora", "caida")
    assert sorted(got) == [("compost bin", 25, 31, 6), ("lawn feed", 13, 29, 16), ("tomato seeds", 2, 8, 6)]


def test_noindex_impressions_by_hand(star):
    assert rows(analyses.noindex_impressions(star), "*") == [(url(4), 0, 700, 7, 1)]


def test_cannibalization_by_hand(star):
    got = rows(analyses.cannibalization(star), "keyword", "url", "n_paginas_compitiendo")
    # "raised beds" has its second page at place 0, so it doesn't compete.
    assert sorted(got) == [("clay pots", url(5), 2), ("clay pots", url(1), 2), ("slug control", url(6), 2), ("slug control", url(7), 2)]


def test_cannibalization_has_one_grain_at_any_size(spark, star):
    fact = spark.range(1, 20_001).selectExpr(
        "id AS position_id", "1L AS keyword_id", "id AS page_id", "'2026-09-10' AS snapshot_date", "5 AS position",
        "NULL AS previous_position", "0L AS clicks_30d", "0L AS impressions_30d", "NULL AS ctr_30d")
    pages = spark.range(1, 20_001).selectExpr("id AS page_id", "concat('https://x.example/', id) AS url")
    got = analyses.cannibalization(dict(star) | {"fact_keyword_position": fact, "dim_page": pages})
    assert got.count() == got.select("url").distinct().count() == 20_000
    assert rows(got.select("n_paginas_compitiendo").distinct(), "*") == [(20_000,)]


def test_backlog_by_tier(star):
    tiers = rows(views.quick_wins(star), "priority_tier")
    for tier in {t for (t,) in tiers}:
        assert analyses.priority_backlog(star, tier=tier).count() == tiers.count((tier,))


def test_table_counts(star):
    assert dict(rows(analyses.table_counts(star), "tabla", "filas")) == {
        "dim_keyword": 9, "dim_page": 8, "fact_keyword_position": 12, "fact_technical_issue": 7, "etl_run_log": 1}


def test_rules(star):
    parts = star["dim_page"], star["fact_keyword_position"], star["fact_technical_issue"]
    assert rules.noindex_issues(*parts, "2026-03-20").count() == 0
    open_ones = rules.decay_issues(*parts, "2026-03-20", suppress="open").orderBy("page_id")
    assert rows(open_ones, "issue_id", "site_id", "page_id", "severity", "detected_at") == [
        (8, 1, 2, "medium", "2026-03-20"), (9, 1, 3, "medium", "2026-03-20")]
    today = rules.decay_issues(*parts, "2026-03-20", suppress="today").orderBy("page_id")
    assert rows(today, "page_id", "severity") == [(2, "medium"), (3, "medium"), (8, "high")]
    same_day = rules.decay_issues(*parts, "2026-02-27", suppress="today")
    assert {r.page_id for r in same_day.collect()} == {2, 3}


def test_noindex_rule_needs_a_ranking_page_without_active_issue(spark, star):
    pages = star["dim_page"].selectExpr("page_id", "site_id", "url", "title", "meta_description", "h1", "word_count",
                                        "if(page_id IN (4, 6, 7), 0, 1) AS indexable", "page_speed_score",
                                        "last_crawled_at")
    found = rules.noindex_issues(pages, star["fact_keyword_position"], star["fact_technical_issue"], "2026-03-20")
    assert rows(found.orderBy("page_id"), "issue_id", "page_id", "severity", "status") == [
        (8, 6, "critical", "open"), (9, 7, "critical", "open")]


def test_unranked_option(star):
    changed = star["fact_keyword_position"].selectExpr(
        "position_id", "keyword_id", "page_id", "snapshot_date",
        "CASE keyword_id WHEN 7 THEN 0 ELSE position END AS position", "previous_position", "clicks_30d",
        "impressions_30d", "ctr_30d")
    lost = dict(star) | {"fact_keyword_position": changed}
    plain = views.position_changes(lost).filter("keyword = 'winter fleece'").first()
    strict = views.position_changes(lost, zero_is_unranked=True).filter("keyword = 'winter fleece'").first()
    assert (plain.trend, plain.position_delta) == ("improved", 11)
    assert (strict.trend, strict.position_delta) == ("declined", -90)


def test_checks_pass_on_the_sample(star):
    assert quality.failed(quality.load_checks(star)).count() == 0
    assert quality.failed(quality.constraint_checks(star)).count() == 0
