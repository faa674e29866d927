"""The analysis queries. Sorted reports end with ids as tie-breaks, so their order is total and a run
of equal sort values can be split over several range partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranktide.functions.numeric import ratio_or_zero, round_half_up
from ranktide.functions.scoring import TIERS, ctr_benchmark
from ranktide.operators.snapshots import comparable, latest_global
from ranktide.plans.views import Star, executive_summary, is_active, known_keyword, quick_wins


def _described(fact: DataFrame, star: Star, keyword_columns: tuple[str, ...] = (), keywords=None) -> DataFrame:
    """Fact rows with keyword and URL text."""
    keywords = star["dim_keyword"] if keywords is None else keywords
    return fact.join(keywords.select("keyword_id", "keyword", *keyword_columns), "keyword_id").join(
        star["dim_page"].select("page_id", "url"), "page_id"
    )


def quick_wins_top(star: Star, limit: int = 10) -> DataFrame:
    """The best opportunities by score."""
    return (
        quick_wins(star)
        .orderBy(F.desc("ice_score"), "keyword_id", "page_id")
        .limit(limit)
        .select(
            "keyword",
            "url",
            "position",
            "previous_position",
            "position_delta",
            "monthly_search_volume",
            F.col("ice_score").alias("ice"),
            "priority_tier",
        )
    )


def priority_backlog(star: Star, tier: str = TIERS[0][1]) -> DataFrame:
    """Opportunities of one tier, best first."""
    return (
        quick_wins(star)
        .filter(F.col("priority_tier") == tier)
        .orderBy(F.desc("ice_score"), "keyword_id", "page_id")
        .select("keyword", "url", "ice_score")
    )


def almost_winning(star: Star, lowest: int = 4, highest: int = 10, min_volume: int = 2000) -> DataFrame:
    """Pairs of the newest snapshot just below the top, for keywords with much demand."""
    wanted = star["dim_keyword"].filter(F.col("monthly_search_volume") >= min_volume)
    fact = latest_global(star).filter(F.col("position").between(lowest, highest))
    return (
        _described(fact, star, ("monthly_search_volume",), keywords=wanted)
        .orderBy(F.desc("monthly_search_volume"), "keyword_id", "page_id")
        .select("keyword", "url", "position", "monthly_search_volume", "clicks_30d", "impressions_30d")
    )


def decay(star: Star, min_drop: int = 3, zero_is_unranked: bool = False) -> DataFrame:
    """Pairs of the newest snapshot that lost ``min_drop`` positions or more."""
    now = comparable(F.col("position"), zero_is_unranked)
    before = comparable(F.col("previous_position"), zero_is_unranked)
    fallen = latest_global(star).withColumn("caida", now - before).filter(F.col("caida") >= min_drop)
    return (
        _described(fallen, star, ("monthly_search_volume",))
        .orderBy(F.desc("caida"), "keyword_id", "page_id")
        .select(
            "keyword",
            "url",
            F.col("previous_position").alias("pos_antes"),
            F.col("position").alias("pos_ahora"),
            "caida",
            "monthly_search_volume",
        )
    )


def issue_impact(star: Star) -> DataFrame:
    """Active issues and traffic at risk by type and severity."""
    return (
        star["fact_technical_issue"]
        .filter(is_active(F.col("status")))
        .groupBy("issue_type", "severity")
        .agg(F.count(F.lit(1)).alias("n_issues"), F.sum("traffic_at_risk").alias("trafico_en_riesgo"))
        .orderBy(F.desc("trafico_en_riesgo"), "issue_type", "severity")
    )


def noindex_impressions(star: Star) -> DataFrame:
    """Pages closed to indexing that are still being shown, over all snapshots."""
    closed = star["dim_page"].filter("indexable = 0").select("page_id", "url", "indexable")
    per_keyword = (
        star["fact_keyword_position"]
        .join(closed.select("page_id"), "page_id", "left_semi")
        .groupBy("page_id", "keyword_id")
        .agg(F.sum("impressions_30d").alias("_impressions"), F.sum("clicks_30d").alias("_clicks"))
    )
    shown = (
        known_keyword(per_keyword, star)
        .groupBy("page_id")
        .agg(
            F.sum("_impressions").alias("impresiones_30d"),
            F.sum("_clicks").alias("clicks_30d"),
            F.count("_known").alias("keywords_asociadas"),
        )
        .filter("impresiones_30d > 0")
    )
    return closed.join(shown, "page_id").select(
        "url", "indexable", "impresiones_30d", "clicks_30d", "keywords_asociadas"
    )


def cannibalization(star: Star, min_pages: int = 2) -> DataFrame:
    """Keywords ranking on several pages of the newest snapshot: one row per keyword and competing page.

    The grain is the same at any size; a keyword's URLs are never gathered in one place.
    """
    # Stated once for both uses below, so that the fact is read and shuffled once.
    ranking = (
        latest_global(star)
        .filter("position > 0 AND keyword_id IS NOT NULL AND page_id IS NOT NULL")
        .select("keyword_id", "page_id")
    )
    competing = (
        ranking.groupBy("keyword_id")
        .agg(F.count(F.lit(1)).alias("n_paginas_compitiendo"))
        .filter(F.col("n_paginas_compitiendo") >= min_pages)
        .join(star["dim_keyword"].select("keyword_id", "keyword"), "keyword_id")
    )
    return (
        ranking.join(competing, "keyword_id")
        .join(star["dim_page"].select("page_id", "url"), "page_id")
        .select("keyword", "url", "n_paginas_compitiendo")
    )


def ctr_below_benchmark(star: Star, min_impressions: int = 500) -> DataFrame:
    """Much-seen pairs of the newest snapshot clicked less often than their position leads to expect."""
    weak = (
        latest_global(star)
        .filter(F.col("impressions_30d") > min_impressions)
        .withColumn("ctr_benchmark_pct", ctr_benchmark(F.col("position")))
        .filter(F.col("ctr_30d") * 100 < F.col("ctr_benchmark_pct"))
    )
    return (
        _described(weak, star)
        .orderBy(F.desc("impressions_30d"), "keyword_id", "page_id")
        .select(
            "keyword",
            "url",
            "position",
            "impressions_30d",
            round_half_up(F.col("ctr_30d") * 100).alias("ctr_pct"),
            "ctr_benchmark_pct",
        )
    )


def ranking_without_backlinks(star: Star, lowest: int = 5, highest: int = 20) -> DataFrame:
    """Pairs of the newest snapshot in reach of the top whose page has no backlink."""
    linked = star["fact_backlink"].select("page_id").distinct()
    unlinked = star["dim_page"].join(linked, "page_id", "left_anti")
    fact = latest_global(star).filter(F.col("position").between(lowest, highest))
    keywords = star["dim_keyword"].select("keyword_id", "keyword", "keyword_difficulty", "monthly_search_volume")
    return (
        fact.join(unlinked.select("page_id", "url"), "page_id")
        .join(keywords, "keyword_id")
        .orderBy(F.desc("monthly_search_volume"), "keyword_id", "page_id")
        .select("keyword", "url", "position", "keyword_difficulty", F.lit(0).cast("bigint").alias("backlinks"))
    )


def clicks_trend(star: Star) -> DataFrame:
    """Clicks and impressions per domain and snapshot."""
    clicks, impressions = F.sum("clicks_30d"), F.sum("impressions_30d")
    pages = star["dim_page"].select("page_id", "site_id")
    per_site = (
        star["fact_keyword_position"]
        .join(pages, "page_id")
        .groupBy("site_id", "snapshot_date")
        .agg(clicks.alias("clicks_30d"), impressions.alias("impressions_30d"))
    )
    return (
        per_site.join(star["dim_site"].select("site_id", "domain"), "site_id")
        .groupBy("domain", "snapshot_date")
        .agg(
            clicks.alias("clicks_30d"),
            impressions.alias("impressions_30d"),
            round_half_up(ratio_or_zero(clicks, impressions, 100.0)).alias("ctr_pct"),
        )
        .orderBy("domain", "snapshot_date")
    )


def executive_report(star: Star) -> DataFrame:
    """The executive summary as a report."""
    return executive_summary(star)


def page_health(star: Star) -> DataFrame:
    """Health of each page in 0..100: half positions, 30 % speed, 20 % absence of active issues."""
    points = F.when(F.col("position") > 0, (F.lit(11) - F.least("position", F.lit(10))) * 10)
    per_keyword = (
        star["fact_keyword_position"]
        .groupBy("page_id", "keyword_id")
        .agg(F.sum(points).alias("_points"), F.count(points).alias("_ranked"))
    )
    ranking = (
        known_keyword(per_keyword, star)
        .groupBy("page_id")
        .agg(
            F.count("_known").alias("_keywords"),
            F.when(F.sum("_ranked") > 0, F.sum("_points") / F.sum("_ranked")).alias("_score"),
        )
    )
    issues = (
        star["fact_technical_issue"]
        .filter(is_active(F.col("status")) & F.col("page_id").isNotNull())
        .groupBy("page_id")
        .agg((F.count(F.lit(1)) * 20).alias("_penalty"))
    )
    penalty = F.least(F.coalesce("_penalty", F.lit(0)), F.lit(100))
    health = (
        F.col("_score") * F.lit(0.5)
        + F.coalesce("page_speed_score", F.lit(0)) * F.lit(0.3)
        + (F.lit(100) - penalty) * F.lit(0.2)
    )
    return (
        star["dim_page"]
        .select("page_id", "url", "page_speed_score")
        .join(ranking, "page_id", "left")
        .join(issues, "page_id", "left")
        .select(
            "page_id",
            "url",
            "page_speed_score",
            F.coalesce("_keywords", F.lit(0)).alias("keywords_posicionadas"),
            round_half_up(F.col("_score"), 1).alias("score_posiciones"),
            round_half_up(health, 1).alias("health_score"),
        )
        .orderBy(F.desc_nulls_last("health_score"), "page_id")
        .drop("page_id")
    )


def table_counts(star: Star, names: tuple[str, ...] | None = None) -> DataFrame:
    """Number of rows of each table."""
    names = names or (
        "dim_keyword",
        "dim_page",
        "fact_keyword_position",
        "fact_technical_issue",
        "etl_run_log",
    )
    counts = [
        star[n].agg(F.count(F.lit(1)).alias("filas")).select(F.lit(n).alias("tabla"), "filas")
        for n in names
        if n in star
    ]
    total, *rest = counts
    for one in rest:
        total = total.union(one)
    return total
