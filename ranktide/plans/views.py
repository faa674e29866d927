"""The six semantic views over the star schema.

Facts are reduced before they meet a second grouping level: distinct counts become plain counts over
rows already grouped by the counted key, so no key's rows are gathered in one task. Joins carry no
hints: Spark broadcasts a dimension only when its size is known to be under the threshold, and splits
hot keys of the others at run time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.functions.numeric import ratio_or_zero, round_half_up, zero_as_null
from ranktide.functions.scoring import ice
from ranktide.operators.snapshots import comparable, latest_global, latest_per_pair
from ranktide.schemas import ACTIVE_STATUSES

Star = Mapping[str, DataFrame]


def is_active(status: Column) -> Column:
    return status.isin(*ACTIVE_STATUSES)


def page_domains(star: Star) -> DataFrame:
    """Page id with the domain of its site."""
    pages = star["dim_page"].select("page_id", "site_id", "url")
    return pages.join(star["dim_site"].select("site_id", "domain"), "site_id")


def active_issues_by(star: Star, key: str) -> DataFrame:
    """Number of active issues and traffic at risk per page or per site."""
    return (
        star["fact_technical_issue"]
        .filter(is_active(F.col("status")) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("open_issues"), F.sum("traffic_at_risk").alias("traffic_at_risk"))
    )


def known_keyword(grouped: DataFrame, star: Star) -> DataFrame:
    """Adds ``_known``: the keyword id where the dimension has it, else NULL."""
    ids = star["dim_keyword"].select("keyword_id", F.col("keyword_id").alias("_known"))
    return grouped.join(ids, "keyword_id", "left")


def mean(total: str, count: str) -> Column:
    return F.when(F.sum(count) > 0, F.sum(total) / F.sum(count))


def quick_wins(star: Star, lowest: int = 4, highest: int = 30) -> DataFrame:
    """Opportunities by ICE: each pair's newest row, kept when it stands at ``lowest``..``highest``."""
    newest = star["latest_position"] if "latest_position" in star else latest_per_pair(star["fact_keyword_position"])
    fact = newest.filter(F.col("position").between(lowest, highest))
    keywords = star["dim_keyword"].select(
        "keyword_id", "keyword", "category", "monthly_search_volume", "keyword_difficulty"
    )
    score = ice(F.col("monthly_search_volume"), F.col("keyword_difficulty"), F.col("position"))
    return (
        fact.join(keywords, "keyword_id")
        .join(page_domains(star), "page_id")
        .select(
            "keyword_id",
            "keyword",
            "category",
            "page_id",
            "url",
            "domain",
            "snapshot_date",
            "position",
            "previous_position",
            (F.col("previous_position") - F.col("position")).alias("position_delta"),
            "monthly_search_volume",
            "keyword_difficulty",
            "clicks_30d",
            "impressions_30d",
            round_half_up(score.impact).alias("impact_score"),
            round_half_up(score.confidence).alias("confidence_score"),
            round_half_up(score.ease).alias("ease_score"),
            round_half_up(score.score).alias("ice_score"),
            score.tier.alias("priority_tier"),
        )
    )


def position_changes(star: Star, zero_is_unranked: bool = False, ordered: bool = False) -> DataFrame:
    """Every snapshot with its movement; a positive delta is a gain."""
    now = comparable(F.col("position"), zero_is_unranked)
    before = comparable(F.col("previous_position"), zero_is_unranked)
    moved = (
        star["fact_keyword_position"]
        .join(star["dim_keyword"].select("keyword_id", "keyword", "category"), "keyword_id")
        .join(page_domains(star), "page_id")
        .select(
            "domain",
            "keyword",
            "category",
            "url",
            "snapshot_date",
            "position",
            "previous_position",
            (before - now).alias("position_delta"),
            F.when(F.col("previous_position").isNull(), "new")
            .when(now < before, "improved")
            .when(now > before, "declined")
            .otherwise("stable")
            .alias("trend"),
            "clicks_30d",
            "impressions_30d",
        )
    )
    if not ordered:
        return moved
    return moved.orderBy(F.desc("snapshot_date"), F.asc_nulls_first("position_delta"), "keyword", "url")


def category_summary(star: Star) -> DataFrame:
    """Keywords, mean position and traffic per domain and category at the newest snapshot."""
    ranked = zero_as_null(F.col("position"))
    per_keyword = (
        latest_global(star)
        .join(page_domains(star).select("page_id", "domain"), "page_id")
        .groupBy("domain", "keyword_id")
        .agg(
            F.sum(ranked).alias("_positions"),
            F.count(ranked).alias("_ranked"),
            F.sum("clicks_30d").alias("_clicks"),
            F.sum("impressions_30d").alias("_impressions"),
        )
    )
    clicks, impressions = F.sum("_clicks"), F.sum("_impressions")
    return (
        per_keyword.join(star["dim_keyword"].select("keyword_id", "category"), "keyword_id")
        .groupBy("domain", "category")
        .agg(
            F.count(F.lit(1)).alias("n_keywords"),
            round_half_up(mean("_positions", "_ranked")).alias("avg_position"),
            clicks.alias("total_clicks_30d"),
            impressions.alias("total_impressions_30d"),
            round_half_up(ratio_or_zero(clicks, impressions), 4).alias("avg_ctr"),
        )
    )


def indexation_health(star: Star) -> DataFrame:
    """Active issues and traffic at risk per page; pages without issues stay with zeros."""
    pages = star["dim_page"].select("page_id", "site_id", "url", "indexable", "page_speed_score")
    return (
        pages.join(star["dim_site"].select("site_id", "domain"), "site_id")
        .join(active_issues_by(star, "page_id"), "page_id", "left")
        .select(
            "domain",
            "page_id",
            "url",
            "indexable",
            "page_speed_score",
            F.coalesce("open_issues", F.lit(0)).alias("open_issues"),
            F.coalesce("traffic_at_risk", F.lit(0)).alias("traffic_at_risk"),
        )
    )


def backlink_gaps(star: Star) -> DataFrame:
    """Ranking keywords against referring domains, for pages with at least one ranking keyword.

    Facts and backlinks are reduced per page on their own and joined after: within a page every fact
    row would meet every backlink equally often, so means and distinct counts are the same.
    """
    per_keyword = (
        star["fact_keyword_position"]
        .filter("position > 0")
        .groupBy("page_id", "keyword_id")
        .agg(F.sum("position").alias("_positions"), F.count(F.lit(1)).alias("_ranked"))
    )
    ranking = (
        known_keyword(per_keyword, star)
        .groupBy("page_id")
        .agg(
            F.count("_known").alias("n_keywords_ranking"),
            round_half_up(mean("_positions", "_ranked")).alias("avg_position"),
        )
        .filter("n_keywords_ranking > 0")
    )
    per_domain = (
        star["fact_backlink"]
        .groupBy("page_id", "referring_domain")
        .agg(F.sum("domain_authority").alias("_authority"), F.count("domain_authority").alias("_rated"))
    )
    links = per_domain.groupBy("page_id").agg(
        F.count("referring_domain").alias("n_referring_domains"),
        round_half_up(mean("_authority", "_rated"), 1).alias("avg_domain_authority"),
    )
    return (
        page_domains(star)
        .join(ranking, "page_id")
        .join(links, "page_id", "left")
        .select(
            "page_id",
            "domain",
            "url",
            "n_keywords_ranking",
            F.coalesce("n_referring_domains", F.lit(0)).alias("n_referring_domains"),
            "avg_position",
            F.coalesce("avg_domain_authority", F.lit(0.0)).alias("avg_domain_authority"),
        )
    )


def executive_summary(star: Star) -> DataFrame:
    """One row per site. Traffic and top-3/top-10 figures are totals over all snapshots."""
    position = F.col("position")
    pages = star["dim_page"].select("page_id", "site_id")
    per_keyword = (
        star["fact_keyword_position"]
        .join(pages, "page_id")
        .groupBy("site_id", "keyword_id")
        .agg(
            F.count_if(position.between(1, 3)).alias("_top3"),
            F.count_if(position.between(4, 10)).alias("_top10"),
            F.sum("clicks_30d").alias("_clicks"),
            F.sum("impressions_30d").alias("_impressions"),
        )
    )
    traffic = (
        known_keyword(per_keyword, star)
        .groupBy("site_id")
        .agg(
            F.count("_known").alias("n_keywords"),
            F.sum("_top3").alias("keywords_top3"),
            F.sum("_top10").alias("keywords_top10"),
            F.sum("_clicks").alias("total_clicks_30d"),
            F.sum("_impressions").alias("total_impressions_30d"),
        )
    )
    page_counts = pages.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_pages"))
    counted = ("n_pages", "n_keywords", "keywords_top3", "keywords_top10")
    summed = ("total_clicks_30d", "total_impressions_30d")
    return (
        star["dim_site"]
        .select("site_id", "domain")
        .join(page_counts, "site_id", "left")
        .join(traffic, "site_id", "left")
        .join(active_issues_by(star, "site_id"), "site_id", "left")
        .select(
            "domain",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counted],
            *summed,
            F.coalesce("open_issues", F.lit(0)).alias("open_issues"),
            F.coalesce("traffic_at_risk", F.lit(0)).alias("traffic_at_risk"),
        )
    )


# Names under which the views can be queried with SQL.
VIEWS = {
    "vw_quick_wins_priority": quick_wins,
    "vw_position_changes": position_changes,
    "vw_category_summary": category_summary,
    "vw_indexation_health": indexation_health,
    "vw_backlink_gaps": backlink_gaps,
    "vw_executive_summary": executive_summary,
}


def register(spark: SparkSession, star: Star) -> list[str]:
    """Makes tables and views available to ``spark.sql`` as temporary views; returns their names."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)
    return [*star, *VIEWS]
