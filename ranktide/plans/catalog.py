"""All operators as queries over a folder of trade tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.operators import cleaning, loading, quality, rules
from ranktide.operators.numbering import number_rows
from ranktide.operators.snapshots import PAIR, stage_against_history
from ranktide.plans import analyses, loaded, mart, views
from ranktide.plans.batch import load_exports
from ranktide.session import application_folder, with_small_partitions
from ranktide.sources import trade
from ranktide.sources.legacy import copy_tables
from ranktide.sources.store import Store
from ranktide.sources.trade import FEED_ORDER, POSITION_ORDER, Trade

Query = Callable[[SparkSession, str], DataFrame]

RUN_DAY, LATE_RUN_DAY, AFTER_LAST_SNAPSHOT = "2024-01-15", "2002-01-31", "2002-01-05"


def _over_star(plan: Callable[..., DataFrame], **options: object) -> Query:
    return lambda spark, folder: plan(trade.star(spark, folder), **options)


def _over_performance(plan: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: plan(trade.performance(spark, folder))


def _scratch(spark: SparkSession) -> str:
    return application_folder(spark, "scratch")


def _clean(t: Trade) -> tuple[cleaning.Cleaned, cleaning.Cleaned, cleaning.Cleaned]:
    keywords = cleaning.clean_keywords(trade.raw_keywords(t), FEED_ORDER)
    pages = cleaning.clean_pages(trade.raw_pages(t), FEED_ORDER)
    positions = cleaning.clean_positions(trade.raw_positions(t), keywords.valid, pages.valid, POSITION_ORDER)
    return keywords, pages, positions


def contract_keywords(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.clean_keywords(trade.raw_keywords(Trade(spark, folder)), FEED_ORDER)
    return cleaned.valid.drop(*FEED_ORDER)


def contract_pages(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.clean_pages(trade.raw_pages(Trade(spark, folder)), FEED_ORDER)
    return cleaned.valid.drop(*FEED_ORDER)


def contract_positions(spark: SparkSession, folder: str) -> DataFrame:
    return _clean(Trade(spark, folder))[2].valid.drop(*POSITION_ORDER)


def quarantine_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows of all three exports, their reasons in one text."""
    rejected = [c.quarantine.withColumn("errors", F.concat_ws("; ", "errors")) for c in _clean(Trade(spark, folder))]
    return quality.union_all(rejected)


def _marked(t: Trade) -> DataFrame:
    keywords = cleaning.clean_keywords(trade.raw_keywords(t), FEED_ORDER).valid
    pages = cleaning.clean_pages(trade.raw_pages(t), FEED_ORDER).valid
    return cleaning.mark_orphans(cleaning.check_positions(trade.raw_positions(t)), keywords, pages)


def orphan_positions(spark: SparkSession, folder: str) -> DataFrame:
    orphans = _marked(Trade(spark, folder)).filter(F.get("errors", F.lit(0)).startswith("orphan"))
    return orphans.select("keyword", "url", "snapshot_date", F.concat_ws("; ", "errors").alias("errors"))


def dedupe_positions(spark: SparkSession, folder: str) -> DataFrame:
    """First valid row of each key, orphans included."""
    valid = cleaning.check_positions(trade.raw_positions(Trade(spark, folder))).filter(F.size("errors") == 0)
    first = cleaning.first_of_each(valid, cleaning.KEYS["positions"], POSITION_ORDER)
    return first.select("keyword", "url", "snapshot_date", "position", "clicks_30d", "impressions_30d")


def batch_load(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run: the raw exports as CSV, loaded into a new store; its tables are counted."""
    where = _scratch(spark)
    loaded.write_exports(spark, folder, where)
    store = Store(spark, f"{where}/store")
    load_exports(store, where, LATE_RUN_DAY, "batch-1")
    return analyses.table_counts(store.tables())


def copy_trade_tables(spark: SparkSession, folder: str) -> DataFrame:
    return copy_tables(spark, folder, _scratch(spark), [f"{name}.parquet" for name in trade.TABLES])


def upsert_keywords(spark: SparkSession, folder: str) -> DataFrame:
    t = Trade(spark, folder)
    batch = cleaning.staged_keywords(trade.staging_keywords(t), ["src_key"])
    return loading.upsert_keywords(trade.stored_keywords(t), batch)


def _upsert_pages(mode: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = Trade(spark, folder)
        batch = cleaning.staged_pages(trade.staging_pages(t), FEED_ORDER)
        return loading.upsert_pages(trade.pages(t), batch, trade.sites(t), LATE_RUN_DAY, mode)

    return query


def asof_previous_position(spark: SparkSession, folder: str) -> DataFrame:
    t = Trade(spark, folder)
    batch = cleaning.staged_positions(trade.staging_positions(t), POSITION_ORDER)
    resolved = loading.resolve_names(batch, trade.keywords(t), trade.pages(t))
    return stage_against_history(
        trade.stored_positions(t), resolved.select(*PAIR, "snapshot_date", "position")
    )


def insert_positions(spark: SparkSession, folder: str) -> DataFrame:
    t = Trade(spark, folder)
    batch = cleaning.staged_positions(trade.staging_positions(t), POSITION_ORDER)
    return loading.new_positions(trade.stored_positions(t), batch, trade.keywords(t), trade.pages(t))


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers for all fact rows by date, keyword and page."""
    keys = trade.positions(Trade(spark, folder)).select("snapshot_date", "keyword_id", "page_id")
    return number_rows(keys, ["snapshot_date", "keyword_id", "page_id"], "row_id")


def constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    """Every row is counted under several keys, most of which are its own, so that tasks should have few rows."""
    return quality.constraint_checks(trade.star(with_small_partitions(spark), folder))


def rule_noindex(spark: SparkSession, folder: str) -> DataFrame:
    s = trade.star(spark, folder)
    ranking = rules.ranked_pages(s["fact_keyword_position"])
    return rules.noindex_issues(s["dim_page"], ranking, s["fact_technical_issue"], LATE_RUN_DAY)


def _rule_decay(suppress: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        s = trade.star(spark, folder)
        return rules.decay_issues(
            s["dim_page"], s["fact_keyword_position"], s["fact_technical_issue"], RUN_DAY, suppress=suppress
        )

    return query


QUERIES: dict[str, Query] = {
    # views
    "quick_wins": _over_star(views.quick_wins),
    "position_changes": _over_star(views.position_changes),
    "category_summary": _over_star(views.category_summary),
    "indexation_health": _over_star(views.indexation_health),
    "backlink_gaps": _over_star(views.backlink_gaps),
    "executive_summary": _over_star(views.executive_summary),
    # analyses
    "quick_wins_top10": _over_star(analyses.quick_wins_top),
    "p1_backlog": _over_star(analyses.priority_backlog),
    "almost_winning": _over_star(analyses.almost_winning),
    "decay": _over_star(analyses.decay),
    "issue_impact": _over_star(analyses.issue_impact),
    "noindex_impressions": _over_star(analyses.noindex_impressions),
    "cannibalization": _over_star(analyses.cannibalization),
    "ctr_below_benchmark": _over_star(analyses.ctr_below_benchmark),
    "ranking_without_backlinks": _over_star(analyses.ranking_without_backlinks),
    "clicks_trend": _over_star(analyses.clicks_trend),
    "executive_report": _over_star(analyses.executive_report),
    "page_health": _over_star(analyses.page_health),
    "table_counts": _over_star(analyses.table_counts),
    # mart
    "stage_performance": _over_performance(lambda p: mart.stage_performance(p["fact_keyword_performance"])),
    "mart_quick_wins": _over_performance(mart.quick_wins_mart),
    "mart_class_summary": _over_performance(mart.class_summary),
    # sources
    "copy_tables": copy_trade_tables,
    # cleaning
    "contract_keywords": contract_keywords,
    "contract_pages": contract_pages,
    "contract_positions": contract_positions,
    "quarantine_report": quarantine_report,
    "orphan_positions": orphan_positions,
    "dedupe_positions": dedupe_positions,
    # loading
    "upsert_keywords": upsert_keywords,
    "upsert_pages": _upsert_pages("coalesce"),
    "upsert_pages_overwrite": _upsert_pages("overwrite"),
    "asof_previous_position": asof_previous_position,
    "insert_positions": insert_positions,
    "surrogate_keys": surrogate_keys,
    "rule_noindex": rule_noindex,
    "rule_decay": _rule_decay("open"),
    "rule_decay_today": _rule_decay("today"),
    "batch_load": batch_load,
    # quality and monitoring
    "quality_report": _over_star(quality.load_checks),
    "constraint_report": constraint_report,
    "mart_report": _over_performance(lambda p: quality.mart_checks(mart.unranked(p))),
    "freshness": _over_star(quality.freshness, run_date=AFTER_LAST_SNAPSHOT),
    "run_alerts": _over_star(lambda s: quality.run_alerts(s["etl_run_log"])),
    "active_tier_limit": _over_star(lambda s: quality.active_tier_limit(views.quick_wins(s))),
    "drop_alerts": _over_star(lambda s: quality.drop_alerts(views.position_changes(s))),
    # whole loads
    **loaded.QUERIES,
}
