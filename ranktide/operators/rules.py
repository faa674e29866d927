"""Issues that follow from the data by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranktide.operators.numbering import with_ids
from ranktide.operators.snapshots import comparable
from ranktide.schemas import ACTIVE_STATUSES, FACT_ISSUE

NOINDEX, CONTENT_DECAY = "noindex", "content_decay"
MIN_DROP = 5


def _open_issue(issue_type: str, severity: Column, run_date: str) -> dict[str, Column]:
    return {
        "issue_type": F.lit(issue_type),
        "severity": severity,
        "traffic_at_risk": F.lit(0).cast("bigint"),
        "detected_at": F.lit(run_date),
        "resolved_at": F.lit(None).cast("string"),
        "status": F.lit("open"),
    }


def ranked_pages(fact: DataFrame) -> DataFrame:
    """Pages that rank in some snapshot."""
    return fact.filter("position > 0").select("page_id").distinct()


def fallen_positions(fact: DataFrame, min_drop: int = MIN_DROP) -> DataFrame:
    """All rows in which the content rule can find something, as long as it asks for no smaller drop."""
    return fact.filter((F.col("position") > 0) & (F.col("position") - F.col("previous_position") >= min_drop))


def noindex_candidates(pages: DataFrame, ranking: DataFrame, issues: DataFrame) -> DataFrame:
    """Pages closed to indexing that are among the ``ranking`` ones and have no active ``noindex`` issue."""
    reported = issues.filter(
        (F.col("issue_type") == NOINDEX) & F.col("status").isin(*ACTIVE_STATUSES)
    ).select("page_id")
    return (
        pages.filter("indexable = 0")
        .select("page_id", "site_id")
        .join(ranking, "page_id", "left_semi")
        .join(reported, "page_id", "left_anti")
    )


def noindex_issues(
    pages: DataFrame, ranking: DataFrame, issues: DataFrame, run_date: str, greatest: int | None = None
) -> DataFrame:
    """A critical issue for each such page."""
    found = noindex_candidates(pages, ranking, issues)
    numbered = with_ids(found, issues, "issue_id", ["page_id"], greatest)
    return numbered.withColumns(_open_issue(NOINDEX, F.lit("critical"), run_date)).select(*FACT_ISSUE.names)


def decay_candidates(
    pages: DataFrame,
    fact: DataFrame,
    issues: DataFrame,
    run_date: str,
    suppress: str = "open",
    min_drop: int = MIN_DROP,
    severe_drop: int = 8,
    latest_only: bool = False,
    zero_is_unranked: bool = False,
) -> DataFrame:
    """Snapshots in which a ranking pair lost ``min_drop`` positions or more, one row each.

    A page already reported is left out: with an active issue (``open``) or one detected on the run
    date (``today``). All snapshots are searched unless ``latest_only``.
    """
    if suppress == "open":
        silences = F.col("status").isin(*ACTIVE_STATUSES)
    elif suppress == "today":
        silences = F.col("detected_at") == run_date
    else:
        raise ValueError(f"unknown suppression {suppress!r}")
    reported = issues.filter((F.col("issue_type") == CONTENT_DECAY) & silences).select("page_id")
    drop = comparable(F.col("position"), zero_is_unranked) - comparable(F.col("previous_position"), zero_is_unranked)
    fallen = fact.filter((F.col("position") > 0) & (drop >= min_drop))
    if latest_only:
        newest = fact.agg(F.max("snapshot_date").alias("last")).scalar()
        fallen = fallen.filter(F.col("snapshot_date") == newest)
    severity = F.when(drop >= severe_drop, "high").otherwise("medium")
    return (
        fallen.select("page_id", "keyword_id", "snapshot_date", severity.alias("severity"))
        .join(reported, "page_id", "left_anti")
        .join(pages.select("page_id", "site_id"), "page_id")
    )


def decay_issues(
    pages: DataFrame, fact: DataFrame, issues: DataFrame, run_date: str, greatest: int | None = None, **options: object
) -> DataFrame:
    """A content issue for each such snapshot.

    ``fact`` may be the fallen positions only.
    """
    found = decay_candidates(pages, fact, issues, run_date, **options)
    numbered = with_ids(found, issues, "issue_id", ["page_id", "keyword_id", "snapshot_date"], greatest)
    return numbered.withColumns(_open_issue(CONTENT_DECAY, F.col("severity"), run_date)).select(*FACT_ISSUE.names)
