"""Upserts of the star schema. Each operator takes the stored table and a clean batch and returns what
is to be written: new rows for tables that only grow, a new version of the page dimension.

Loading the same batch again yields nothing new.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranktide.functions.text import keyword_key, url_host, url_key
from ranktide.operators.cleaning import click_rate
from ranktide.operators.numbering import with_ids
from ranktide.operators.snapshots import PAIR, split_by_latest, stage_against_history, stage_against_latest
from ranktide.schemas import DEFAULT_SITES, DIM_KEYWORD, DIM_PAGE, DIM_SITE, FACT_BACKLINK, FACT_POSITION
from ranktide.session import forget_shuffles, freeze

DEFAULT_SITE_ID = 1


def seed_sites(stored: DataFrame, sites: Sequence[tuple] = DEFAULT_SITES) -> DataFrame:
    """The default sites when there is no site yet, else nothing."""
    seeds = stored.sparkSession.createDataFrame(list(sites), DIM_SITE.struct)
    present = stored.agg(F.count(F.lit(1)).alias("n")).scalar()
    return seeds.filter(present == 0)


def new_keywords(
    stored: DataFrame, batch: DataFrame, order_by: Sequence[str] | None = None, greatest: int | None = None
) -> DataFrame:
    """Keywords of the batch that are not stored, with ids. Stored keywords never change.

    ``batch`` is unique by its normalised ``keyword``; ``order_by`` gives the order of the ids, the
    keyword itself by default.
    """
    known = stored.select(keyword_key(F.col("keyword")).alias("keyword"))
    fresh = batch.join(known, "keyword", "left_anti")
    numbered = with_ids(fresh, stored, "keyword_id", order_by or ["keyword"], greatest)
    return numbered.withColumn("current_url_target", F.lit(None).cast("string")).select(*DIM_KEYWORD.names)


def upsert_keywords(stored: DataFrame, batch: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """The keyword dimension after the batch."""
    return stored.select(*DIM_KEYWORD.names).unionByName(new_keywords(stored, batch, order_by))


def site_of(pages: DataFrame, sites: DataFrame, default_site: int = DEFAULT_SITE_ID) -> DataFrame:
    """Adds ``site_id`` by the host of the URL or the longest domain that the host is part of.

    ``www.shop.example`` belongs to ``shop.example`` unless there is a site of its own. ``default_site`` when no site
    has any of the host's domains. ``pages`` is unique by ``url``.
    """
    domains = sites.select(F.lower("domain").alias("_domain"), F.col("site_id").alias("_site"))
    # Each distinct host with its dotted suffixes, a handful, by which the domains are looked up.
    hosts = pages.select(url_host(F.col("url")).alias("_host")).distinct()
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = hosts.select("_host", F.explode(suffixes).alias("_domain")).join(domains, "_domain")
    found = found.groupBy("_host").agg(F.max_by("_site", F.length("_domain")).alias("_site"))
    return (
        pages.join(found, url_host(F.col("url")) == F.col("_host"), "left")
        .withColumn("site_id", F.coalesce("_site", F.lit(default_site).cast("bigint")))
        .drop("_host", "_site")
    )


def new_pages(
    stored: DataFrame,
    batch: DataFrame,
    sites: DataFrame,
    run_date: str,
    order_by: Sequence[str] | None = None,
    default_site: int = DEFAULT_SITE_ID,
    greatest: int | None = None,
) -> DataFrame:
    """Pages of the batch that are not stored, with site and id. ``batch`` is unique by ``url``."""
    fresh = site_of(batch.join(stored.select("url"), "url", "left_anti"), sites, default_site)
    numbered = with_ids(fresh, stored, "page_id", order_by or ["url"], greatest)
    return (
        numbered.withColumn("meta_description", F.lit(None).cast("string"))
        .withColumn("word_count", F.coalesce("word_count", F.lit(0)))
        .withColumn("indexable", F.coalesce("indexable", F.lit(1)))
        .withColumn("last_crawled_at", _crawl_day(batch, run_date))
        .select(*DIM_PAGE.names)
    )


def _crawl_day(batch: DataFrame, run_date: str) -> Column:
    """Day part of ``loaded_at`` where the batch has one, else the run date."""
    day = F.substring("loaded_at", 1, 10) if "loaded_at" in batch.columns else F.lit(None)
    return F.coalesce(day, F.lit(run_date))


def _met_pages(
    stored: DataFrame, batch: DataFrame, mode: str, how: str
) -> tuple[DataFrame, list[str], Callable[[str], Column]]:
    """Stored pages beside the batch's, the columns that can change, and what becomes of a column."""
    if mode not in ("coalesce", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    taken = ["title", "h1", "word_count", "indexable", "page_speed_score"]
    if mode == "coalesce" and "loaded_at" in batch.columns:
        batch = batch.withColumn("last_crawled_at", F.substring("loaded_at", 1, 10))
        taken.append("last_crawled_at")
    fresh = batch.select("url", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in taken])

    def value(column: str) -> Column:
        if column not in taken:
            return F.col(column)
        if mode == "overwrite":
            return F.when(F.col("_hit"), F.col(f"_{column}")).otherwise(F.col(column)).alias(column)
        return F.coalesce(f"_{column}", column).alias(column)

    return stored.join(fresh, "url", how), taken, value


def updated_pages(stored: DataFrame, batch: DataFrame, mode: str = "coalesce") -> DataFrame:
    """Stored pages with the batch's values. ``overwrite`` takes them as they are and leaves the crawl
    day; ``coalesce`` keeps the stored value where the batch has none. Id, site, URL and description
    never change."""
    met, _, value = _met_pages(stored, batch, mode, "left")
    return met.select(*[value(c) for c in DIM_PAGE.names])


def changed_pages(stored: DataFrame, batch: DataFrame, mode: str = "coalesce") -> DataFrame:
    """Those of them in which the batch changes a value, and no others."""
    asked = stored.join(batch.select("url"), "url", "left_semi")
    met, taken, value = _met_pages(asked, batch, mode, "inner")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(value(c)) for c in taken])
    return met.filter(differs).select(*[value(c) for c in DIM_PAGE.names])


def upsert_pages(
    stored: DataFrame,
    batch: DataFrame,
    sites: DataFrame,
    run_date: str,
    mode: str = "coalesce",
    order_by: Sequence[str] | None = None,
    default_site: int = DEFAULT_SITE_ID,
) -> DataFrame:
    """The page dimension after the batch: known pages updated, new ones added."""
    added = new_pages(stored, batch, sites, run_date, order_by, default_site)
    return updated_pages(stored, batch, mode).unionByName(added)


def new_backlinks(
    stored: DataFrame, batch: DataFrame, pages: DataFrame, greatest: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Backlinks of the batch that are not stored, with ids, and in report form those of unknown pages."""
    known = batch.withColumn("url", url_key(F.col("url"))).withColumn("referring_domain", keyword_key(F.col("referring_domain")))
    resolved = known.join(pages.select("page_id", "url"), "url", "left")
    key = ["page_id", "referring_domain"]
    fresh = resolved.filter("page_id IS NOT NULL").dropDuplicates(key).join(stored.select(*key), key, "left_anti")
    unknown = resolved.filter("page_id IS NULL").select(
        F.lit("backlinks").alias("entity"),
        F.concat_ws(" @ ", "referring_domain", "url").alias("key"),
        F.array(F.concat(F.lit("orphan, unknown URL: "), F.coalesce("url", F.lit("")))).alias("errors"),
    )
    numbered = with_ids(fresh, stored, "backlink_id", ["url", "referring_domain"], greatest)
    return numbered.select(*FACT_BACKLINK.names), unknown


def resolve_names(batch: DataFrame, keywords: DataFrame, pages: DataFrame) -> DataFrame:
    """Names to ids; rows whose keyword or URL is in no dimension drop out."""
    by_keyword = keywords.select("keyword_id", keyword_key(F.col("keyword")).alias("keyword"))
    return batch.join(by_keyword, "keyword").join(pages.select("page_id", "url"), "url")


def new_positions(
    stored: DataFrame,
    batch: DataFrame,
    keywords: DataFrame,
    pages: DataFrame,
    previous: str = "history",
    order_by: Sequence[str] | None = None,
    latest: DataFrame | None = None,
    greatest: int | None = None,
) -> DataFrame:
    """Positions of the batch that are not stored, with ids.

    ``batch`` is unique by keyword, URL and date. ``previous`` says where the previous position comes
    from: ``history`` looks up the pair's last stored position before the date and sets the traffic
    figures to none, as the staging path does; ``export`` takes both from the batch. With ``latest``, each pair's
    newest stored row, history is read only for rows that are not newer.
    """
    # Written once, without what is neither stored nor ordered by: the steps below read it several times.
    order = order_by or ["keyword", "url", "snapshot_date"]
    figures = {"history": (), "export": ("previous_position", "clicks_30d", "impressions_30d")}
    if previous not in figures:
        raise ValueError(f"unknown source of the previous position {previous!r}")
    kept = dict.fromkeys([*PAIR, "snapshot_date", "position", *figures[previous], *order])
    resolved = freeze(resolve_names(batch, keywords, pages).select(*kept))
    forget_shuffles(stored.sparkSession)  # those behind the batch, which no step below asks for again
    if previous == "history":
        staged = resolved
        found = stage_against_history(stored, staged) if latest is None else stage_against_latest(latest, stored, staged)
        none = F.lit(0).cast("bigint")
        fresh = found.withColumns({"clicks_30d": none, "impressions_30d": none})
    else:
        ahead, late = (None, resolved) if latest is None else split_by_latest(latest, resolved)
        # Only stored rows of these rows' dates matter; by the bounds, and by the semi join, the scan skips other dates' folders.
        first, last = (late.agg(f("snapshot_date").alias("day")).scalar() for f in (F.min, F.max))
        same_days = stored.select(*PAIR, "snapshot_date").filter(F.col("snapshot_date").between(first, last))
        # A row per day of the batch, so that the stored rows are not shuffled by their few dates.
        same_days = same_days.join(F.broadcast(late.select("snapshot_date").distinct()), "snapshot_date", "left_semi")
        fresh = late.join(same_days, [*PAIR, "snapshot_date"], "left_anti")
        fresh = fresh if ahead is None else ahead.drop("_before").unionByName(fresh)
    rate = click_rate(F.col("clicks_30d"), F.col("impressions_30d"))
    numbered = with_ids(fresh.withColumn("ctr_30d", rate), stored, "position_id", order, greatest)
    return numbered.select(*FACT_POSITION.names)
