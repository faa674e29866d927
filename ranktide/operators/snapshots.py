"""Picking snapshots: newest of all, newest per pair, and the position before a snapshot.

The fact has one row per keyword, page and snapshot date, so everything grouped by a (keyword, page)
pair is bounded by the number of snapshots.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranktide.session import freeze

PAIR = ("keyword_id", "page_id")
UNRANKED_AS = 101


def last_snapshot(star: Mapping[str, DataFrame]) -> Column:
    """Newest snapshot date as a scalar subquery, so that it prunes date partitions at run time.

    A ``snapshot_calendar`` table, where there is one, spares a second pass over the fact.
    """
    dates = star["snapshot_calendar"] if "snapshot_calendar" in star else star["fact_keyword_position"]
    return dates.agg(F.max("snapshot_date").alias("last")).scalar()


def latest_global(star: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows of the newest snapshot date of all."""
    fact = star["fact_keyword_position"]
    return fact.filter(F.col("snapshot_date") == last_snapshot(star))


def latest_per_pair(fact: DataFrame) -> DataFrame:
    """Each pair's own newest row. Planned as a group limit on both sides of the shuffle."""
    newest_first = Window.partitionBy(*PAIR).orderBy(F.desc_nulls_last("snapshot_date"))
    return fact.withColumn("_age", F.row_number().over(newest_first)).filter("_age = 1").drop("_age")


def comparable(position: Column, zero_is_unranked: bool) -> Column:
    """Position as used in comparisons. Position 0 sorts as the best one unless asked otherwise."""
    return F.when(position == 0, F.lit(UNRANKED_AS)).otherwise(position) if zero_is_unranked else position


def _of_pairs(rows: DataFrame, some: DataFrame) -> DataFrame:
    """Rows of the pairs that ``some`` has. A batch's pairs are few beside all pairs, so that these are not shuffled."""
    return rows.join(some.select(*PAIR).distinct(), list(PAIR), "left_semi")


def newer_positions(latest: DataFrame, written: DataFrame) -> DataFrame:
    """What a run's rows change in the table of each pair's newest row."""
    known = _of_pairs(latest, written).select(*PAIR, F.col("snapshot_date").alias("_last"))
    newer = F.coalesce(F.col("_last") < F.col("snapshot_date"), F.lit(True))
    return latest_per_pair(written).join(known, list(PAIR), "left").filter(newer).select(*written.columns)


def split_by_latest(latest: DataFrame, staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged rows that are newer than all that is stored of their pair, and the others.

    The former can be stored by no earlier load; they come with the pair's last stored position as ``_before``. The batch
    is written once for both, so that neither runs what it is made of again.
    """
    newest = _of_pairs(latest, staged).select(
        *PAIR, F.col("snapshot_date").alias("_last"), F.col("position").alias("_before")
    )
    met = freeze(staged.join(newest, list(PAIR), "left"))
    ahead = F.coalesce(F.col("_last") < F.col("snapshot_date"), F.lit(True))
    return met.filter(ahead).drop("_last"), met.filter(~ahead).drop("_last", "_before")


def stage_against_latest(latest: DataFrame, stored: DataFrame, staged: DataFrame) -> DataFrame:
    """As ``stage_against_history``, by the table of each pair's newest row.

    History is read for back-dated rows only, and only up to the last of their dates: where there are none, the
    scan of ``stored`` prunes to nothing.
    """
    ahead, late = split_by_latest(latest, staged)
    until = late.agg(F.max("snapshot_date").alias("until")).scalar()
    found = stage_against_history(stored.filter(F.col("snapshot_date") <= until), late)
    return ahead.withColumnRenamed("_before", "previous_position").unionByName(found)


def stage_against_history(stored: DataFrame, staged: DataFrame) -> DataFrame:
    """Staged rows whose pair and date are not stored yet, with the pair's last stored position before
    that date in ``previous_position``.

    One window over stored and staged rows together does both: stored rows come first on equal dates,
    so a staged row that is already stored sees its own date just before it. ``staged`` must be unique
    by pair and date; staged rows do not see each other. Of the stored rows before the batch's first date only
    each pair's last one counts; they are reduced to it in every task before they are shuffled, so what is
    shuffled follows the batch and not the history.
    """
    payload = [c for c in staged.columns if c not in (*PAIR, "snapshot_date")]
    batch_pairs = staged.select(*PAIR).distinct()
    kept = stored.select(*PAIR, "snapshot_date", F.col("position").alias("_known"))
    first_day = staged.agg(F.min("snapshot_date").alias("first")).scalar()
    last_before = (
        kept.filter(F.col("snapshot_date") < first_day)
        .groupBy(*PAIR)
        .agg(F.max(F.struct("snapshot_date", "_known")).alias("_last"))
        .select(*PAIR, "_last.*")
    )
    since = kept.filter(F.col("snapshot_date") >= first_day)
    history = last_before.unionByName(since).join(batch_pairs, list(PAIR), "left_semi")
    both = history.withColumn("_new", F.lit(0)).unionByName(
        staged.select(*PAIR, "snapshot_date", F.struct(*payload).alias("_row")).withColumn("_new", F.lit(1)),
        allowMissingColumns=True,
    )
    before = (
        Window.partitionBy(*PAIR)
        .orderBy("snapshot_date", "_new")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    is_stored = F.col("_new") == 0
    seen = F.last(F.when(is_stored, F.struct("snapshot_date", "_known")), ignorenulls=True).over(before)
    return (
        both.withColumn("_seen", seen)
        .filter(~is_stored & F.coalesce(F.col("_seen.snapshot_date") < F.col("snapshot_date"), F.lit(True)))
        .select(
            *PAIR,
            "snapshot_date",
            *[F.col(f"_row.{c}").alias(c) for c in payload if c != "previous_position"],
            F.col("_seen._known").alias("previous_position"),
        )
    )
