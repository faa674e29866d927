"""The classification mart over the older star: one row per keyword and date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranktide.functions.numeric import round_half_up
from ranktide.operators.numbering import number_rows, rank_rows

# The three classes, and the growth expected on reaching the top.
QUICK_WIN = "🎯 QUICK WIN"
ALREADY_RANKED = "✅ YA POSICIONADO"
NEEDS_WORK = "⚠️ NECESITA TRABAJO"
CLASSES = (QUICK_WIN, ALREADY_RANKED, NEEDS_WORK)
GROWTH = 5

STAGED_COLUMNS = (
    "fact_id",
    "date_id",
    "keyword_id",
    "search_volume",
    "keyword_difficulty",
    "current_position",
    "estimated_ctr",
    "estimated_traffic",
)


def stage_performance(performance: DataFrame) -> DataFrame:
    """Staging view of the performance fact: its eight columns as they are."""
    return performance.select(*STAGED_COLUMNS)


def is_quick_win(max_difficulty: int = 50) -> Column:
    return F.col("current_position").between(4, 10) & (F.col("keyword_difficulty") < max_difficulty)


def classify(max_difficulty: int = 50) -> Column:
    return (
        F.when(is_quick_win(max_difficulty), QUICK_WIN)
        .when(F.col("current_position") <= 3, ALREADY_RANKED)
        .otherwise(NEEDS_WORK)
    )


def quick_wins_mart(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rank by traffic, number by position, class and expected gain per keyword and date.

    A date holds a large share of all rows, so neither ranking has a window per date: ranks come from the counts of
    distinct traffic values, numbers from counts per range. Equal positions are numbered by keyword.
    """
    keywords = tables["dim_keyword"].select("keyword_id", "keyword_text", "search_intent", "category")
    facts = stage_performance(tables["fact_keyword_performance"]).drop("fact_id")
    # Only rows with a keyword are ranked; its texts join last, so that they are not sorted along.
    ranked = rank_rows(
        facts.join(keywords.select("keyword_id"), "keyword_id", "left_semi"),
        "estimated_traffic",
        "traffic_rank",
        within=["date_id"],
    )
    ranked = number_rows(ranked, ["current_position", "keyword_id"], "position_rank", within=["date_id"])
    gain = F.col("estimated_traffic") * GROWTH - F.col("estimated_traffic")
    return ranked.join(keywords, "keyword_id").select(
        "keyword_id",
        "keyword_text",
        "search_intent",
        "category",
        "date_id",
        "current_position",
        "search_volume",
        "keyword_difficulty",
        "estimated_traffic",
        "estimated_ctr",
        "traffic_rank",
        "position_rank",
        classify().alias("classification"),
        round_half_up(gain.cast("double"), 0).alias("oportunidad_mejora"),
        F.when(is_quick_win(), gain).otherwise(F.lit(0)).alias("prioridad_score"),
    )


def unranked(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The mart's rows without the rankings, for checks that don't look at them."""
    keywords = tables["dim_keyword"].select("keyword_id", "keyword_text")
    gain = F.col("estimated_traffic") * GROWTH - F.col("estimated_traffic")
    return (
        stage_performance(tables["fact_keyword_performance"])
        .join(keywords, "keyword_id")
        .select(
            "keyword_id",
            "keyword_text",
            "date_id",
            classify().alias("classification"),
            round_half_up(gain.cast("double"), 0).alias("oportunidad_mejora"),
        )
    )


def build(tables: Mapping[str, DataFrame], target: str) -> DataFrame:
    """The mart as a table under ``target``, replacing an earlier one; the staging step is only a view.

    Returns the table read back. ``tables`` must not be read from ``target``.
    """
    stage_performance(tables["fact_keyword_performance"]).createOrReplaceTempView("stg_fact_keyword_performance")
    mart = quick_wins_mart(tables)
    mart.write.mode("overwrite").parquet(target)
    return mart.sparkSession.read.schema(mart.schema).parquet(target)


def class_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and total priority per class. The rankings play no part in it and are not computed."""
    keywords = tables["dim_keyword"].select("keyword_id")
    gain = F.col("estimated_traffic") * GROWTH - F.col("estimated_traffic")
    return (
        stage_performance(tables["fact_keyword_performance"])
        .join(keywords, "keyword_id")
        .groupBy(classify().alias("classification"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(is_quick_win(), gain).otherwise(F.lit(0))).alias("prioridad_total"),
        )
        .orderBy(F.desc("n"), "classification")
    )
