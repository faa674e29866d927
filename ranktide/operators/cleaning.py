"""Contracts on the raw exports. Per row: normalise, validate, then the first valid row of a key wins.

Rejected rows go to quarantine with all their reasons and never stop a run; further copies of a valid
key vanish without being an error. Everything is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranktide.functions.text import is_blank, is_day, keyword_key, parse_int, strip, url_key
from ranktide.schemas import (
    CATEGORIES,
    DEFAULT_CATEGORY,
    DEFAULT_DIFFICULTY,
    DEFAULT_INTENT,
    SOURCE_ORDER,
)

# Normalised text at the head of each checked row, and the natural keys.
KEYS = {"keywords": ("keyword",), "pages": ("url",), "positions": ("keyword", "url", "snapshot_date")}


@dataclass(frozen=True)
class Cleaned:
    """The valid rows of an export and the rejected ones (``entity``, ``key``, ``errors``)."""

    valid: DataFrame
    quarantine: DataFrame


def reasons(*tests: tuple[Column, Column]) -> Column:
    """The messages of all tests that hold, in order. Good rows skip the messages."""
    any_failed = reduce(or_, [F.coalesce(failed, F.lit(False)) for failed, _ in tests])
    none = F.array().cast("array<string>")
    # Flattened and not filtered, as a lambda would keep the whole check out of generated code.
    messages = F.flatten(F.array(*[F.when(failed, F.array(message)).otherwise(none) for failed, message in tests]))
    return F.when(any_failed, messages).otherwise(none)


def _empty(column: str) -> Column:
    return F.coalesce(F.col(column) == "", F.lit(True))


def _with_value(text: str, value: Column) -> Column:
    return F.concat(F.lit(f"{text}: "), F.coalesce(value.cast("string"), F.lit("")))


def _number(column: str, default: int | None, if_missing: int | None = None, type_name: str = "int") -> Column:
    """Parsed number; ``default`` for an empty field and ``if_missing`` where the file has no such column."""
    missing = F.lit(default if if_missing is None else if_missing).cast(type_name)
    raw = F.col(column)
    return (
        F.when(raw.isNull(), missing)
        .when(raw == "", F.lit(default).cast(type_name))
        .otherwise(parse_int(raw, type_name))
    )


def _malformed(column: str) -> tuple[Column, Column]:
    """Text that is there but gave no number; it has been parsed already."""
    raw = F.col(f"_raw_{column}")
    there = F.coalesce(raw, F.lit("")) != ""
    return there & F.col(column).isNull(), _with_value(f"malformed number in {column}", raw)


def _parsed(raw: DataFrame, values: dict[str, Column], numbers: Sequence[str]) -> DataFrame:
    """``raw`` with parsed columns, the text of the numbers kept as ``_raw_…`` for the messages."""
    others = [c for c in raw.columns if c not in values]
    return raw.select(
        *[v.alias(c) for c, v in values.items()], *[F.col(c).alias(f"_raw_{c}") for c in numbers], *others
    )


def check_keywords(raw: DataFrame) -> DataFrame:
    """Normalised keywords with the list of broken rules in ``errors``."""
    parsed = _parsed(
        raw,
        {
            "keyword": keyword_key(F.col("keyword")),
            "category": strip(F.coalesce("category", F.lit(DEFAULT_CATEGORY))),
            "search_intent": strip(F.coalesce("search_intent", F.lit(DEFAULT_INTENT))),
            "monthly_search_volume": _number("monthly_search_volume", 0, type_name="bigint"),
            "keyword_difficulty": _number("keyword_difficulty", DEFAULT_DIFFICULTY),
        },
        ("monthly_search_volume", "keyword_difficulty"),
    )
    volume, difficulty, category = F.col("monthly_search_volume"), F.col("keyword_difficulty"), F.col("category")
    return parsed.withColumn(
        "errors",
        reasons(
            (_empty("keyword"), F.lit("blank keyword")),
            _malformed("monthly_search_volume"),
            (volume < 0, _with_value("negative volume", volume)),
            _malformed("keyword_difficulty"),
            (~difficulty.between(0, 100), _with_value("difficulty out of range", difficulty)),
            (~category.isin(*CATEGORIES), _with_value("unknown category", category)),
        ),
    ).drop("_raw_monthly_search_volume", "_raw_keyword_difficulty")


def check_pages(raw: DataFrame) -> DataFrame:
    """Normalised pages with the list of broken rules in ``errors``.

    An absent ``indexable`` column means indexable, an empty field means not.
    """
    parsed = _parsed(
        raw,
        {
            "url": url_key(F.col("url")),
            "word_count": _number("word_count", 0),
            "indexable": _number("indexable", 0, if_missing=1),
            "page_speed_score": _number("page_speed_score", None),
        },
        ("word_count", "indexable", "page_speed_score"),
    )
    url, words, speed = F.col("url"), F.col("word_count"), F.col("page_speed_score")
    absolute = F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))
    return parsed.withColumn(
        "errors",
        reasons(
            (~absolute, _with_value("invalid URL", url)),
            _malformed("word_count"),
            (words < 0, _with_value("negative word count", words)),
            _malformed("indexable"),
            _malformed("page_speed_score"),
            (~speed.between(0, 100), _with_value("page speed out of range", speed)),
        ),
    ).drop("_raw_word_count", "_raw_indexable", "_raw_page_speed_score")


def check_positions(raw: DataFrame, any_date: bool = False) -> DataFrame:
    """Normalised positions with the list of broken rules in ``errors``.

    A snapshot date must be a day of the calendar, unless ``any_date`` lets every text through.
    """
    longs = ("clicks_30d", "impressions_30d")
    parsed = _parsed(
        raw,
        {
            "keyword": keyword_key(F.col("keyword")),
            "url": url_key(F.col("url")),
            "snapshot_date": strip(F.col("snapshot_date")),
            "position": _number("position", 0),
            "previous_position": _number("previous_position", None),
            **{c: _number(c, 0, type_name="bigint") for c in longs},
        },
        ("position", "previous_position", *longs),
    )
    position, day = F.col("position"), F.col("snapshot_date")
    dated = F.lit(True) if any_date else _empty("snapshot_date") | is_day(day)
    return parsed.withColumn(
        "errors",
        reasons(
            _malformed("position"),
            (position < 0, _with_value("negative position", position)),
            _malformed("previous_position"),
            *[_malformed(c) for c in longs],
            (_empty("snapshot_date"), F.lit("empty snapshot date")),
            (~dated, _with_value("snapshot date is no day", day)),
        ),
    ).drop("_raw_position", "_raw_previous_position", *[f"_raw_{c}" for c in longs])


def first_of_each(df: DataFrame, key: Sequence[str], order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """The first row of each key in source order.

    A key's copies are cut down to one in every task before they are shuffled, so a key with very many
    copies does not weigh on one task.
    """
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy")


def _is_valid() -> Column:
    return F.size("errors") == 0


def quarantined(checked: DataFrame, entity: str) -> DataFrame:
    """Rejected rows in report form; a position is named by keyword and URL."""
    name = [c for c in KEYS[entity] if c != "snapshot_date"]
    return checked.filter(~_is_valid()).select(
        F.lit(entity).alias("entity"), F.concat_ws(" @ ", *name).alias("key"), "errors"
    )


def _split(checked: DataFrame, entity: str, order: Sequence[str]) -> Cleaned:
    valid = first_of_each(checked.filter(_is_valid()).drop("errors"), KEYS[entity], order)
    return Cleaned(valid, quarantined(checked, entity))


def clean_keywords(raw: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> Cleaned:
    return _split(check_keywords(raw), "keywords", order)


def clean_pages(raw: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> Cleaned:
    return _split(check_pages(raw), "pages", order)


def mark_orphans(checked: DataFrame, keywords: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds a reason to valid positions whose keyword, or else whose URL, is not in the clean batch.

    ``keywords`` and ``pages`` are unique by their key.
    """
    known_keywords = keywords.select("keyword", F.lit(True).alias("_has_keyword"))
    known_urls = pages.select("url", F.lit(True).alias("_has_url"))
    orphan = F.when(
        _is_valid(),
        F.when(F.col("_has_keyword").isNull(), _with_value("orphan, unknown keyword", F.col("keyword"))).when(
            F.col("_has_url").isNull(), _with_value("orphan, unknown URL", F.col("url"))
        ),
    )
    return (
        checked.join(known_keywords, "keyword", "left")
        .join(known_urls, "url", "left")
        .withColumn("errors", F.when(orphan.isNull(), F.col("errors")).otherwise(F.array(orphan)))
        .select(*checked.columns)
    )


def cohere_metrics(positions: DataFrame) -> DataFrame:
    """Clicks are at least 0 and impressions at least the clicks; the rate is NULL without impressions."""
    clicks = F.greatest("clicks_30d", F.lit(0).cast("bigint"))
    return (
        positions.withColumn("clicks_30d", clicks)
        .withColumn("impressions_30d", F.greatest("impressions_30d", "clicks_30d"))
        .withColumn("ctr_30d", click_rate(F.col("clicks_30d"), F.col("impressions_30d")))
    )


def click_rate(clicks: Column, impressions: Column) -> Column:
    return F.when(impressions != 0, clicks / impressions)


def clean_positions(
    raw: DataFrame, keywords: DataFrame, pages: DataFrame, order: Sequence[str] = SOURCE_ORDER
) -> Cleaned:
    """Valid positions of known keywords and URLs, with coherent metrics."""
    return split_positions(mark_orphans(check_positions(raw), keywords, pages), order)


def split_positions(marked: DataFrame, order: Sequence[str] = SOURCE_ORDER) -> Cleaned:
    """Checked and marked positions parted into valid and rejected ones."""
    cleaned = _split(marked, "positions", order)
    return Cleaned(cohere_metrics(cleaned.valid), cleaned.quarantine)


# --- The staging path: blanks get defaults instead of being rejected -------------------------------


def _or_default(column: str, default: str) -> Column:
    text = strip(F.col(column))
    return F.coalesce(F.when(text != "", text), F.lit(default))


def staged_keywords(staging: DataFrame, order: Sequence[str]) -> DataFrame:
    """Keywords of a staging table with defaults filled in, one row per key; blank keys are skipped."""
    filled = staging.filter(~is_blank(F.col("keyword"))).select(
        keyword_key(F.col("keyword")).alias("keyword"),
        _or_default("category", DEFAULT_CATEGORY).alias("category"),
        _or_default("search_intent", DEFAULT_INTENT).alias("search_intent"),
        F.coalesce("monthly_search_volume", F.lit(0)).cast("bigint").alias("monthly_search_volume"),
        F.coalesce("keyword_difficulty", F.lit(DEFAULT_DIFFICULTY)).cast("int").alias("keyword_difficulty"),
        *[F.col(c).alias(f"_order_{c}") for c in order],
    )
    return first_of_each(filled, ["keyword"], [f"_order_{c}" for c in order]).drop(*[f"_order_{c}" for c in order])


def staged_pages(staging: DataFrame, order: Sequence[str]) -> DataFrame:
    """Pages of a staging table by trimmed URL; of several rows the newest ``loaded_at`` wins, then
    the first in ``order``. NULLs stay, since they mean "keep" when a known page is updated."""
    newest = Window.partitionBy("url").orderBy(F.desc_nulls_last("loaded_at"), *[f"_order_{c}" for c in order])
    return (
        staging.filter(~is_blank(F.col("url")))
        .select(
            url_key(F.col("url")).alias("url"),
            strip(F.col("title")).alias("title"),
            strip(F.col("h1")).alias("h1"),
            "word_count",
            "indexable",
            "page_speed_score",
            "loaded_at",
            *[F.col(c).alias(f"_order_{c}") for c in order],
        )
        .withColumn("_copy", F.row_number().over(newest))
        .filter("_copy = 1")
        .drop("_copy", *[f"_order_{c}" for c in order])
    )


def _staged_day() -> Column:
    return strip(F.col("snapshot_date"))


def staged_positions(staging: DataFrame, order: Sequence[str]) -> DataFrame:
    """Positions of a staging table by normalised names, one row per key; rows without a day are left out."""
    filled = staging.filter(is_day(_staged_day())).select(
        keyword_key(F.col("keyword")).alias("keyword"),
        url_key(F.col("url")).alias("url"),
        _staged_day().alias("snapshot_date"),
        F.coalesce("position", F.lit(0)).cast("int").alias("position"),
        *[F.col(c).alias(f"_order_{c}") for c in order],
    )
    ordered = [f"_order_{c}" for c in order]
    return first_of_each(filled, KEYS["positions"], ordered).drop(*ordered)


def undated_positions(staging: DataFrame) -> DataFrame:
    """The rows of a staging table that ``staged_positions`` leaves out, in report form."""
    day = _staged_day()
    reason = F.when(F.coalesce(day, F.lit("")) == "", F.lit("empty snapshot date")).otherwise(
        _with_value("snapshot date is no day", day)
    )
    name = F.concat_ws(" @ ", keyword_key(F.col("keyword")), url_key(F.col("url")))
    return staging.filter(~is_day(day)).select(
        F.lit("positions").alias("entity"), name.alias("key"), F.array(reason).alias("errors")
    )
