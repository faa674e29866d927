"""Exact row numbers and ranks over a whole table, without a window that gathers it in one task.

The order is cut into ranges by bounds that are rows of the table themselves: keys whose hash falls under a threshold,
so that the same table gives the same bounds whenever and wherever they are drawn. Rows are counted per range, the counts
are added up over the ranges, and a row's number is what comes before its range plus its place inside it. All of this is one
lazy plan: the bounds are a scalar subquery, nothing is written, and a repeated task finds the same numbers.

Keys of the order ascend, NULL first; a descending number is given as its negative.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranktide.session import freeze

RANGES_PER_PARTITION = 4
DRAWN_PER_RANGE = 8
_HASHES = 1 << 30

Key = str | Column


def _columns(keys: Sequence[Key]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _key(keys: Sequence[Key]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_columns(keys))])


def range_count(df: DataFrame) -> int:
    """How many ranges a table is cut into: a few for each partition of a shuffle."""
    return RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_ranges(df: DataFrame, keys: Sequence[Key], ranges: int) -> DataFrame:
    """Adds ``_range``, the number of the range in which a row lies; it ascends with the keys.

    About ``ranges`` times ``DRAWN_PER_RANGE`` distinct keys are drawn, whatever the size of the table, and every
    ``DRAWN_PER_RANGE``-th of them in order is a bound. A row's range is found by halving: one projection per step, all in
    generated code, so that a row is compared with some ``log2(ranges)`` bounds and the array of bounds is never copied.
    """
    rows = df.agg(F.count(F.lit(1))).scalar()
    threshold = (F.lit(_HASHES) * F.least(F.lit(1.0), F.lit(ranges * DRAWN_PER_RANGE) / F.greatest(rows, F.lit(1)))).cast("bigint")
    drawn = df.select(_key(keys).alias("key")).filter(F.pmod(F.xxhash64("key"), F.lit(_HASHES)) < threshold)
    bounds = F.filter(F.array_sort(F.collect_set("key")), lambda _, i: i % DRAWN_PER_RANGE == DRAWN_PER_RANGE - 1)
    ranged = df.withColumns({"_bounds": drawn.agg(bounds.alias("bounds")).scalar(), "_key": _key(keys), "_range": F.lit(0)})
    # The steps reach over twice as many bounds as there should be; rows behind all of them would share the last range.
    step = 1 << ranges.bit_length()
    while step:
        bound = F.get("_bounds", F.col("_range") + (step - 1))
        ranged = ranged.withColumn("_range", F.col("_range") + F.when(bound <= F.col("_key"), step).otherwise(0))
        step >>= 1
    return ranged.drop("_bounds", "_key")


def _before(ranged: DataFrame, within: Sequence[str], weight: Column) -> DataFrame:
    """For each range (and value of ``within``) the weight of all ranges before it, where there is any.

    The order begins with ``within``, so only the first group of a range can have rows in earlier ones: there is at most one
    row per range, and the broadcast is bounded.
    """
    weights = ranged.groupBy(*within, "_range").agg(weight.alias("_weight"))
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = weights.withColumn("_before", F.sum("_weight").over(earlier)).filter("_before > 0")
    return F.broadcast(before.drop("_weight"))


def _joined(rows: DataFrame, other: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which NULL equals NULL; ``other`` keeps none of the columns."""
    renamed = other.select(*[F.col(c).alias(f"_of_{c}") for c in columns], *[c for c in other.columns if c not in columns])
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return rows.join(renamed, same, how).drop(*[f"_of_{c}" for c in columns])


def _earlier() -> Column:
    return F.coalesce("_before", F.lit(0))


def number_rows(
    df: DataFrame, order_by: Sequence[Key], out: str, within: Sequence[str] = (), start: Column | int = 0
) -> DataFrame:
    """``start`` + 1, 2, 3, … in ``order_by`` order, counted anew for each value of ``within``.

    ``within`` and ``order_by`` together should be unique; rows that agree in all of them share a task and are numbered in any order.
    """
    keys = [*within, *order_by]
    ranged = with_ranges(df, keys, range_count(df))
    inside = Window.partitionBy(*within, "_range").orderBy(*[c.asc_nulls_first() for c in _columns(order_by)])
    placed = ranged.withColumn("_place", F.row_number().over(inside))
    numbered = _joined(placed, _before(ranged, within, F.count(F.lit(1))), [*within, "_range"], "left")
    first = start if isinstance(start, Column) else F.lit(start)
    return numbered.select(*df.columns, (_earlier() + F.col("_place") + first).cast("bigint").alias(out))


def with_ids(
    new_rows: DataFrame, stored: DataFrame, id_column: str, order_by: Sequence[Key], greatest: int | None = None
) -> DataFrame:
    """Surrogate keys for ``new_rows``: on from the greatest stored one, in ``order_by`` order.

    A caller that knows the ``greatest`` one spares the look through ``stored``.

    The new rows are what is left of a batch behind its joins with stored tables; they are written once, so that
    drawing bounds, counting and numbering don't run those joins again.
    """
    if greatest is None:
        start = stored.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("greatest")).scalar()
    else:
        start = F.lit(greatest).cast("bigint")
    return number_rows(freeze(new_rows), order_by, id_column, start=start)


def rank_rows(df: DataFrame, value: str, out: str, within: Sequence[str]) -> DataFrame:
    """SQL ``RANK()`` by descending numeric ``value`` within groups, NULL last.

    Rows are reduced to distinct values with their frequencies by partial aggregation; a value's rank is one more than the rows
    of all greater values: those of the ranges before its own, and those before it in its range. Rows are never sorted.
    """
    values = df.groupBy(*within, value).agg(F.count(F.lit(1)).alias("_n"))
    # NULL is the first of ascending keys, so that a flag puts it last among the descending values.
    keys = [*within, F.col(value).isNull(), -F.col(value)]
    ranged = with_ranges(values, keys, range_count(df))
    inside = Window.partitionBy(*within, "_range").orderBy(F.desc_nulls_last(value)).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_greater", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    summed = _joined(summed, _before(ranged, within, F.sum("_n")), [*within, "_range"], "left")
    ranks = summed.select(*within, value, (_earlier() + F.col("_greater") + 1).cast("bigint").alias(out))
    return _joined(df, ranks, [*within, value]).select(*df.columns, out)
