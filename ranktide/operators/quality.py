"""Quality checks. Each yields rows ``check``, ``status`` (PASS or FAIL) and ``violations``.

Rules, keys and references of a table share one pass over it and are counted with partial aggregation, so a value that
makes up much of a table does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranktide.plans.mart import CLASSES
from ranktide.schemas import STAR, Table

REPORT = ("check", "status", "violations")


def _status(violations: Column) -> Column:
    return F.when(violations == 0, "PASS").otherwise("FAIL")


def _report(counts: DataFrame) -> DataFrame:
    """From ``check`` and ``violations`` to report rows."""
    return counts.select(
        "check", _status(F.col("violations")).alias("status"), F.col("violations").cast("bigint")
    )


def row_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One report row per rule. A rule says what a bad row is; NULL is not bad."""
    totals = df.agg(*[F.count_if(bad).alias(f"_{i}") for i, bad in enumerate(rules.values())])
    rows = F.array(
        *[F.struct(F.lit(name).alias("check"), F.col(f"_{i}").alias("violations")) for i, name in enumerate(rules)]
    )
    return _report(totals.select(F.inline(rows)))


def not_empty(df: DataFrame, name: str) -> DataFrame:
    """The table has a row. Reads no more than one."""
    found = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _report(found.select(F.lit(f"{name} not empty").alias("check"), (1 - F.col("n")).alias("violations")))


def not_null(name: str, columns: Sequence[str]) -> dict[str, Column]:
    return {f"{name}.{c} not null": F.col(c).isNull() for c in columns}


def accepted_values(name: str, column: str, values: Sequence) -> dict[str, Column]:
    return {f"{name}.{column} in accepted values": ~F.col(column).isin(*values)}


def in_range(name: str, column: str, low: int | None, high: int | None) -> dict[str, Column]:
    below = F.col(column) < low if low is not None else F.lit(False)
    above = F.col(column) > high if high is not None else F.lit(False)
    return {f"{name}.{column} in range": below | above}


def unique(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Keys with a NULL are not compared."""
    complete = df.select(*columns).dropna("any")
    repeated = complete.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    label = f"{name}.{'+'.join(columns)} unique"
    return _report(repeated.agg(F.count(F.lit(1)).alias("violations")).withColumn("check", F.lit(label)))


def referential(
    child: DataFrame, parent: DataFrame, key: str, name: str, parent_key: str | None = None, required: bool = False
) -> DataFrame:
    """Child rows whose key is not in the parent; a NULL key counts only if it is ``required``.

    Children are counted per key before the join.
    """
    kept = child if required else child.filter(F.col(key).isNotNull())
    per_key = kept.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key or key).alias(key))
    orphans = per_key.join(parents, key, "left_anti")
    return _report(
        orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).withColumn(
            "check", F.lit(f"{name}.{key} has parent")
        )
    )


def union_all(reports: Sequence[DataFrame]) -> DataFrame:
    first, *rest = reports
    for one in rest:
        first = first.unionByName(one)
    return first


def load_checks(star: Mapping[str, DataFrame]) -> DataFrame:
    """The five checks after a load."""
    return union_all(
        [
            not_empty(star["dim_keyword"], "dim_keyword"),
            not_empty(star["dim_page"], "dim_page"),
            row_checks(
                star["fact_keyword_position"], {"fact_keyword_position.ctr_30d at most 1": F.col("ctr_30d") > 1}
            ),
            row_checks(star["dim_page"], accepted_values("dim_page", "indexable", (0, 1))),
            referential(
                star["fact_keyword_position"], star["dim_keyword"], "keyword_id", "fact_keyword_position", required=True
            ),
        ]
    )


def _declared(name: str, table: Table) -> dict[str, Column]:
    """The rules on single rows that a table declares."""
    rules = not_null(name, [table.key, *table.required])
    for column, values in table.allowed.items():
        rules |= accepted_values(name, column, values)
    for column, (low, high) in table.ranges.items():
        rules |= in_range(name, column, low, high)
    return rules


def _table_constraints(name: str, table: Table, star: Mapping[str, DataFrame]) -> DataFrame:
    """All declared constraints of a table in one pass over it.

    Rows are grouped by every key, by every reference to a parent, and by the set of rules they break, as grouping sets of one
    aggregation. Of what it yields only repeated keys, references and sets of rules go on, meet the keys of all parents in one
    join, and are added up.
    """
    rules = _declared(name, table)
    uniques = list(dict.fromkeys([(table.key,), *table.unique]))
    parents = {key: parent for key, parent in table.parents.items() if parent in star}
    broken = F.lit(0).cast("bigint")
    for i, bad in enumerate(rules.values()):
        broken = broken + F.when(bad, F.lit(1 << i)).otherwise(F.lit(0))
    sets = list(dict.fromkeys([*uniques, *((key,) for key in parents), ("_broken",)]))
    columns = list(dict.fromkeys(c for one in sets for c in one))

    def is_set(one: Sequence[str]) -> Column:
        # grouping_id has a bit for every column, the first the highest, that the set does not have.
        return F.col("_set") == sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in one)

    def either(conditions: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a | b, conditions, F.lit(False))

    rows = star[name].withColumn("_broken", broken).select(*columns)
    grouped = rows.groupingSets(sets, *columns).agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
    repeated = either([is_set(one) & (F.col("_n") > 1) & ~either([F.col(c).isNull() for c in one]) for one in uniques])
    refers = either([is_set((key,)) & F.col(key).isNotNull() for key in parents])
    kept = grouped.filter(repeated | refers | is_set(("_broken",)))
    if parents:
        # What is no reference gets a key of its own, so that it does not pile up under NULL.
        key = F.coalesce(*[F.when(is_set((k,)), F.col(k).cast("string")) for k in parents], F.xxhash64(*columns).cast("string"))
        known = union_all(
            [
                star[parent].select(F.lit(k).alias("_of"), F.col(k).cast("string").alias("_key")).distinct()
                for k, parent in parents.items()
            ]
        ).withColumn("_known", F.lit(True))
        of = F.coalesce(*[F.when(is_set((k,)), F.lit(k)) for k in parents], F.lit(""))
        kept = kept.withColumns({"_of": of, "_key": key}).join(known, ["_of", "_key"], "left")
    counts = {check: F.sum(F.when(is_set(("_broken",)) & ((F.col("_broken").bitwiseAND(F.lit(1 << i))) != 0), F.col("_n"))) for i, check in enumerate(rules)}
    for one in uniques:
        of_key = is_set(one) & (F.col("_n") > 1) & ~either([F.col(c).isNull() for c in one])
        counts[f"{name}.{'+'.join(one)} unique"] = F.count_if(of_key)
    for k in parents:
        counts[f"{name}.{k} has parent"] = F.sum(F.when(is_set((k,)) & F.col(k).isNotNull() & F.col("_known").isNull(), F.col("_n")))
    totals = kept.agg(*[F.coalesce(total, F.lit(0)).cast("bigint").alias(f"_{i}") for i, total in enumerate(counts.values())])
    report = [F.struct(F.lit(check).alias("check"), F.col(f"_{i}").alias("violations")) for i, check in enumerate(counts)]
    return _report(totals.select(F.inline(F.array(*report))))


def constraint_checks(star: Mapping[str, DataFrame], tables: Mapping[str, Table] = STAR) -> DataFrame:
    """All declared constraints of the tables present: keys, required columns, values, ranges, parents."""
    return union_all([_table_constraints(name, table, star) for name, table in tables.items() if name in star])


def mart_checks(mart: DataFrame, keys: Sequence[str] = ("keyword_id", "date_id")) -> DataFrame:
    """The mart's checks. A keyword is unique per date; pass ``("keyword_id",)`` for a single date."""
    rules = not_null("mart", ["keyword_id", "keyword_text", "oportunidad_mejora"])
    rules |= accepted_values("mart", "classification", CLASSES)
    return union_all([row_checks(mart, rules), unique(mart, "mart", keys)])


def failed(report: DataFrame) -> DataFrame:
    return report.filter("status = 'FAIL'")


def require(report: DataFrame) -> None:
    """Raises when a check failed, naming the failed ones. A report has a row per check."""
    broken = [f"{row['check']}: {row['violations']}" for row in failed(report).collect()]
    if broken:
        raise ValueError("failed checks: " + "; ".join(broken))


# --- Monitoring ------------------------------------------------------------------------------------


def freshness(star: Mapping[str, DataFrame], run_date: str, max_days: int = 8) -> DataFrame:
    """The newest snapshot is at most ``max_days`` old."""
    dates = star["snapshot_calendar"] if "snapshot_calendar" in star else star["fact_keyword_position"]
    age = F.date_diff(F.lit(run_date).cast("date"), F.max("snapshot_date").try_cast("date"))
    late = F.when(age <= max_days, 0).otherwise(1)
    return _report(
        dates.agg(late.alias("violations")).withColumn("check", F.lit(f"newest snapshot at most {max_days} days old"))
    )


def run_alerts(run_log: DataFrame, max_fall: float = 0.5) -> DataFrame:
    """Runs that failed or extracted less than half of what the successful run before them did."""
    ended = run_log.filter("status IN ('success', 'failed')")
    # The log has a row per run, a handful a week, so its order may well be a single window.
    before = F.expr(
        "last(CASE WHEN status = 'success' THEN rows_extracted END, true) "
        "OVER (ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    fell = F.col("rows_extracted") < F.col("_before") * (1.0 - max_fall)
    reason = F.when(F.col("status") == "failed", "run failed").when(fell, "rows extracted fell")
    return (
        ended.withColumn("_before", before)
        .withColumn("reason", reason)
        .filter("reason IS NOT NULL")
        .select("run_id", "status", "rows_extracted", "reason")
    )


def active_tier_limit(quick_wins: DataFrame, tier: str = "P1 - Critical", limit: int = 10) -> DataFrame:
    """At most ``limit`` opportunities of the top tier; the excess counts as violations."""
    excess = F.greatest(F.count_if(F.col("priority_tier") == tier) - limit, F.lit(0))
    return _report(
        quick_wins.agg(excess.alias("violations")).withColumn("check", F.lit(f"at most {limit} rows of {tier}"))
    )


def drop_alerts(position_changes: DataFrame, min_drop: int = 5) -> DataFrame:
    """Movements that lost ``min_drop`` positions or more."""
    return position_changes.filter(F.col("position_delta") <= -min_drop)
