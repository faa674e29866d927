"""Whole loads as queries: what a store holds after runs over exports and over staging tables.

Every query loads the tables of a folder into a store of its own in the shared folder; queries of one
application over the same folder share it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktide.operators import cleaning, quality
from ranktide.plans import batch, mart
from ranktide.schemas import DIM_KEYWORD, DIM_PAGE, DIM_SITE, EXPORT_COLUMNS, FACT_ISSUE, FACT_POSITION, Table
from ranktide.session import application_folder, forget_shuffles
from ranktide.sources import trade
from ranktide.sources.exports import read_export, tag_batch
from ranktide.sources.store import Store
from ranktide.sources.trade import CUT_DATE, FEED_ORDER, POSITION_ORDER, Trade

RUN_DAY, NEXT_RUN_DAY = "2002-01-31", "2002-02-07"
STAGING_ORDER = {"keywords": ["src_key"], "pages": list(FEED_ORDER), "positions": list(POSITION_ORDER)}
# The raw tables in the order of their exports.
RAW = {
    "keywords": lambda t: trade.raw_keywords(t).orderBy(*FEED_ORDER),
    "pages": lambda t: trade.raw_pages(t).orderBy(*FEED_ORDER),
    "positions": lambda t: trade.raw_positions(t, in_order=True),
}

_made: dict[tuple, str] = {}


def _once(spark: SparkSession, folder: str, kind: str, make: Callable[[SparkSession, str, str], None]) -> str:
    """The place of what ``make`` has made of a folder in this application."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _made:
        where = application_folder(spark, kind)
        make(spark, folder, where)
        _made[key] = where
    return _made[key]


def write_export(df: DataFrame, folder: str, entity: str) -> None:
    """An export as compressed CSV, its rows in the order of ``df``."""
    columns = df.select(*EXPORT_COLUMNS[entity])
    columns.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="lz4"
    ).csv(f"{folder}/{entity}.csv")


def write_exports(spark: SparkSession, folder: str, where: str, *entities: str) -> None:
    t = Trade(spark, folder)
    for entity in entities or RAW:
        write_export(RAW[entity](t), where, entity)
    forget_shuffles(spark)  # those of the sorts


def _load_exports_twice(spark: SparkSession, folder: str, where: str) -> None:
    write_exports(spark, folder, where)
    store = Store(spark, f"{where}/store")
    batch.load_exports(store, where, RUN_DAY, "batch-1")
    batch.load_exports(store, where, NEXT_RUN_DAY, "batch-2")


def exports_store(spark: SparkSession, folder: str) -> Store:
    """A store into which the exports were loaded, and a week later once more."""
    return Store(spark, _once(spark, folder, "loaded-exports", _load_exports_twice) + "/store")


def _load_staging_twice(spark: SparkSession, folder: str, where: str) -> None:
    t, store = Trade(spark, folder), Store(spark, f"{where}/store")
    tables = {"keywords": trade.staging_keywords(t), "pages": trade.staging_pages(t)}
    positions = trade.staging_positions(t)
    early = tables | {"positions": positions.filter(F.col("snapshot_date") <= CUT_DATE)}
    batch.load_staging(store, early, RUN_DAY, "batch-1", STAGING_ORDER)
    batch.load_staging(store, tables | {"positions": positions}, NEXT_RUN_DAY, "batch-2", STAGING_ORDER)


def staging_store(spark: SparkSession, folder: str) -> Store:
    """A store with two staging loads, of which the second repeats the first one's positions and has later ones."""
    return Store(spark, _once(spark, folder, "loaded-staging", _load_staging_twice) + "/store")


def _table(store: Callable[[SparkSession, str], Store], name: str, declared: Table) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: store(spark, folder).read(name).select(*declared.names)


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The run log without its times."""
    runs = exports_store(spark, folder).runs()
    ended = (F.col("finished_at") >= F.col("started_at")).alias("ended")
    return runs.select("run_id", "status", "rows_extracted", "rows_loaded", "message", ended)


def top_opportunities(spark: SparkSession, folder: str) -> DataFrame:
    """What a load logs at its end."""
    rows = [(i, row["keyword"], row["url"], row["position"]) for i, row in enumerate(batch.log_top(exports_store(spark, folder)), 1)]
    return spark.createDataFrame(rows, "place int, keyword string, url string, position int")


def refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """What a full refresh leaves of an earlier load, by table: the refresh gets no file of positions."""

    def make(spark: SparkSession, folder: str, where: str) -> None:
        write_exports(spark, folder, f"{where}/first")
        write_exports(spark, folder, f"{where}/second", "keywords", "pages")
        store = Store(spark, f"{where}/store")
        batch.load_exports(store, f"{where}/first", RUN_DAY, "batch-1")
        batch.load_exports(store, f"{where}/second", NEXT_RUN_DAY, "batch-2", full_refresh=True)
        store.vacuum()

    store = Store(spark, _once(spark, folder, "refreshed", make) + "/store")
    star = store.tables()
    counts = [
        star[name].agg(F.count(F.lit(1)).alias("rows"), F.max(key).alias("greatest")).select(F.lit(name).alias("table"), "rows", "greatest")
        for name, key in (("dim_keyword", "keyword_id"), ("dim_page", "page_id"), ("fact_keyword_position", "position_id"), ("etl_run_log", "run_id"))
    ]
    return quality.union_all(counts)


def without_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine of exports without ``pages.csv``: no page is known, so that no position is valid."""
    where = application_folder(spark, "scratch")
    write_exports(spark, folder, where, "keywords", "positions")
    read = {entity: tag_batch(read_export(spark, where, entity), "batch-1", "2002-01-07T08:00:00Z") for entity in RAW}
    keywords, pages = cleaning.clean_keywords(read["keywords"]), cleaning.clean_pages(read["pages"])
    positions = cleaning.clean_positions(read["positions"], keywords.valid, pages.valid)
    rejected = [c.quarantine.withColumn("errors", F.concat_ws("; ", "errors")) for c in (keywords, pages, positions)]
    return quality.union_all(rejected)


def _read(entity: str) -> Callable[[SparkSession, str], DataFrame]:
    """An export written as CSV, read back and tagged with a batch."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        where = application_folder(spark, "scratch")
        write_exports(spark, folder, where, entity)
        staged = tag_batch(read_export(spark, where, entity), "batch-1", "2002-01-07T08:00:00Z")
        return staged.select(*EXPORT_COLUMNS[entity], "load_id")

    return query


def built_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart written as a table over an earlier one, read back."""
    tables, target = trade.performance(spark, folder), application_folder(spark, "scratch")
    mart.build(tables, target)
    return mart.build(tables, target)


QUERIES = {
    "read_keywords_export": _read("keywords"),
    "read_pages_export": _read("pages"),
    "read_positions_export": _read("positions"),
    "quarantine_without_pages": without_pages,
    "loaded_sites": _table(exports_store, "dim_site", DIM_SITE),
    "loaded_keywords": _table(exports_store, "dim_keyword", DIM_KEYWORD),
    "loaded_pages": _table(exports_store, "dim_page", DIM_PAGE),
    "loaded_positions": _table(exports_store, "fact_keyword_position", FACT_POSITION),
    "loaded_issues": _table(exports_store, "fact_technical_issue", FACT_ISSUE),
    "loaded_run_log": run_log,
    "loaded_top5": top_opportunities,
    "refreshed_counts": refreshed,
    "staged_load_keywords": _table(staging_store, "dim_keyword", DIM_KEYWORD),
    "staged_load_pages": _table(staging_store, "dim_page", DIM_PAGE),
    "staged_load_positions": _table(staging_store, "fact_keyword_position", FACT_POSITION),
    "staged_load_issues": _table(staging_store, "fact_technical_issue", FACT_ISSUE),
    "mart_built": built_mart,
}
