"""The star schema and raw exports derived from generic trade tables.

Parts stand for keywords, suppliers for pages, nations for sites, yearly shipments for rank snapshots,
error events for technical issues, and local urgent returns for backlinks. Everything is derived from
whole tables; what a table holds too much of, it holds here too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

FIRST_DATE, CUT_DATE, OVERLAP_DATE = "1995-07-01", "1999-12-31", "1998-12-31"
POSITION_ORDER = ("src_order", "src_line", "src_part", "src_supplier", "src_price")
FEED_ORDER = ("src_feed", "src_key")


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


class Trade:
    """The trade tables of a folder, by name. Each is opened once, when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


class Derived(Mapping):
    """Tables by name, each derived when first asked for, so that a query opens no others."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def __contains__(self, name: object) -> bool:
        return name in self._makers


# SQL expressions over the trade tables. Doubles are written with an exponent: 100.0 would be a decimal.
LINKED_PAGE = "if(l_suppkey < 4, 4L, l_suppkey - l_suppkey % 4)"
SNAPSHOT_DATE = "concat(year(l_shipdate), '-12-31')"
SHOP_URL = "concat('https://nation_', s_nationkey, '.example/p/', s_suppkey)"
SECTION_URL = "concat('nation_', c_nationkey, '.example/s/', lower(c_mktsegment))"
KEYWORD = "concat(lower(p_type), ' ', lower(p_name), ' ', p_partkey)"
CATEGORY = (
    "CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'transaccional'"
    " WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'comercial' ELSE 'informativo' END"
)
INTENT = (
    "CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'transactional'"
    " WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'commercial' ELSE 'informational' END"
)
# Searches a month: none to some thirty thousand, by price.
VOLUME = "greatest(cast(round((p_retailprice - 9e2) * 3e2) AS bigint), 0L)"
CLICKS = "cast(floor(l_extendedprice * l_discount / 1e1) AS bigint)"
IMPRESSIONS = "cast(floor(l_extendedprice / 1e1) AS bigint)"
WORDS = r"regexp_count(regexp_replace(html, '<[^>]*>', ' '), r'[^ \t\r\n]+')"
TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
HEADING = "regexp_extract(html, '<h1>([^<]*)</h1>', 1)"


# --- The star schema -------------------------------------------------------------------------------


def sites(t: Trade) -> DataFrame:
    return t.nation.selectExpr(
        "cast(n_nationkey AS bigint) AS site_id",
        "concat(lower(n_name), '.example') AS domain",
        "n_name AS site_name",
        "'es' AS language",
        "concat('R', n_regionkey) AS country",
        "1 AS is_active",
    )


def keywords(t: Trade) -> DataFrame:
    return t.part.selectExpr(
        "p_partkey AS keyword_id",
        f"{KEYWORD} AS keyword",
        f"{CATEGORY} AS category",
        f"{INTENT} AS search_intent",
        f"{VOLUME} AS monthly_search_volume",
        "p_size * 2 AS keyword_difficulty",
        "cast(NULL AS string) AS current_url_target",
    )


def pages(t: Trade) -> DataFrame:
    return t.supplier.selectExpr(
        "s_suppkey AS page_id",
        "cast(s_nationkey AS bigint) AS site_id",
        f"{SHOP_URL} AS url",
        "s_name AS title",
        "cast(NULL AS string) AS meta_description",
        "lower(s_name) AS h1",
        "cast(floor(abs(s_acctbal)) AS int) AS word_count",
        "if(s_acctbal < 1000, 0, 1) AS indexable",
        "CASE WHEN s_acctbal <= 9500 THEN cast(floor(abs(s_acctbal) / 1e2) AS int) END AS page_speed_score",
        "'2001-12-31' AS last_crawled_at",
    )


def positions(t: Trade) -> DataFrame:
    """One row per keyword, page and year; the position before it is that of the pair's last year."""
    yearly = (
        t.lineitem.selectExpr(
            "l_partkey AS keyword_id",
            "l_suppkey AS page_id",
            f"{SNAPSHOT_DATE} AS snapshot_date",
            "l_quantity",
            f"{CLICKS} AS clicks",
            f"{IMPRESSIONS} AS impressions",
        )
        .groupBy("keyword_id", "page_id", "snapshot_date")
        .agg({"l_quantity": "min", "clicks": "sum", "impressions": "sum"})
        .withColumnsRenamed(
            {"min(l_quantity)": "best", "sum(clicks)": "clicks_30d", "sum(impressions)": "impressions_30d"}
        )
    )
    position = "if(best >= 46, 0, cast(best AS int))"
    return yearly.selectExpr(
        "(keyword_id * 10000000 + page_id) * 10 + (cast(substr(snapshot_date, 1, 4) AS bigint) - 1995) AS position_id",
        "keyword_id",
        "page_id",
        "snapshot_date",
        f"{position} AS position",
        f"lag({position}) OVER (PARTITION BY keyword_id, page_id ORDER BY snapshot_date) AS previous_position",
        "clicks_30d",
        "impressions_30d",
        "CASE WHEN impressions_30d <> 0 THEN clicks_30d / impressions_30d END AS ctr_30d",
    )


def snapshot_calendar(t: Trade) -> DataFrame:
    """Dates of the snapshots, one row per shipment; good for a maximum without grouping the fact."""
    return t.lineitem.selectExpr(f"{SNAPSHOT_DATE} AS snapshot_date")


def issues(t: Trade) -> DataFrame:
    """One issue per event; an event of no page concerns the whole site."""
    events = t.events.selectExpr(
        "event_id",
        "event_type",
        "user_id",
        "value",
        "cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS code",
        "date_format(ts, 'yyyy-MM-dd') AS day",
    )
    owners = t.supplier.selectExpr("s_suppkey", "cast(s_nationkey AS bigint) AS s_nationkey")
    return events.join(owners, events.user_id == owners.s_suppkey, "left").selectExpr(
        "event_id AS issue_id",
        "coalesce(s_nationkey, cast(code % 25 AS bigint)) AS site_id",
        "s_suppkey AS page_id",
        "CASE WHEN code < 40 AND event_type <> 'error' THEN concat(event_type, '_drop')"
        " WHEN code < 20 THEN 'noindex' WHEN code < 40 THEN 'content_decay' WHEN code < 60 THEN 'slow_lcp'"
        " WHEN code < 80 THEN 'title_too_long' ELSE 'canonical_conflict' END AS issue_type",
        "CASE WHEN value >= 100 THEN 'critical' WHEN value >= 50 THEN 'high' WHEN value >= 20 THEN 'medium'"
        " ELSE 'low' END AS severity",
        "cast(floor(value) AS bigint) AS traffic_at_risk",
        "day AS detected_at",
        "CASE WHEN value >= 30 THEN day END AS resolved_at",
        "CASE WHEN value < 10 THEN 'open' WHEN value < 30 THEN 'in_progress' ELSE 'resolved' END AS status",
    )


def backlinks(t: Trade) -> DataFrame:
    """Every line is a link of its customer to a page; only every fourth page is linked to, and the first ones share one.

    A customer's links to a page are one backlink, first seen at the earliest order.
    """
    lines = t.lineitem.selectExpr("l_orderkey", f"{LINKED_PAGE} AS page_id")
    orders = t.orders.selectExpr("o_orderkey AS l_orderkey", "o_custkey", "o_orderdate")
    first = lines.join(orders, "l_orderkey").groupBy("page_id", "o_custkey").agg({"o_orderdate": "min"})
    customers = t.customer.selectExpr("c_custkey AS o_custkey", "c_acctbal", "c_mktsegment")
    return first.join(customers, "o_custkey").selectExpr(
        "o_custkey * 10000000 + page_id AS backlink_id",
        "page_id",
        "concat('ref', o_custkey, '.example') AS referring_domain",
        "least(greatest(cast(floor((c_acctbal + 1e3) / 1.1e2) AS int), 0), 100) AS domain_authority",
        "lower(c_mktsegment) AS link_type",
        "date_format(`min(o_orderdate)`, 'yyyy-MM-dd') AS first_seen_at",
    )


def run_log(t: Trade) -> DataFrame:
    """A run per month, which extracted that month's orders; it failed when none of them was urgent
    and open."""
    monthly = (
        t.orders.selectExpr(
            "date_format(o_orderdate, 'yyyy-MM') AS month",
            "1L AS one",
            "if(o_orderpriority = '1-URGENT' AND o_orderstatus = 'O', 1L, 0L) AS marked",
        )
        .groupBy("month")
        .agg({"one": "sum", "marked": "sum"})
    )
    return monthly.selectExpr(
        "cast(substr(month, 1, 4) AS bigint) * 12 + cast(substr(month, 6, 2) AS bigint) AS run_id",
        "concat(month, '-01T00:00:00Z') AS started_at",
        "concat(month, '-01T00:01:00Z') AS finished_at",
        "if(`sum(marked)` = 0, 'failed', 'success') AS status",
        "`sum(one)` AS rows_extracted",
        "`sum(one)` AS rows_loaded",
        "cast(NULL AS string) AS message",
    )


def performance_facts(t: Trade) -> DataFrame:
    """One row per keyword and year, the fact the mart is built on."""
    yearly = (
        t.lineitem.selectExpr(
            "l_partkey AS keyword_id",
            "year(l_shipdate) AS year",
            "l_quantity",
            f"{CLICKS} AS clicks",
            f"{IMPRESSIONS} AS impressions",
        )
        .groupBy("keyword_id", "year")
        .agg({"l_quantity": "min", "clicks": "sum", "impressions": "sum"})
    )
    parts = t.part.selectExpr("p_partkey AS keyword_id", f"{VOLUME} AS volume", "p_size * 2 AS difficulty")
    return yearly.join(parts, "keyword_id").selectExpr(
        "keyword_id * 10000 + year AS fact_id",
        "cast(year AS bigint) * 10000 + 1231 AS date_id",
        "keyword_id",
        "volume AS search_volume",
        "difficulty AS keyword_difficulty",
        "cast(`min(l_quantity)` AS int) AS current_position",
        "CASE WHEN `sum(impressions)` <> 0 THEN `sum(clicks)` / `sum(impressions)` END AS estimated_ctr",
        "`sum(clicks)` AS estimated_traffic",
    )


def star(spark: SparkSession, folder: str) -> Derived:
    """All tables of the star schema."""
    t = Trade(spark, folder)
    makers = {
        "dim_site": sites,
        "dim_keyword": keywords,
        "dim_page": pages,
        "fact_keyword_position": positions,
        "fact_technical_issue": issues,
        "fact_backlink": backlinks,
        "snapshot_calendar": snapshot_calendar,
        "etl_run_log": run_log,
    }
    return Derived({name: partial(make, t) for name, make in makers.items()})


def performance(spark: SparkSession, folder: str) -> Derived:
    """The older star: its fact and its keyword dimension."""
    t = Trade(spark, folder)
    texts = ("keyword_id", "keyword AS keyword_text", "search_intent", "category")
    return Derived(
        {
            "fact_keyword_performance": partial(performance_facts, t),
            "dim_keyword": lambda: keywords(t).selectExpr(*texts),
        }
    )


# --- Raw exports, with the faults the contracts look for ------------------------------------------


def raw_keywords(t: Trade) -> DataFrame:
    """A row per part: few distinct keywords with many copies, odd spacing and case, bad numbers."""
    return t.part.selectExpr(
        "if(p_size = 50, '   ', concat('  ', p_type, ' ', lower(p_name), ' ')) AS keyword",
        f"CASE WHEN p_type <> 'SMALL' THEN {CATEGORY} WHEN p_size < 10 THEN '' ELSE 'otros' END AS category",
        f"concat(' ', {INTENT}) AS search_intent",
        "CASE WHEN p_retailprice < 902 THEN 'n/a' WHEN p_retailprice >= 999 THEN ''"
        " ELSE cast(cast(round((p_retailprice - 9.05e2) * 3e2) AS bigint) AS string) END AS monthly_search_volume",
        "cast(p_size * 2 + 3 AS string) AS keyword_difficulty",
        "'part' AS src_feed",
        "p_partkey AS src_key",
    )


def raw_pages(t: Trade) -> DataFrame:
    """Pages of three crawls: shop pages, section pages with many copies, and web pages, of which those
    of plain http have no proper speed score."""
    shop = t.supplier.selectExpr(
        f"concat(' ', {SHOP_URL}, '  ') AS url",
        "s_name AS title",
        "lower(s_name) AS h1",
        "cast(cast(floor(s_acctbal) AS bigint) AS string) AS word_count",
        "if(s_acctbal < 1000, '', '1') AS indexable",
        "cast(cast(floor(abs(s_acctbal) / 9e1) AS bigint) AS string) AS page_speed_score",
        "'a shop' AS src_feed",
        "s_suppkey AS src_key",
    )
    section = t.customer.selectExpr(
        f"concat(if(c_mktsegment = 'FURNITURE', 'ftp://', 'https://'), {SECTION_URL}) AS url",
        "c_mktsegment AS title",
        "cast(NULL AS string) AS h1",
        "cast(cast(floor(c_acctbal) AS bigint) AS string) AS word_count",
        "'1' AS indexable",
        "'' AS page_speed_score",
        "'b section' AS src_feed",
        "c_custkey AS src_key",
    )
    web = t.pages.selectExpr(
        "url",
        f"{TITLE} AS title",
        f"{HEADING} AS h1",
        f"cast({WORDS} AS string) AS word_count",
        "'0' AS indexable",
        "if(startswith(url, 'https'), '', 'many') AS page_speed_score",
        "'c web' AS src_feed",
        "page_id AS src_key",
    )
    return shop.union(section).union(web)


def _named_shipments(t: Trade, keyword: str) -> DataFrame:
    """Shipments with keyword text, and what their URL is made of, beside the keys."""
    parts = t.part.selectExpr("p_partkey AS l_partkey", f"{keyword} AS keyword")
    suppliers = t.supplier.selectExpr("s_suppkey AS l_suppkey", "s_suppkey", "s_nationkey")
    return t.lineitem.join(parts, "l_partkey").join(suppliers, "l_suppkey")


_SHIPMENT_ORDER = (
    "l_orderkey AS src_order",
    "l_linenumber AS src_line",
    "l_partkey AS src_part",
    "l_suppkey AS src_supplier",
    "l_extendedprice AS src_price",
)


def raw_positions(t: Trade, in_order: bool = False) -> DataFrame:
    """A row per shipment, named by keyword text and URL; if asked for, in ``POSITION_ORDER``.

    Shipments are put in order before texts are made of them, as their numbers are narrower.
    """
    named = _named_shipments(t, "concat(p_type, ' ', upper(p_name), ' ')")
    if in_order:
        named = named.orderBy(*[column.split(" AS ")[0] for column in _SHIPMENT_ORDER])
    return named.selectExpr(
        "keyword",
        f"concat({SHOP_URL}, ' ') AS url",
        f"if(l_linenumber = 7 AND l_returnflag = 'N', ' ', {SNAPSHOT_DATE}) AS snapshot_date",
        "if(l_quantity = 50, 'x', cast(cast(l_quantity AS int) - 2 AS string)) AS position",
        "if(l_linenumber = 1, '', cast(l_linenumber * 5 AS string)) AS previous_position",
        f"cast({CLICKS} - 20 AS string) AS clicks_30d",
        "cast(cast(floor(l_extendedprice / 2e2) AS bigint) AS string) AS impressions_30d",
        *_SHIPMENT_ORDER,
    )


# --- State before a load, and typed staging tables ------------------------------------------------


def stored_keywords(t: Trade) -> DataFrame:
    """Keywords already known: those shipped before the first date."""
    early = t.lineitem.filter(f"l_shipdate < timestamp_ntz'{FIRST_DATE}'").selectExpr("l_partkey AS keyword_id")
    return keywords(t).join(early.distinct(), "keyword_id", "left_semi")


def staging_keywords(t: Trade) -> DataFrame:
    """All keywords in upper case, some without category, intent or numbers."""
    return t.part.selectExpr(
        f"concat(' ', upper({KEYWORD})) AS keyword",
        f"CASE WHEN p_type = 'SMALL' THEN '  ' WHEN p_type <> 'LARGE' THEN {CATEGORY} END AS category",
        f"CASE WHEN p_type <> 'LARGE' THEN {INTENT} END AS search_intent",
        f"CASE WHEN p_size > 5 THEN {VOLUME} END AS monthly_search_volume",
        "CASE WHEN p_size < 45 THEN p_size * 2 END AS keyword_difficulty",
        "p_partkey AS src_key",
    )


def staging_pages(t: Trade) -> DataFrame:
    """A later crawl: known shop pages with gaps, section pages and web pages that are new."""
    shop = t.supplier.selectExpr(
        f"concat({SHOP_URL}, ' ') AS url",
        "CASE WHEN s_acctbal >= 2000 THEN concat('New ', s_name) END AS title",
        "CASE WHEN s_acctbal >= 4000 THEN s_name END AS h1",
        "CASE WHEN s_acctbal >= 3000 THEN cast(floor(s_acctbal / 2e0) AS int) END AS word_count",
        "CASE WHEN s_acctbal >= 6000 THEN 0 END AS indexable",
        "CASE WHEN s_acctbal >= 5000 THEN cast(floor(s_acctbal / 1e2) AS int) END AS page_speed_score",
        "CASE WHEN s_acctbal >= 1000 THEN '2002-01-07T08:00:00Z' END AS loaded_at",
        "'a shop' AS src_feed",
        "s_suppkey AS src_key",
    )
    section = t.customer.selectExpr(
        f"concat('https://', {SECTION_URL}) AS url",
        "concat(' ', c_mktsegment) AS title",
        "cast(NULL AS string) AS h1",
        "CASE WHEN c_acctbal >= 0 THEN cast(floor(c_acctbal) AS int) END AS word_count",
        "cast(NULL AS int) AS indexable",
        "cast(NULL AS int) AS page_speed_score",
        "CASE WHEN c_acctbal >= 5000 THEN '2002-01-08T08:00:00Z'"
        " WHEN c_acctbal >= 0 THEN '2002-01-07T08:00:00Z' END AS loaded_at",
        "'b section' AS src_feed",
        "c_custkey AS src_key",
    )
    web = t.pages.selectExpr(
        "url",
        f"{TITLE} AS title",
        f"{HEADING} AS h1",
        f"{WORDS} AS word_count",
        "1 AS indexable",
        "cast(NULL AS int) AS page_speed_score",
        "'2002-01-07T09:00:00Z' AS loaded_at",
        "'c web' AS src_feed",
        "page_id AS src_key",
    )
    return shop.union(section).union(web)


def stored_positions(t: Trade) -> DataFrame:
    return positions(t).filter(f"snapshot_date <= '{CUT_DATE}'")


def staging_positions(t: Trade) -> DataFrame:
    """Shipments since the overlap date by keyword text and URL, many of them copies of a key."""
    return (
        _named_shipments(t, f"upper({KEYWORD})")
        .filter(f"{SNAPSHOT_DATE} >= '{OVERLAP_DATE}'")
        .selectExpr(
            "keyword",
            f"concat({SHOP_URL}, ' ') AS url",
            f"{SNAPSHOT_DATE} AS snapshot_date",
            "CASE WHEN l_quantity < 46 THEN cast(l_quantity AS int) END AS position",
            *_SHIPMENT_ORDER,
        )
    )
