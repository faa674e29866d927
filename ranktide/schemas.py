"""Declared tables: columns, defaults, keys and rules.

Ids and counts that add up are ``bigint``; flags, positions and 0..100 measures are ``int``; dates are
ISO 8601 text, so text order is date order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG, INT, TEXT, REAL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

# Fixed values.
CATEGORIES = ("transaccional", "comercial", "informativo")
DEFAULT_CATEGORY = "informativo"
DEFAULT_INTENT = "informational"
DEFAULT_DIFFICULTY = 50
ACTIVE_STATUSES = ("open", "in_progress")
ISSUE_STATUSES = ("open", "in_progress", "resolved", "wont_fix")
SEVERITIES = ("critical", "high", "medium", "low")
RUN_STATUSES = ("running", "success", "failed")
DEFAULT_SITES = (
    (1, "tienda-demo.com", "Tienda Demo", "es", "ES", 1),
    (2, "blog-demo.com", "Blog Demo", "es", "MX", 1),
)


@dataclass(frozen=True)
class Table:
    """A table with its constraints. Spark enforces none of them; the quality checks test them."""

    columns: tuple[tuple[str, T.DataType], ...]
    key: str | None = None
    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    allowed: dict[str, tuple] = field(default_factory=dict)
    ranges: dict[str, tuple[int | None, int | None]] = field(default_factory=dict)
    parents: dict[str, str] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind, True) for name, kind in self.columns])

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]


DIM_SITE = Table(
    columns=(
        ("site_id", LONG), ("domain", TEXT), ("site_name", TEXT), ("language", TEXT), ("country", TEXT),
        ("is_active", INT),
    ),
    key="site_id",
    required=("domain", "site_name", "language", "country", "is_active"),
    unique=(("domain",),),
    allowed={"is_active": (0, 1)},
)

DIM_KEYWORD = Table(
    columns=(
        ("keyword_id", LONG), ("keyword", TEXT), ("category", TEXT), ("search_intent", TEXT),
        ("monthly_search_volume", LONG), ("keyword_difficulty", INT), ("current_url_target", TEXT),
    ),
    key="keyword_id",
    required=("keyword", "category", "search_intent", "monthly_search_volume", "keyword_difficulty"),
    unique=(("keyword",),),
    ranges={"monthly_search_volume": (0, None), "keyword_difficulty": (0, 100)},
)

DIM_PAGE = Table(
    columns=(
        ("page_id", LONG), ("site_id", LONG), ("url", TEXT), ("title", TEXT), ("meta_description", TEXT),
        ("h1", TEXT), ("word_count", INT), ("indexable", INT), ("page_speed_score", INT),
        ("last_crawled_at", TEXT),
    ),
    key="page_id",
    required=("site_id", "url", "indexable"),
    unique=(("url",),),
    allowed={"indexable": (0, 1)},
    ranges={"page_speed_score": (0, 100)},
    parents={"site_id": "dim_site"},
)

FACT_POSITION = Table(
    columns=(
        ("position_id", LONG), ("keyword_id", LONG), ("page_id", LONG), ("snapshot_date", TEXT),
        ("position", INT), ("previous_position", INT), ("clicks_30d", LONG), ("impressions_30d", LONG),
        ("ctr_30d", REAL),
    ),
    key="position_id",
    required=("keyword_id", "page_id", "snapshot_date", "position", "clicks_30d", "impressions_30d"),
    unique=(("keyword_id", "page_id", "snapshot_date"),),
    ranges={"position": (0, None)},
    parents={"keyword_id": "dim_keyword", "page_id": "dim_page"},
)

FACT_ISSUE = Table(
    columns=(
        ("issue_id", LONG), ("site_id", LONG), ("page_id", LONG), ("issue_type", TEXT), ("severity", TEXT),
        ("traffic_at_risk", LONG), ("detected_at", TEXT), ("resolved_at", TEXT), ("status", TEXT),
    ),
    key="issue_id",
    required=("site_id", "issue_type", "severity", "traffic_at_risk", "detected_at", "status"),
    allowed={"severity": SEVERITIES, "status": ISSUE_STATUSES},
    parents={"site_id": "dim_site", "page_id": "dim_page"},
)

FACT_BACKLINK = Table(
    columns=(
        ("backlink_id", LONG), ("page_id", LONG), ("referring_domain", TEXT), ("domain_authority", INT),
        ("link_type", TEXT), ("first_seen_at", TEXT),
    ),
    key="backlink_id",
    required=("page_id", "referring_domain"),
    unique=(("page_id", "referring_domain"),),
    ranges={"domain_authority": (0, 100)},
    parents={"page_id": "dim_page"},
)

RUN_LOG = Table(
    columns=(
        ("run_id", LONG), ("started_at", TEXT), ("finished_at", TEXT), ("status", TEXT),
        ("rows_extracted", LONG), ("rows_loaded", LONG), ("message", TEXT),
    ),
    key="run_id",
    required=("started_at", "status"),
    allowed={"status": RUN_STATUSES},
)

FACT_PERFORMANCE = Table(
    columns=(
        ("fact_id", LONG), ("date_id", LONG), ("keyword_id", LONG), ("search_volume", LONG),
        ("keyword_difficulty", INT), ("current_position", INT), ("estimated_ctr", REAL),
        ("estimated_traffic", LONG),
    ),
    key="fact_id",
)

STAR = {
    "dim_site": DIM_SITE,
    "dim_keyword": DIM_KEYWORD,
    "dim_page": DIM_PAGE,
    "fact_keyword_position": FACT_POSITION,
    "fact_technical_issue": FACT_ISSUE,
    "fact_backlink": FACT_BACKLINK,
    "etl_run_log": RUN_LOG,
}

# Raw exports, all text as read. The first column of each is required in the file.
EXPORT_COLUMNS = {
    "keywords": ("keyword", "category", "search_intent", "monthly_search_volume", "keyword_difficulty"),
    "pages": ("url", "title", "h1", "word_count", "indexable", "page_speed_score"),
    "positions": (
        "keyword", "url", "snapshot_date", "position", "previous_position", "clicks_30d", "impressions_30d",
    ),
}
EXPORT_REQUIRED = {"keywords": ("keyword",), "pages": ("url",), "positions": ("keyword", "url", "snapshot_date")}

# Where a row stood in its export: file, split within the file, row within the split.
SOURCE_ORDER = ("src_file", "src_block", "src_row")
