"""A small star schema whose results can be followed by hand.

Two sites, nine keywords, eight pages and one snapshot of twelve positions. It holds a page closed to indexing that
ranks, three pages that lost places (one of them already reported), two keywords that rank on two pages each, an issue
of a whole site, pages without backlinks, and a pair without an earlier position and one that lost its place altogether.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ranktide.schemas import STAR

T, C, I = "transaccional", "comercial", "informativo"
DAY = "2026-03-02"

SITES = [(1, "garden.test", "Garden Store", "en", "GB", 1), (2, "plants.test", "Plant Notes", "en", "IE", 1)]

# keyword, category, volume, difficulty
KEYWORDS = [
    (1, "clay pots", T, 2500, 20),
    (2, "raised beds", T, 9000, 35),
    (3, "tomato seeds", C, 12500, 55),
    (4, "when to prune roses", I, 7000, 15),
    (5, "garden hose", T, 31000, 70),
    (6, "compost bin", C, 4100, 44),
    (7, "winter fleece", T, 1600, 28),
    (8, "slug control", I, 18000, 33),
    (9, "lawn feed", C, 900, 62),
]

# site, path, words, indexable, speed
PAGES = [
    (1, 1, "/pots", 410, 1, 91),
    (2, 1, "/beds", 1550, 1, 54),
    (3, 1, "/seeds", 620, 1, 47),
    (4, 1, "/hoses", 250, 0, 38),
    (5, 1, "/fleece", 330, 1, 83),
    (6, 2, "/roses", 2600, 1, 69),
    (7, 2, "/slugs", 1900, 1, 88),
    (8, 2, "/archive", 90, 1, 29),
]

# keyword, page, position, previous, clicks, impressions, ctr
POSITIONS = [
    (1, 1, 4, 7, 150, 1000, 0.15),
    (2, 2, 12, 12, 40, 2000, 0.02),
    (3, 3, 8, 2, 120, 6000, 0.02),
    (4, 6, 1, 1, 900, 3000, 0.3),
    (5, 4, 22, None, 7, 700, 0.01),
    (6, 2, 31, 25, 3, 600, 0.005),
    (7, 5, 5, 11, 80, 400, 0.2),
    (8, 7, 6, 9, 500, 8000, 0.0625),
    (8, 6, 17, 15, 30, 1500, 0.02),
    (9, 8, 29, 13, 1, 1000, 0.001),
    (2, 1, 0, 44, 0, 100, 0.0),
    (1, 5, 13, 13, 2, 200, 0.01),
]

# site, page, type, severity, traffic at risk, detected, status
ISSUES = [
    (1, 4, "noindex", "critical", 1300, "2026-02-11", "open"),
    (1, 2, "slow_lcp", "medium", 250, "2026-02-20", "in_progress"),
    (2, 8, "content_decay", "high", 610, "2026-02-27", "open"),
    (2, 7, "title_too_long", "low", 40, "2026-01-30", "resolved"),
    (2, None, "sitemap_404", "high", 990, "2026-03-01", "open"),
    (1, 3, "canonical_conflict", "medium", 120, "2026-02-25", "open"),
    (1, 2, "canonical_conflict", "medium", 35, "2026-02-26", "open"),
]

# page, domain, authority
BACKLINKS = [(1, "p.example", 22), (2, "q.example", 47), (2, "r.example", 36), (6, "q.example", 71), (7, "s.example", 18)]

RUNS = [(1, "2026-03-03T06:00:00Z", "2026-03-03T06:00:20Z", "success", 29, 29, None)]


def url(page_id: int) -> str:
    _, site_id, path, *_ = PAGES[page_id - 1]
    return f"https://{SITES[site_id - 1][1]}{path}"


def sample_star(spark: SparkSession) -> dict:
    rows = {
        "dim_site": SITES,
        "dim_keyword": [(i, k, c, "any", v, d, None) for i, k, c, v, d in KEYWORDS],
        "dim_page": [
            (i, s, url(i), f"title {i}", f"about {i}", f"h1 {i}", w, x, speed, DAY) for i, s, _, w, x, speed in PAGES
        ],
        "fact_keyword_position": [
            (n, k, p, DAY, now, before, clicks, seen, ctr)
            for n, (k, p, now, before, clicks, seen, ctr) in enumerate(POSITIONS, 1)
        ],
        "fact_technical_issue": [
            (n, s, p, kind, severity, risk, day, None, status)
            for n, (s, p, kind, severity, risk, day, status) in enumerate(ISSUES, 1)
        ],
        "fact_backlink": [(n, p, d, a, "editorial", DAY) for n, (p, d, a) in enumerate(BACKLINKS, 1)],
        "etl_run_log": RUNS,
    }
    return {name: spark.createDataFrame(data, STAR[name].struct) for name, data in rows.items()}
