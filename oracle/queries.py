"""One statement per registered query."""

from __future__ import annotations

from oracle.tables import half_up, strip, with_tables

IMPACT = "least(1e1, 1e0 + log10(greatest(CAST(monthly_search_volume AS double), 1e0)) / log10(1e5) * 9e0)"
CONFIDENCE = "((100 - keyword_difficulty) / 1e2 * 9e0 + 1e0)"
EASE = "greatest(1e0, (31 - position) / 3e1 * 9e0 + 1e0)"
SCORE = f"({IMPACT} * {CONFIDENCE} * {EASE} / 1e2)"
BENCHMARK = """CASE WHEN position <= 1 THEN 28e0 WHEN position <= 3 THEN 15e0 WHEN position <= 5 THEN 8e0
  WHEN position <= 10 THEN 4e0 ELSE 15e-1 END"""

QUICK_WINS = f"""
SELECT keyword_id, keyword, category, page_id, url, domain, snapshot_date, position, previous_position,
  previous_position - position AS position_delta, monthly_search_volume, keyword_difficulty, clicks_30d,
  impressions_30d, {half_up(IMPACT)} AS impact_score, {half_up(CONFIDENCE)} AS confidence_score,
  {half_up(EASE)} AS ease_score, {half_up(SCORE)} AS ice_score,
  CASE WHEN {SCORE} >= 7 THEN 'P1 - Critical' WHEN {SCORE} >= 4 THEN 'P2 - High'
       WHEN {SCORE} >= 2 THEN 'P3 - Medium' ELSE 'P4 - Low' END AS priority_tier
FROM fact_keyword_position f JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
JOIN dim_site USING (site_id)
WHERE position BETWEEN 4 AND 30
  AND snapshot_date = (SELECT max(g.snapshot_date) FROM fact_keyword_position g
                       WHERE g.keyword_id = f.keyword_id AND g.page_id = f.page_id)"""

POSITION_CHANGES = """
SELECT domain, keyword, category, url, snapshot_date, position, previous_position,
  previous_position - position AS position_delta,
  CASE WHEN previous_position IS NULL THEN 'new' WHEN position < previous_position THEN 'improved'
       WHEN position > previous_position THEN 'declined' ELSE 'stable' END AS trend, clicks_30d, impressions_30d
FROM fact_keyword_position JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
JOIN dim_site USING (site_id)"""

EXECUTIVE_SUMMARY = """
SELECT domain, coalesce(n_pages, 0) AS n_pages, coalesce(n_keywords, 0) AS n_keywords,
  coalesce(top3, 0) AS keywords_top3, coalesce(top10, 0) AS keywords_top10, clicks AS total_clicks_30d,
  impressions AS total_impressions_30d, coalesce(n_issues, 0) AS open_issues, coalesce(risk, 0) AS traffic_at_risk
FROM dim_site
LEFT JOIN (SELECT site_id, count(*) AS n_pages FROM dim_page GROUP BY site_id) USING (site_id)
LEFT JOIN (SELECT site_id, len(list_distinct(list(keyword_id))) AS n_keywords,
             count_if(position IN (1, 2, 3)) AS top3, count_if(position > 3 AND position < 11) AS top10,
             CAST(sum(clicks_30d) AS bigint) AS clicks, CAST(sum(impressions_30d) AS bigint) AS impressions
           FROM fact_keyword_position SEMI JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
           GROUP BY site_id) USING (site_id)
LEFT JOIN (SELECT site_id, count(*) AS n_issues, CAST(sum(traffic_at_risk) AS bigint) AS risk
           FROM active_issue GROUP BY site_id) USING (site_id)"""

NEW_PAGES = f"""
SELECT (SELECT max(page_id) FROM dim_page) + row_number() OVER (ORDER BY url) AS page_id,
  coalesce((SELECT max_by(site_id, length(domain)) FROM dim_site
            WHERE '.' || lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) LIKE '%.' || domain), 1)
    AS site_id,
  url, title, CAST(NULL AS varchar) AS meta_description, h1, coalesce(word_count, 0) AS word_count,
  coalesce(indexable, 1) AS indexable, page_speed_score, coalesce(substr(loaded_at, 1, 10), '2002-01-31')
    AS last_crawled_at
FROM staging_pages WHERE url NOT IN (SELECT url FROM dim_page)"""

NOINDEX = """
SELECT (SELECT max(issue_id) FROM fact_technical_issue) + row_number() OVER (ORDER BY page_id) AS issue_id, site_id,
  page_id, 'noindex' AS issue_type, 'critical' AS severity, CAST(0 AS bigint) AS traffic_at_risk,
  '2002-01-31' AS detected_at, CAST(NULL AS varchar) AS resolved_at, 'open' AS status
FROM (SELECT page_id FROM dim_page WHERE indexable = 0
      INTERSECT SELECT page_id FROM fact_keyword_position WHERE position > 0
      EXCEPT SELECT page_id FROM active_issue WHERE issue_type = 'noindex')
JOIN dim_page USING (page_id)"""


def decay_rule(silenced_by: str) -> str:
    return f"""
SELECT (SELECT max(issue_id) FROM fact_technical_issue)
    + row_number() OVER (ORDER BY page_id, keyword_id, snapshot_date) AS issue_id,
  site_id, page_id, 'content_decay' AS issue_type,
  CASE WHEN position - previous_position >= 8 THEN 'high' ELSE 'medium' END AS severity,
  CAST(0 AS bigint) AS traffic_at_risk, '{RUN_DAY}' AS detected_at, CAST(NULL AS varchar) AS resolved_at,
  'open' AS status
FROM (SELECT * FROM fact_keyword_position WHERE position BETWEEN 1 AND 50 AND position >= previous_position + 5)
JOIN dim_page USING (page_id)
ANTI JOIN (SELECT * FROM fact_technical_issue WHERE issue_type = 'content_decay' AND {silenced_by}) USING (page_id)"""


# An error day of the events, so that the "detected today" suppression finds something.
RUN_DAY = "2024-01-15"


def check(name: str, bad: str, table: str) -> str:
    """A report row of a rule on rows."""
    return verdict(name, f"(SELECT count(*) FROM {table} WHERE {bad})")


def verdict(name: str, violations: str) -> str:
    return f"""SELECT '{name}' AS "check", CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(v AS bigint) AS violations FROM (SELECT {violations} AS v)"""


def not_empty(table: str) -> str:
    return verdict(f"{table} not empty", f"(SELECT 1 - least(count(*), 1) FROM {table})")


def unique(table: str, *columns: str) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    keys = ", ".join(columns)
    return verdict(
        f"{table}.{'+'.join(columns)} unique",
        f"(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {complete} GROUP BY {keys} HAVING count(*) > 1))",
    )


def parent(table: str, key: str, parents: str) -> str:
    return check(
        f"{table}.{key} has parent", f"{key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parents})", table
    )


def required(table: str, *columns: str) -> list[str]:
    return [check(f"{table}.{c} not null", f"{c} IS NULL", table) for c in columns]


def accepted(table: str, column: str, values: str) -> str:
    return check(f"{table}.{column} in accepted values", f"{column} NOT IN ({values})", table)


def ranged(table: str, column: str, bad: str) -> str:
    return check(f"{table}.{column} in range", bad, table)


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


LOAD_CHECKS = union(
    [
        not_empty("dim_keyword"),
        not_empty("dim_page"),
        check("fact_keyword_position.ctr_30d at most 1", "ctr_30d > 1", "fact_keyword_position"),
        accepted("dim_page", "indexable", "0, 1"),
        parent("fact_keyword_position", "keyword_id", "dim_keyword"),
    ]
)

CONSTRAINT_CHECKS = union(
    [
        *required("dim_site", "site_id", "domain", "site_name", "language", "country", "is_active"),
        accepted("dim_site", "is_active", "0, 1"),
        unique("dim_site", "site_id"),
        unique("dim_site", "domain"),
        *required("dim_keyword", "keyword_id", "keyword", "category", "search_intent", "monthly_search_volume",
                  "keyword_difficulty"),
        ranged("dim_keyword", "monthly_search_volume", "monthly_search_volume < 0"),
        ranged("dim_keyword", "keyword_difficulty", "keyword_difficulty < 0 OR keyword_difficulty > 100"),
        unique("dim_keyword", "keyword_id"),
        unique("dim_keyword", "keyword"),
        *required("dim_page", "page_id", "site_id", "url", "indexable"),
        accepted("dim_page", "indexable", "0, 1"),
        ranged("dim_page", "page_speed_score", "page_speed_score < 0 OR page_speed_score > 100"),
        unique("dim_page", "page_id"),
        unique("dim_page", "url"),
        parent("dim_page", "site_id", "dim_site"),
        *required("fact_keyword_position", "position_id", "keyword_id", "page_id", "snapshot_date", "position",
                  "clicks_30d", "impressions_30d"),
        ranged("fact_keyword_position", "position", "position < 0"),
        unique("fact_keyword_position", "position_id"),
        unique("fact_keyword_position", "keyword_id", "page_id", "snapshot_date"),
        parent("fact_keyword_position", "keyword_id", "dim_keyword"),
        parent("fact_keyword_position", "page_id", "dim_page"),
        *required("fact_technical_issue", "issue_id", "site_id", "issue_type", "severity", "traffic_at_risk",
                  "detected_at", "status"),
        accepted("fact_technical_issue", "severity", "'critical', 'high', 'medium', 'low'"),
        accepted("fact_technical_issue", "status", "'open', 'in_progress', 'resolved', 'wont_fix'"),
        unique("fact_technical_issue", "issue_id"),
        parent("fact_technical_issue", "site_id", "dim_site"),
        parent("fact_technical_issue", "page_id", "dim_page"),
        *required("fact_backlink", "backlink_id", "page_id", "referring_domain"),
        ranged("fact_backlink", "domain_authority", "domain_authority < 0 OR domain_authority > 100"),
        unique("fact_backlink", "backlink_id"),
        unique("fact_backlink", "page_id", "referring_domain"),
        parent("fact_backlink", "page_id", "dim_page"),
        *required("etl_run_log", "run_id", "started_at", "status"),
        accepted("etl_run_log", "status", "'running', 'success', 'failed'"),
        unique("etl_run_log", "run_id"),
    ]
)


def quarantine(entity: str, key: str, table: str) -> str:
    return f"SELECT '{entity}' AS entity, {key} AS key, errors FROM {table} WHERE errors <> ''"


BODIES = {
    "quick_wins": QUICK_WINS,
    "quick_wins_top10": f"""
SELECT keyword, url, position, previous_position, position_delta, monthly_search_volume, ice_score AS ice,
  priority_tier
FROM ({QUICK_WINS}) q ORDER BY ice_score DESC, keyword_id, page_id LIMIT 10""",
    "p1_backlog": f"""
SELECT keyword, url, ice_score FROM ({QUICK_WINS}) q WHERE priority_tier = 'P1 - Critical'""",
    "position_changes": POSITION_CHANGES,
    "category_summary": f"""
SELECT domain, category, count(DISTINCT keyword_id) AS n_keywords,
  {half_up('avg(nullif(position, 0))')} AS avg_position,
  CAST(sum(clicks_30d) AS bigint) AS total_clicks_30d, CAST(sum(impressions_30d) AS bigint) AS total_impressions_30d,
  {half_up('CASE WHEN sum(impressions_30d) > 0 THEN CAST(sum(clicks_30d) AS double) / sum(impressions_30d) ELSE 0 END', 4)}
    AS avg_ctr
FROM latest JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id) JOIN dim_site USING (site_id)
GROUP BY domain, category""",
    "indexation_health": """
SELECT domain, page_id, url, indexable, page_speed_score, coalesce(n, 0) AS open_issues,
  coalesce(risk, 0) AS traffic_at_risk
FROM dim_page JOIN dim_site USING (site_id)
LEFT JOIN (SELECT page_id, count(*) AS n, CAST(sum(traffic_at_risk) AS bigint) AS risk FROM active_issue
           GROUP BY page_id) USING (page_id)""",
    "backlink_gaps": f"""
SELECT page_id, domain, url, n_keywords AS n_keywords_ranking, coalesce(n_domains, 0) AS n_referring_domains,
  {half_up('mean_position')} AS avg_position, coalesce({half_up('mean_authority', 1)}, 0) AS avg_domain_authority
FROM dim_page JOIN dim_site USING (site_id)
JOIN (SELECT page_id, count(DISTINCT keyword_id) AS n_keywords, avg(position) AS mean_position
      FROM fact_keyword_position SEMI JOIN dim_keyword USING (keyword_id) WHERE position > 0
      GROUP BY page_id) USING (page_id)
LEFT JOIN (SELECT page_id, count(DISTINCT referring_domain) AS n_domains, avg(domain_authority) AS mean_authority
           FROM fact_backlink GROUP BY page_id) USING (page_id)""",
    "executive_summary": EXECUTIVE_SUMMARY,
    "almost_winning": """
SELECT keyword, url, position, monthly_search_volume, clicks_30d, impressions_30d
FROM latest JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
WHERE position BETWEEN 4 AND 10 AND monthly_search_volume >= 2000""",
    "decay": """
SELECT keyword, url, previous_position AS pos_antes, position AS pos_ahora, position - previous_position AS caida,
  monthly_search_volume
FROM latest JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
WHERE position - previous_position >= 3""",
    "issue_impact": """
SELECT issue_type, severity, count(*) AS n_issues, CAST(sum(traffic_at_risk) AS bigint) AS trafico_en_riesgo
FROM active_issue GROUP BY issue_type, severity""",
    "noindex_impressions": """
SELECT url, indexable, impresiones_30d, clicks_30d, keywords_asociadas
FROM (SELECT page_id, CAST(sum(impressions_30d) AS bigint) AS impresiones_30d,
        CAST(sum(clicks_30d) AS bigint) AS clicks_30d, len(list_distinct(list(keyword_id))) AS keywords_asociadas
      FROM fact_keyword_position SEMI JOIN dim_keyword USING (keyword_id) GROUP BY page_id)
JOIN dim_page USING (page_id)
WHERE indexable = 0 AND impresiones_30d > 0""",
    "cannibalization": """
SELECT keyword, url, n_paginas_compitiendo
FROM latest JOIN (SELECT keyword_id, count(DISTINCT page_id) AS n_paginas_compitiendo FROM latest WHERE position > 0
                  GROUP BY keyword_id HAVING count(DISTINCT page_id) > 1) USING (keyword_id)
  JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
WHERE position > 0""",
    "ctr_below_benchmark": f"""
SELECT keyword, url, position, impressions_30d, {half_up('ctr_30d * 100')} AS ctr_pct,
  {BENCHMARK} AS ctr_benchmark_pct
FROM latest JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
WHERE impressions_30d > 500 AND ctr_30d * 100 < {BENCHMARK}""",
    "ranking_without_backlinks": """
SELECT keyword, url, position, keyword_difficulty, CAST(0 AS bigint) AS backlinks
FROM latest ANTI JOIN fact_backlink USING (page_id) JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)
WHERE position >= 5 AND position <= 20""",
    "clicks_trend": f"""
SELECT domain, snapshot_date, CAST(sum(clicks_30d) AS bigint) AS clicks_30d,
  CAST(sum(impressions_30d) AS bigint) AS impressions_30d,
  {half_up('CASE WHEN sum(impressions_30d) > 0 THEN CAST(sum(clicks_30d) AS double) * 1e2 / sum(impressions_30d) ELSE 0 END')}
    AS ctr_pct
FROM fact_keyword_position JOIN dim_page USING (page_id) JOIN dim_site USING (site_id)
GROUP BY domain, snapshot_date""",
    "executive_report": EXECUTIVE_SUMMARY,
    "page_health": f"""
SELECT url, page_speed_score, coalesce(n, 0) AS keywords_posicionadas, {half_up('score', 1)} AS score_posiciones,
  {half_up('score * 5e-1 + coalesce(page_speed_score, 0) * 3e-1 + (100 - least(coalesce(penalty, 0), 100)) * 2e-1', 1)}
    AS health_score
FROM dim_page
LEFT JOIN (SELECT page_id, count(DISTINCT keyword_id) AS n,
             avg(1e2 - 1e1 * (least(position, 10) - 1)) FILTER (WHERE position <> 0) AS score
           FROM fact_keyword_position SEMI JOIN dim_keyword USING (keyword_id) GROUP BY page_id) USING (page_id)
LEFT JOIN (SELECT page_id, 20 * count(*) AS penalty FROM active_issue GROUP BY page_id) USING (page_id)""",
    "table_counts": union(
        [
            f"SELECT '{t}' AS tabla, count(*) AS filas FROM {t}"
            for t in ("dim_keyword", "dim_page", "fact_keyword_position", "fact_technical_issue", "etl_run_log")
        ]
    ),
    "stage_performance": """
SELECT fact_id, date_id, keyword_id, search_volume, keyword_difficulty, current_position, estimated_ctr,
  estimated_traffic
FROM fact_keyword_performance""",
    "mart_quick_wins": "SELECT * FROM mart",
    "mart_class_summary": """
SELECT classification, count(*) AS n, CAST(sum(prioridad_score) AS bigint) AS prioridad_total
FROM mart GROUP BY classification""",
    "contract_keywords": """
SELECT keyword, category, search_intent, monthly_search_volume, keyword_difficulty FROM valid_keywords""",
    "contract_pages": """
SELECT url, title, h1, word_count, indexable, page_speed_score FROM valid_pages""",
    "contract_positions": """
SELECT keyword, url, snapshot_date, position, previous_position, clicks_30d, impressions_30d,
  CASE WHEN impressions_30d <> 0 THEN CAST(clicks_30d AS double) / impressions_30d END AS ctr_30d
FROM valid_positions""",
    "quarantine_report": union(
        [
            quarantine("keywords", "keyword", "checked_keywords"),
            quarantine("pages", "url", "checked_pages"),
            quarantine("positions", "keyword || ' @ ' || url", "marked_positions"),
        ]
    ),
    "orphan_positions": """
SELECT keyword, url, snapshot_date, errors FROM marked_positions WHERE errors LIKE 'orphan%'""",
    "dedupe_positions": """
SELECT keyword, url, snapshot_date, position, clicks_30d, impressions_30d FROM (
  SELECT *, row_number() OVER (PARTITION BY keyword, url, snapshot_date
              ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS copy
  FROM checked_positions WHERE errors = '')
WHERE copy = 1""",
    "read_positions_export": """
SELECT keyword, url, snapshot_date, position, previous_position, clicks_30d, impressions_30d, 'batch-1' AS load_id
FROM raw_positions""",
    "copy_tables": union(
        [
            f"SELECT '{t}.parquet' AS \"table\", count(*) AS source_rows, count(*) AS target_rows, true AS equal FROM {t}"
            for t in (
                "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                "embeddings", "pages", "benchmark", "labels", "conversations",
            )
        ]
    ),
    "upsert_keywords": f"""
SELECT keyword_id, keyword, category, search_intent, monthly_search_volume, keyword_difficulty, current_url_target
FROM stored_keywords
UNION ALL
SELECT (SELECT max(keyword_id) FROM stored_keywords) + row_number() OVER (ORDER BY keyword), keyword,
  CASE WHEN p_type = 'SMALL' THEN 'informativo' ELSE category END,
  CASE WHEN p_type = 'LARGE' THEN 'informational' ELSE search_intent END,
  CASE WHEN p_size > 5 THEN monthly_search_volume ELSE 0 END, CASE WHEN p_size < 45 THEN p_size * 2 ELSE 50 END, NULL
FROM dim_keyword JOIN part ON p_partkey = keyword_id
WHERE keyword NOT IN (SELECT keyword FROM stored_keywords)""",
    "upsert_pages": f"""
SELECT page_id, site_id, url, coalesce(s.title, p.title) AS title, meta_description, coalesce(s.h1, p.h1) AS h1,
  coalesce(s.word_count, p.word_count) AS word_count, coalesce(s.indexable, p.indexable) AS indexable,
  coalesce(s.page_speed_score, p.page_speed_score) AS page_speed_score,
  coalesce(substr(loaded_at, 1, 10), p.last_crawled_at) AS last_crawled_at
FROM dim_page p LEFT JOIN staging_pages s USING (url)
UNION ALL
{NEW_PAGES}""",
    "upsert_pages_overwrite": f"""
SELECT page_id, site_id, p.url, CASE WHEN s.url IS NULL THEN p.title ELSE s.title END AS title, meta_description,
  CASE WHEN s.url IS NULL THEN p.h1 ELSE s.h1 END AS h1,
  CASE WHEN s.url IS NULL THEN p.word_count ELSE s.word_count END AS word_count,
  CASE WHEN s.url IS NULL THEN p.indexable ELSE s.indexable END AS indexable,
  CASE WHEN s.url IS NULL THEN p.page_speed_score ELSE s.page_speed_score END AS page_speed_score, last_crawled_at
FROM dim_page p LEFT JOIN staging_pages s ON s.url = p.url
UNION ALL
{NEW_PAGES}""",
    "asof_previous_position": """
SELECT keyword_id, page_id, snapshot_date, position, previous_position FROM fresh_positions""",
    "insert_positions": """
SELECT (SELECT max(position_id) FROM stored_positions) + row_number() OVER (ORDER BY keyword, url, snapshot_date)
    AS position_id, keyword_id, page_id, snapshot_date, position, previous_position, CAST(0 AS bigint) AS clicks_30d,
  CAST(0 AS bigint) AS impressions_30d, CAST(NULL AS double) AS ctr_30d
FROM fresh_positions JOIN dim_keyword USING (keyword_id) JOIN dim_page USING (page_id)""",
    "surrogate_keys": """
SELECT row_number() OVER (ORDER BY snapshot_date, keyword_id, page_id) AS row_id, snapshot_date, keyword_id, page_id
FROM yearly""",
    "rule_noindex": NOINDEX,
    "rule_decay": decay_rule("status IN ('open', 'in_progress')"),
    "rule_decay_today": decay_rule(f"detected_at = '{RUN_DAY}'"),
    "batch_load": """
SELECT 'dim_keyword' AS tabla, count(*) AS filas FROM valid_keywords
UNION ALL
SELECT 'dim_page', count(*) FROM valid_pages
UNION ALL
SELECT 'fact_keyword_position', count(*) FROM valid_positions
UNION ALL
SELECT 'fact_technical_issue', (SELECT count(DISTINCT url) FROM valid_positions JOIN valid_pages USING (url)
                                WHERE indexable = 0 AND position > 0)
  + (SELECT count(*) FROM valid_positions WHERE position > 0 AND position - previous_position >= 5)
UNION ALL
SELECT 'etl_run_log', 1""",
    "read_keywords_export": """
SELECT keyword, category, search_intent, monthly_search_volume, keyword_difficulty, 'batch-1' AS load_id
FROM raw_keywords""",
    "read_pages_export": """
SELECT url, title, coalesce(h1, '') AS h1, word_count, indexable, page_speed_score, 'batch-1' AS load_id
FROM raw_pages""",
    "quarantine_without_pages": f"""
{quarantine("keywords", "keyword", "checked_keywords")}
UNION ALL
SELECT 'positions', keyword || ' @ ' || url, CASE WHEN errors <> '' THEN errors
  WHEN keyword NOT IN (SELECT keyword FROM valid_keywords) THEN 'orphan, unknown keyword: ' || keyword
  ELSE 'orphan, unknown URL: ' || url END
FROM checked_positions""",
    "loaded_sites": """
SELECT * FROM (VALUES (CAST(1 AS bigint), 'tienda-demo.com', 'Tienda Demo', 'es', 'ES', 1),
  (2, 'blog-demo.com', 'Blog Demo', 'es', 'MX', 1)) s(site_id, domain, site_name, language, country, is_active)""",
    "loaded_keywords": "SELECT * FROM loaded_keyword",
    "loaded_pages": "SELECT * REPLACE (coalesce(h1, '') AS h1) FROM loaded_page",
    "loaded_positions": "SELECT * FROM loaded_position",
    "loaded_issues": "SELECT * FROM loaded_issue",
    "loaded_run_log": """
SELECT run_id, 'success' AS status, extracted AS rows_extracted,
  CASE WHEN run_id = 1 THEN (SELECT count(*) FROM loaded_keyword) + (SELECT count(*) FROM loaded_page)
    + (SELECT count(*) FROM loaded_position) + (SELECT count(*) FROM loaded_issue) ELSE 0 END AS rows_loaded,
  'exports batch-' || run_id || '; rejected ' || rejected || ', failed checks 0' AS message, true AS ended
FROM (SELECT (SELECT count(*) FROM raw_keywords) + (SELECT count(*) FROM raw_pages)
        + (SELECT count(*) FROM raw_positions) AS extracted,
        (SELECT count(*) FROM checked_keywords WHERE errors <> '') + (SELECT count(*) FROM checked_pages WHERE errors <> '')
        + (SELECT count(*) FROM marked_positions WHERE errors <> '') AS rejected) c,
  (VALUES (CAST(1 AS bigint)), (2)) r(run_id)""",
    "loaded_top5": f"""
SELECT CAST(row_number() OVER (ORDER BY {half_up(SCORE)} DESC, keyword_id, page_id) AS int) AS place, keyword, url,
  position
FROM loaded_position f JOIN loaded_keyword USING (keyword_id) JOIN loaded_page USING (page_id)
WHERE position BETWEEN 4 AND 30
  AND snapshot_date = (SELECT max(g.snapshot_date) FROM loaded_position g
                       WHERE g.keyword_id = f.keyword_id AND g.page_id = f.page_id)
QUALIFY place <= 5""",
    "refreshed_counts": """
SELECT 'dim_keyword' AS "table", count(*) AS rows, count(*) AS greatest FROM loaded_keyword
UNION ALL SELECT 'dim_page', count(*), count(*) FROM loaded_page
UNION ALL SELECT 'fact_keyword_position', 0, NULL
UNION ALL SELECT 'etl_run_log', 1, 1""",
    "staged_load_keywords": """
SELECT new_id AS keyword_id, keyword, category, search_intent, monthly_search_volume, keyword_difficulty,
  CAST(NULL AS varchar) AS current_url_target
FROM staged_keyword""",
    "staged_load_pages": """
SELECT new_id AS page_id, CAST(1 AS bigint) AS site_id, url, title, CAST(NULL AS varchar) AS meta_description, h1,
  coalesce(word_count, 0) AS word_count, coalesce(indexable, 1) AS indexable, page_speed_score,
  coalesce(substr(loaded_at, 1, 10), '2002-01-31') AS last_crawled_at
FROM staged_page""",
    "staged_load_positions": """
SELECT *, CAST(0 AS bigint) AS clicks_30d, CAST(0 AS bigint) AS impressions_30d, CAST(NULL AS double) AS ctr_30d
FROM staged_fact""",
    "staged_load_issues": """
SELECT issue_id, CAST(1 AS bigint) AS site_id, page_id, issue_type, severity, CAST(0 AS bigint) AS traffic_at_risk,
  detected_at, CAST(NULL AS varchar) AS resolved_at, 'open' AS status
FROM staged_issue""",
    "mart_built": "SELECT * FROM mart",
    "quality_report": LOAD_CHECKS,
    "constraint_report": CONSTRAINT_CHECKS,
    "mart_report": union(
        [
            *required("mart", "keyword_id", "keyword_text", "oportunidad_mejora"),
            accepted("mart", "classification", "'🎯 QUICK WIN', '✅ YA POSICIONADO', '⚠️ NECESITA TRABAJO'"),
            unique("mart", "keyword_id", "date_id"),
        ]
    ),
    "freshness": verdict(
        "newest snapshot at most 8 days old",
        "(SELECT CASE WHEN date_diff('day', CAST(max(snapshot_date) AS date), DATE '2002-01-05') <= 8 THEN 0 ELSE 1 END"
        " FROM yearly)",
    ),
    "run_alerts": """
SELECT run_id, status, rows_extracted, reason FROM (
  SELECT r.run_id, status, rows_extracted, CASE WHEN status = 'failed' THEN 'run failed'
      WHEN rows_extracted < 5e-1 * (SELECT max_by(b.rows_extracted, b.run_id) FROM etl_run_log b
                                    WHERE b.status = 'success' AND b.run_id < r.run_id)
      THEN 'rows extracted fell' END AS reason
  FROM etl_run_log r)
WHERE reason IS NOT NULL""",
    "active_tier_limit": verdict(
        "at most 10 rows of P1 - Critical",
        f"(SELECT greatest(count(*) - 10, 0) FROM ({QUICK_WINS}) q WHERE priority_tier = 'P1 - Critical')",
    ),
    "drop_alerts": f"SELECT * FROM ({POSITION_CHANGES}) c WHERE position_delta <= -5",
}

ORACLE = {name: with_tables(body) for name, body in BODIES.items()}
