"""The star schema and raw exports over the trade tables, as common table expressions."""

from __future__ import annotations

import re

CATEGORY = """CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'transaccional'
       WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'comercial' ELSE 'informativo' END"""
INTENT = """CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'transactional'
       WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'commercial' ELSE 'informational' END"""
TEXT = "lower(p_type) || ' ' || lower(p_name) || ' ' || p_partkey"
VOLUME = "greatest(CAST(round((p_retailprice - 9e2) * 3e2) AS bigint), 0)"
SHOP_URL = "'https://nation_' || s_nationkey || '.example/p/' || s_suppkey"
SECTION = "'nation_' || c_nationkey || '.example/s/' || lower(c_mktsegment)"
DAY = "year(l_shipdate) || '-12-31'"
WORDS = r"len(regexp_extract_all(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[^ \t\r\n]+'))"
# White space stripped from texts; the data has no other than these.
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
INTEGER = "CASE WHEN regexp_full_match(trim({0}), '[+-]?[0-9]+') THEN TRY_CAST(trim({0}) AS bigint) END"


def strip(value: str) -> str:
    return STRIP.format(value)


def integer(value: str) -> str:
    return INTEGER.format(value)


def half_up(value: str, digits: int = 2) -> str:
    """Non-negative double rounded half up, as in the library."""
    return f"floor(({value}) * 1e{digits} + 5e-1) / 1e{digits}"


TABLES = {
    "dim_site": """
SELECT CAST(n_nationkey AS bigint) AS site_id, lower(n_name) || '.example' AS domain, n_name AS site_name,
  'es' AS language, 'R' || n_regionkey AS country, 1 AS is_active
FROM nation""",
    "dim_keyword": f"""
SELECT p_partkey AS keyword_id, {TEXT} AS keyword, {CATEGORY} AS category, {INTENT} AS search_intent,
  {VOLUME} AS monthly_search_volume, p_size * 2 AS keyword_difficulty,
  CAST(NULL AS varchar) AS current_url_target
FROM part""",
    "dim_page": f"""
SELECT s_suppkey AS page_id, CAST(s_nationkey AS bigint) AS site_id, {SHOP_URL} AS url, s_name AS title,
  CAST(NULL AS varchar) AS meta_description, lower(s_name) AS h1,
  CAST(floor(abs(s_acctbal)) AS int) AS word_count, CASE WHEN s_acctbal < 1000 THEN 0 ELSE 1 END AS indexable,
  CASE WHEN s_acctbal <= 9500 THEN CAST(floor(abs(s_acctbal) / 1e2) AS int) END AS page_speed_score,
  '2001-12-31' AS last_crawled_at
FROM supplier""",
    "yearly": f"""
SELECT l_partkey AS keyword_id, l_suppkey AS page_id, {DAY} AS snapshot_date,
  CASE WHEN min(l_quantity) >= 46 THEN 0 ELSE CAST(min(l_quantity) AS int) END AS position,
  CAST(sum(floor(l_extendedprice * l_discount / 1e1)) AS bigint) AS clicks_30d,
  CAST(sum(floor(l_extendedprice / 1e1)) AS bigint) AS impressions_30d
FROM lineitem GROUP BY ALL""",
    "fact_keyword_position": """
SELECT (keyword_id * 10000000 + page_id) * 10 + (CAST(substr(snapshot_date, 1, 4) AS bigint) - 1995) AS position_id,
  keyword_id, page_id, snapshot_date, position,
  lag(position) OVER (PARTITION BY keyword_id, page_id ORDER BY snapshot_date) AS previous_position,
  clicks_30d, impressions_30d,
  CASE WHEN impressions_30d <> 0 THEN CAST(clicks_30d AS double) / impressions_30d END AS ctr_30d
FROM yearly""",
    "latest": """
SELECT * FROM fact_keyword_position WHERE snapshot_date = (SELECT max(snapshot_date) FROM fact_keyword_position)""",
    "fact_technical_issue": """
SELECT event_id AS issue_id, coalesce(CAST(s_nationkey AS bigint), code % 25) AS site_id, s_suppkey AS page_id,
  CASE WHEN code < 40 AND event_type <> 'error' THEN event_type || '_drop'
       WHEN code < 20 THEN 'noindex' WHEN code < 40 THEN 'content_decay' WHEN code < 60 THEN 'slow_lcp'
       WHEN code < 80 THEN 'title_too_long' ELSE 'canonical_conflict' END AS issue_type,
  CASE WHEN value >= 100 THEN 'critical' WHEN value >= 50 THEN 'high' WHEN value >= 20 THEN 'medium'
       ELSE 'low' END AS severity,
  CAST(floor(value) AS bigint) AS traffic_at_risk, strftime(ts, '%Y-%m-%d') AS detected_at,
  CASE WHEN value >= 30 THEN strftime(ts, '%Y-%m-%d') END AS resolved_at,
  CASE WHEN value < 10 THEN 'open' WHEN value < 30 THEN 'in_progress' ELSE 'resolved' END AS status
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS code FROM events) e
LEFT JOIN supplier ON user_id = s_suppkey""",
    "active_issue": """
SELECT * FROM fact_technical_issue WHERE status IN ('open', 'in_progress')""",
    "fact_backlink": """
SELECT c_custkey * 10000000 + page AS backlink_id, page AS page_id,
  'ref' || c_custkey || '.example' AS referring_domain,
  least(greatest(CAST(floor((c_acctbal + 1e3) / 1.1e2) AS int), 0), 100) AS domain_authority,
  lower(c_mktsegment) AS link_type, strftime(min(o_orderdate), '%Y-%m-%d') AS first_seen_at
FROM (SELECT l_orderkey, greatest(l_suppkey // 4, 1) * 4 AS page FROM lineitem) l
JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
GROUP BY c_custkey, page, c_acctbal, c_mktsegment""",
    "etl_run_log": """
SELECT CAST(substr(month, 1, 4) AS bigint) * 12 + CAST(substr(month, 6, 2) AS bigint) AS run_id,
  month || '-01T00:00:00Z' AS started_at, month || '-01T00:01:00Z' AS finished_at,
  CASE WHEN marked = 0 THEN 'failed' ELSE 'success' END AS status, rows_extracted, rows_extracted AS rows_loaded,
  CAST(NULL AS varchar) AS message
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows_extracted,
        count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'O') AS marked
      FROM orders GROUP BY 1) m""",
    "fact_keyword_performance": f"""
SELECT l_partkey * 10000 + year(l_shipdate) AS fact_id, year(l_shipdate) * 10000 + 1231 AS date_id,
  l_partkey AS keyword_id, any_value({VOLUME}) AS search_volume, any_value(p_size) * 2 AS keyword_difficulty,
  CAST(min(l_quantity) AS int) AS current_position,
  CASE WHEN sum(floor(l_extendedprice / 1e1)) <> 0
       THEN CAST(sum(floor(l_extendedprice * l_discount / 1e1)) AS double) / sum(floor(l_extendedprice / 1e1))
  END AS estimated_ctr,
  CAST(sum(floor(l_extendedprice * l_discount / 1e1)) AS bigint) AS estimated_traffic
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_partkey, year(l_shipdate)""",
    "mart": """
SELECT keyword_id, keyword AS keyword_text, search_intent, category, date_id, current_position, search_volume,
  f.keyword_difficulty, estimated_traffic, estimated_ctr,
  rank() OVER (PARTITION BY date_id ORDER BY estimated_traffic DESC) AS traffic_rank,
  row_number() OVER (PARTITION BY date_id ORDER BY current_position, keyword_id) AS position_rank,
  CASE WHEN current_position BETWEEN 4 AND 10 AND f.keyword_difficulty < 50 THEN '🎯 QUICK WIN'
       WHEN current_position <= 3 THEN '✅ YA POSICIONADO' ELSE '⚠️ NECESITA TRABAJO' END AS classification,
  CAST(estimated_traffic * 4 AS double) AS oportunidad_mejora,
  CASE WHEN current_position BETWEEN 4 AND 10 AND f.keyword_difficulty < 50 THEN estimated_traffic * 4 ELSE 0 END
    AS prioridad_score
FROM fact_keyword_performance f JOIN dim_keyword k USING (keyword_id)""",
    "raw_keywords": f"""
SELECT CASE WHEN p_size = 50 THEN '   ' ELSE '  ' || p_type || ' ' || lower(p_name) || ' ' END AS keyword,
  CASE WHEN p_type <> 'SMALL' THEN {CATEGORY} WHEN p_size < 10 THEN '' ELSE 'otros' END AS category,
  ' ' || ({INTENT}) AS search_intent,
  CASE WHEN p_retailprice < 902 THEN 'n/a' WHEN p_retailprice >= 999 THEN ''
       ELSE CAST(CAST(round((p_retailprice - 9.05e2) * 3e2) AS bigint) AS varchar) END AS monthly_search_volume,
  CAST(p_size * 2 + 3 AS varchar) AS keyword_difficulty, p_partkey AS src_key
FROM part""",
    "raw_pages": f"""
SELECT ' ' || {SHOP_URL} || '  ' AS url, s_name AS title, lower(s_name) AS h1,
  CAST(CAST(floor(s_acctbal) AS bigint) AS varchar) AS word_count,
  CASE WHEN s_acctbal < 1000 THEN '' ELSE '1' END AS indexable,
  CAST(CAST(floor(abs(s_acctbal) / 9e1) AS bigint) AS varchar) AS page_speed_score, 'a' AS feed,
  s_suppkey AS src_key
FROM supplier
UNION ALL
SELECT CASE WHEN c_mktsegment = 'FURNITURE' THEN 'ftp://' ELSE 'https://' END || {SECTION}, c_mktsegment, NULL,
  CAST(CAST(floor(c_acctbal) AS bigint) AS varchar), '1', '', 'b', c_custkey
FROM customer
UNION ALL
SELECT url, regexp_extract(html, '<title>([^<]*)</title>', 1), regexp_extract(html, '<h1>([^<]*)</h1>', 1),
  CAST({WORDS} AS varchar), '0', CASE WHEN url LIKE 'https%' THEN '' ELSE 'many' END, 'c', page_id
FROM pages""",
    "raw_positions": f"""
SELECT p_type || ' ' || upper(p_name) || ' ' AS keyword, {SHOP_URL} || ' ' AS url,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN ' ' ELSE {DAY} END AS snapshot_date,
  CASE WHEN l_quantity = 50 THEN 'x' ELSE CAST(CAST(l_quantity AS int) - 2 AS varchar) END AS position,
  CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_linenumber * 5 AS varchar) END AS previous_position,
  CAST(CAST(floor(l_extendedprice * l_discount / 1e1) AS bigint) - 20 AS varchar) AS clicks_30d,
  CAST(CAST(floor(l_extendedprice / 2e2) AS bigint) AS varchar) AS impressions_30d,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    # Checked exports: normalised columns and all reasons of a rejected row in one text, '' for a valid one.
    "checked_keywords": f"""
SELECT lower({strip('keyword')}) AS keyword, {strip('category')} AS category,
  {strip('search_intent')} AS search_intent, v AS monthly_search_volume, CAST(d AS int) AS keyword_difficulty,
  concat_ws('; ', CASE WHEN {strip('keyword')} = '' THEN 'blank keyword' END,
    CASE WHEN v IS NULL THEN 'malformed number in monthly_search_volume: ' || monthly_search_volume END,
    CASE WHEN v < 0 THEN 'negative volume: ' || v END,
    CASE WHEN d IS NULL THEN 'malformed number in keyword_difficulty: ' || keyword_difficulty END,
    CASE WHEN d < 0 OR d > 100 THEN 'difficulty out of range: ' || d END,
    CASE WHEN {strip('category')} NOT IN ('transaccional', 'comercial', 'informativo')
         THEN 'unknown category: ' || {strip('category')} END) AS errors, src_key
FROM (SELECT *, CASE WHEN monthly_search_volume = '' THEN 0 ELSE {integer('monthly_search_volume')} END AS v,
        CASE WHEN keyword_difficulty = '' THEN 50 ELSE {integer('keyword_difficulty')} END AS d
      FROM raw_keywords) r""",
    "first_keywords": """
SELECT * EXCLUDE (errors) FROM (
  SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY src_key) AS copy FROM checked_keywords WHERE errors = '')
WHERE copy = 1""",
    "valid_keywords": "SELECT * EXCLUDE (src_key) FROM first_keywords",
    "checked_pages": f"""
SELECT {strip('url')} AS url, title, h1, CAST(w AS int) AS word_count, CAST(i AS int) AS indexable,
  CAST(s AS int) AS page_speed_score,
  concat_ws('; ',
    CASE WHEN NOT regexp_matches({strip('url')}, '^https?://') THEN 'invalid URL: ' || {strip('url')} END,
    CASE WHEN w IS NULL THEN 'malformed number in word_count: ' || word_count END,
    CASE WHEN w < 0 THEN 'negative word count: ' || w END,
    CASE WHEN i IS NULL THEN 'malformed number in indexable: ' || indexable END,
    CASE WHEN page_speed_score <> '' AND s IS NULL
         THEN 'malformed number in page_speed_score: ' || page_speed_score END,
    CASE WHEN s < 0 OR s > 100 THEN 'page speed out of range: ' || s END) AS errors, feed, src_key
FROM (SELECT *, CASE WHEN word_count = '' THEN 0 ELSE {integer('word_count')} END AS w,
        CASE WHEN indexable = '' THEN 0 ELSE {integer('indexable')} END AS i,
        {integer('page_speed_score')} AS s
      FROM raw_pages) r""",
    "first_pages": """
SELECT * EXCLUDE (errors) FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY feed, src_key) AS copy FROM checked_pages WHERE errors = '')
WHERE copy = 1""",
    "valid_pages": "SELECT * EXCLUDE (feed, src_key) FROM first_pages",
    "checked_positions": f"""
SELECT lower({strip('keyword')}) AS keyword, {strip('url')} AS url, {strip('snapshot_date')} AS snapshot_date,
  CAST(p AS int) AS position, CAST({integer('previous_position')} AS int) AS previous_position,
  CAST(clicks_30d AS bigint) AS clicks_30d, CAST(impressions_30d AS bigint) AS impressions_30d,
  concat_ws('; ',
    CASE WHEN p IS NULL THEN 'malformed number in position: ' || position END,
    CASE WHEN p < 0 THEN 'negative position: ' || p END,
    CASE WHEN {strip('snapshot_date')} = '' THEN 'empty snapshot date' END) AS errors,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM (SELECT *, CASE WHEN position = '' THEN 0 ELSE {integer('position')} END AS p FROM raw_positions) r""",
    "marked_positions": """
SELECT * REPLACE (CASE WHEN errors <> '' THEN errors
    WHEN keyword NOT IN (SELECT keyword FROM valid_keywords) THEN 'orphan, unknown keyword: ' || keyword
    WHEN url NOT IN (SELECT url FROM valid_pages) THEN 'orphan, unknown URL: ' || url
    ELSE '' END AS errors)
FROM checked_positions""",
    "valid_positions": """
SELECT keyword, url, snapshot_date, position, previous_position, greatest(clicks_30d, 0) AS clicks_30d,
  greatest(impressions_30d, clicks_30d, 0) AS impressions_30d, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY keyword, url, snapshot_date
                  ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS copy
      FROM marked_positions WHERE errors = '')
WHERE copy = 1""",
    # A store after a load of the exports: ids in the order of the exports.
    "loaded_keyword": """
SELECT row_number() OVER (ORDER BY src_key) AS keyword_id, keyword, category, search_intent, monthly_search_volume,
  keyword_difficulty, CAST(NULL AS varchar) AS current_url_target
FROM first_keywords""",
    "loaded_page": """
SELECT row_number() OVER (ORDER BY feed, src_key) AS page_id, CAST(1 AS bigint) AS site_id, url, title,
  CAST(NULL AS varchar) AS meta_description, h1, word_count, indexable, page_speed_score,
  '2002-01-31' AS last_crawled_at
FROM first_pages""",
    "loaded_position": """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS position_id,
  keyword_id, page_id, snapshot_date, position, previous_position, clicks_30d, impressions_30d,
  CASE WHEN impressions_30d <> 0 THEN CAST(clicks_30d AS double) / impressions_30d END AS ctr_30d
FROM valid_positions JOIN (SELECT keyword_id, keyword FROM loaded_keyword) USING (keyword)
JOIN (SELECT page_id, url FROM loaded_page) USING (url)""",
    "loaded_noindex": """
SELECT row_number() OVER (ORDER BY page_id) AS issue_id, page_id
FROM (SELECT page_id FROM loaded_page WHERE indexable = 0
      INTERSECT SELECT page_id FROM loaded_position WHERE position > 0)""",
    "loaded_issue": """
SELECT issue_id, CAST(1 AS bigint) AS site_id, page_id, 'noindex' AS issue_type, 'critical' AS severity,
  CAST(0 AS bigint) AS traffic_at_risk, '2002-01-31' AS detected_at, CAST(NULL AS varchar) AS resolved_at,
  'open' AS status
FROM loaded_noindex
UNION ALL
SELECT (SELECT count(*) FROM loaded_noindex) + row_number() OVER (ORDER BY page_id, keyword_id, snapshot_date), 1, page_id,
  'content_decay', CASE WHEN position - previous_position >= 8 THEN 'high' ELSE 'medium' END, 0, '2002-01-31', NULL, 'open'
FROM loaded_position WHERE position > 0 AND position - previous_position >= 5""",
    # A store after two loads of staging tables: the early positions, then all of them.
    "staged_keyword": """
SELECT row_number() OVER (ORDER BY keyword) AS new_id, keyword_id, keyword,
  CASE WHEN p_type = 'SMALL' THEN 'informativo' ELSE category END AS category,
  CASE WHEN p_type = 'LARGE' THEN 'informational' ELSE search_intent END AS search_intent,
  CASE WHEN p_size > 5 THEN monthly_search_volume ELSE 0 END AS monthly_search_volume,
  CASE WHEN p_size < 45 THEN p_size * 2 ELSE 50 END AS keyword_difficulty
FROM dim_keyword JOIN part ON p_partkey = keyword_id""",
    "staged_page": """
SELECT row_number() OVER (ORDER BY url) AS new_id, s.*, d.page_id FROM staging_pages s LEFT JOIN dim_page d USING (url)""",
    "staged_fact": """
SELECT row_number() OVER (ORDER BY snapshot_date > '1999-12-31', k.keyword, p.url, snapshot_date) AS position_id,
  k.new_id AS keyword_id, p.new_id AS page_id, snapshot_date, position,
  CASE WHEN snapshot_date > '1999-12-31'
       THEN (SELECT max_by(e.position, e.snapshot_date) FROM staged_positions e
             WHERE e.keyword_id = s.keyword_id AND e.page_id = s.page_id AND e.snapshot_date <= '1999-12-31') END
    AS previous_position
FROM staged_positions s JOIN staged_keyword k ON k.keyword_id = s.keyword_id
JOIN staged_page p ON p.page_id = s.page_id""",
    "staged_noindex": """
SELECT page_id, min(run) AS run FROM (
  SELECT f.page_id, CASE WHEN snapshot_date > '1999-12-31' THEN 2 ELSE 1 END AS run
  FROM staged_fact f JOIN staged_page p ON p.new_id = f.page_id
  WHERE position > 0 AND coalesce(indexable, 1) = 0) n
GROUP BY page_id""",
    "staged_issue": """
SELECT row_number() OVER (ORDER BY run, kind, page_id, keyword_id, snapshot_date) AS issue_id, page_id, issue_type,
  severity, CASE run WHEN 1 THEN '2002-01-31' ELSE '2002-02-07' END AS detected_at
FROM (SELECT run, 1 AS kind, page_id, 0 AS keyword_id, '' AS snapshot_date, 'noindex' AS issue_type,
        'critical' AS severity
      FROM staged_noindex
      UNION ALL
      SELECT 2, 2, page_id, keyword_id, snapshot_date, 'content_decay',
        CASE WHEN position - previous_position >= 8 THEN 'high' ELSE 'medium' END
      FROM staged_fact WHERE position > 0 AND position - previous_position >= 5) i""",
    "stored_keywords": """
SELECT * FROM dim_keyword
WHERE keyword_id IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-07-01')""",
    "staging_pages": f"""
SELECT url, {strip('title')} AS title, {strip('h1')} AS h1, word_count, indexable, page_speed_score, loaded_at FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY loaded_at DESC NULLS LAST, feed, src_key) AS copy FROM (
    SELECT {SHOP_URL} AS url, CASE WHEN s_acctbal >= 2000 THEN 'New ' || s_name END AS title,
      CASE WHEN s_acctbal >= 4000 THEN s_name END AS h1,
      CASE WHEN s_acctbal >= 3000 THEN CAST(floor(s_acctbal / 2e0) AS int) END AS word_count,
      CASE WHEN s_acctbal >= 6000 THEN 0 END AS indexable,
      CASE WHEN s_acctbal >= 5000 THEN CAST(floor(s_acctbal / 1e2) AS int) END AS page_speed_score,
      CASE WHEN s_acctbal >= 1000 THEN '2002-01-07T08:00:00Z' END AS loaded_at, 'a' AS feed, s_suppkey AS src_key
    FROM supplier
    UNION ALL
    SELECT 'https://' || {SECTION}, c_mktsegment, NULL, CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS int) END,
      NULL, NULL, CASE WHEN c_acctbal >= 5000 THEN '2002-01-08T08:00:00Z'
        WHEN c_acctbal >= 0 THEN '2002-01-07T08:00:00Z' END, 'b', c_custkey
    FROM customer
    UNION ALL
    SELECT url, regexp_extract(html, '<title>([^<]*)</title>', 1), regexp_extract(html, '<h1>([^<]*)</h1>', 1),
      CAST({WORDS} AS int), 1, NULL, '2002-01-07T09:00:00Z', 'c', page_id
    FROM pages) u) n
WHERE copy = 1""",
    "stored_positions": """
SELECT * FROM fact_keyword_position WHERE snapshot_date <= '1999-12-31'""",
    "staged_positions": f"""
SELECT l_partkey AS keyword_id, l_suppkey AS page_id, snapshot_date, position FROM (
  SELECT l_partkey, l_suppkey, {DAY} AS snapshot_date,
    CASE WHEN l_quantity < 46 THEN CAST(l_quantity AS int) ELSE 0 END AS position,
    row_number() OVER (PARTITION BY l_partkey, l_suppkey, year(l_shipdate)
      ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS copy
  FROM lineitem) s
WHERE copy = 1 AND snapshot_date >= '1998-12-31'""",
    "fresh_positions": """
SELECT s.*, (SELECT max_by(f.position, f.snapshot_date) FROM stored_positions f
             WHERE f.keyword_id = s.keyword_id AND f.page_id = s.page_id AND f.snapshot_date < s.snapshot_date)
  AS previous_position
FROM staged_positions s
WHERE NOT EXISTS (SELECT 1 FROM stored_positions f WHERE f.keyword_id = s.keyword_id AND f.page_id = s.page_id
                    AND f.snapshot_date = s.snapshot_date)""",
}


def with_tables(body: str, given: frozenset[str] = frozenset()) -> str:
    """``body`` preceded by the tables it names, and those they name in turn, but for those that are ``given``."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in TABLES:
            if name not in needed and name not in given and re.search(rf"\b{name}\b", text):
                add(TABLES[name])
                if name not in needed:
                    needed.append(name)

    add(body)
    parts = ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed)
    return f"WITH {parts}\n{body}" if parts else body
