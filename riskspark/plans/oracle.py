"""The same results as plain SQL over the same tables, for the cross-check in another engine."""

from __future__ import annotations

from riskspark import constants as K

LEVEL = """CASE WHEN {0} >= 0.8e0 THEN 'Critical' WHEN {0} >= 0.6e0 THEN 'High'
                WHEN {0} >= 0.4e0 THEN 'Medium' ELSE 'Low' END"""


def _class(score: str) -> str:
    return f"""CASE WHEN {score} >= 9 THEN 'CRITICAL' WHEN {score} >= 7 THEN 'HIGH'
                    WHEN {score} >= 4 THEN 'MEDIUM' WHEN {score} > 0 THEN 'LOW' END"""


LINE = f"""
line AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS cve_id,
         l_shipdate AS published,
         l_quantity / 5 AS cvss_score,
         lower({_class("l_quantity / 5")}) AS cvss_severity,
         l_tax * 10 AS epss_score,
         l_discount * 10 AS epss_percentile,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_kev,
         CAST(nullif(l_suppkey % 8, 7) AS INTEGER) AS cluster_id,
         p_brand AS primary_vendor,
         nullif(p_type, 'PROMO') AS primary_product
  FROM lineitem JOIN part ON l_partkey = p_partkey),
parts AS (
  SELECT *, cvss_score / 10e0 AS cvss_normalized,
         greatest(0e0, 1e0 - date_diff('day', CAST(published AS DATE), DATE '2001-12-01') / 1095e0)
           AS recency_score
  FROM line),
weighted AS (
  SELECT *, round(0.4e0 * cvss_normalized + 0.4e0 * epss_percentile + 0.2e0 * is_kev
                  + 0e0 * recency_score, 4) AS plain
  FROM parts),
scored AS (
  SELECT *, CASE WHEN is_kev = 1 THEN greatest(plain, 0.9e0) ELSE plain END AS priority_score
  FROM weighted)"""

FINAL = f"""{LINE},
stats AS (
  SELECT cluster_id, count(*) AS cluster_size, avg(is_kev) AS cluster_kev_density,
         max(epss_score) AS cluster_epss_max, avg(epss_score) AS cluster_epss_mean,
         avg(cvss_score) AS cluster_avg_cvss
  FROM line WHERE cluster_id IS NOT NULL GROUP BY cluster_id),
boosted AS (
  SELECT scored.*, cluster_size, cluster_kev_density, cluster_epss_max, cluster_epss_mean,
         cluster_avg_cvss,
         least(1.5e0, greatest(0e0, priority_score * (1e0 + 0.5e0 * coalesce(cluster_kev_density, 0e0))
               + 0.1e0 * coalesce(cluster_epss_max, 0e0))) AS priority_score_final
  FROM scored LEFT JOIN stats USING (cluster_id)),
final AS (SELECT *, {LEVEL.format("priority_score_final")} AS priority_level_final FROM boosted)"""

FACTS = f"""{FINAL},
facts AS (
  SELECT * REPLACE (coalesce(cluster_id, -1) AS cluster_id)
  FROM final
  QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY priority_score_final DESC) = 1)"""


def _selections(capacity: int) -> str:
    half = max(1, capacity // 2)

    def quota(size: int, name: str) -> str:
        return f"""
{name} AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster_id
                                 ORDER BY priority_score_final DESC, cve_id) AS nth FROM facts)
  WHERE nth <= greatest(1, {size} // (SELECT count(DISTINCT cluster_id) FROM facts))
  ORDER BY priority_score_final DESC, cve_id LIMIT {size})"""

    return f"""
top_priority AS (
  SELECT * FROM facts ORDER BY priority_score_final DESC, cve_id LIMIT {capacity}),
high_epss AS (
  SELECT * FROM facts ORDER BY epss_score DESC, priority_score_final DESC, cve_id
  LIMIT {capacity}),
{quota(capacity, "cluster_based").strip()},
kev_first AS (
  SELECT * FROM facts ORDER BY is_kev DESC, priority_score_final DESC, cve_id LIMIT {capacity}),
{quota(capacity - half, "other_half").strip()},
hybrid AS (
  SELECT * EXCLUDE (source) FROM (
    (SELECT *, 0 AS source FROM facts
     ORDER BY is_kev DESC, priority_score_final DESC, cve_id LIMIT {half})
    UNION ALL SELECT *, 1 FROM other_half)
  QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY source) = 1
  ORDER BY source, priority_score_final DESC, cve_id LIMIT {capacity})"""


SELECTIONS = f"{FACTS},{_selections(50)}"
STRATEGIES = ("top_priority", "high_epss", "cluster_based", "kev_first", "hybrid")
CHOSEN = "\nUNION ALL ".join(f"SELECT *, '{name}' AS strategy FROM {name}" for name in STRATEGIES)

RANKS = f"""{FACTS},
rounds AS (
  SELECT *, row_number() OVER (PARTITION BY cluster_id
                               ORDER BY priority_score_final DESC, cve_id) AS turn FROM facts),
ranked AS (
  SELECT 'top_priority' AS strategy, *, row_number() OVER (
    ORDER BY priority_score_final DESC, cve_id) AS pos FROM rounds
  UNION ALL SELECT 'high_epss', *, row_number() OVER (
    ORDER BY epss_score DESC, priority_score_final DESC, cve_id) FROM rounds
  UNION ALL SELECT 'cluster_based', *, row_number() OVER (
    ORDER BY turn, priority_score_final DESC, cluster_id, cve_id) FROM rounds
  UNION ALL SELECT 'kev_first', *, row_number() OVER (
    ORDER BY is_kev DESC, priority_score_final DESC, cve_id) FROM rounds
  UNION ALL SELECT 'hybrid', *, row_number() OVER (
    ORDER BY is_kev DESC, turn, priority_score_final DESC, cve_id) FROM rounds)"""


def _actions(source: str, score: str) -> str:
    return f"""
named AS (
  SELECT cve_id, is_kev, epss_score, {score} AS score,
         coalesce(primary_vendor, 'unknown') AS primary_vendor,
         coalesce(primary_product, 'unknown') AS primary_product
  FROM {source}),
groups AS (
  SELECT primary_vendor, primary_product, count(cve_id) AS n_cves,
         CAST(sum(is_kev) AS BIGINT) AS n_kev, max(score) AS max_priority,
         sum(score) AS total, avg(epss_score) AS mean_epss, max(epss_score) AS max_epss
  FROM named GROUP BY ALL),
best AS (
  SELECT primary_vendor, primary_product, string_agg(cve_id, ',' ORDER BY nth) AS top_cves
  FROM (SELECT *, row_number() OVER (PARTITION BY primary_vendor, primary_product
                                     ORDER BY score DESC, cve_id) AS nth FROM named)
  WHERE nth <= 5 GROUP BY ALL)
SELECT primary_vendor, primary_product, n_cves, n_kev, round(max_priority, 6) AS max_priority,
       round(total, 6) AS sum_priority, round(mean_epss, 6) AS mean_epss, max_epss,
       round(ln(1 + n_cves), 6) AS effort_proxy, round(total / ln(1 + n_cves), 6) AS action_score,
       top_cves
FROM groups JOIN best USING (primary_vendor, primary_product)
ORDER BY total / ln(1 + n_cves) DESC, primary_vendor, primary_product"""


def _history(date: str) -> str:
    return f"""
history AS (
  SELECT CAST(user_id AS VARCHAR) AS cve_id, value / 500 AS epss_score,
         round(value / 500, 2) AS epss_percentile, CAST(ts AS DATE) AS score_date
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                             ORDER BY ts DESC, event_id DESC) = 1),
known AS (
  SELECT * FROM history
  WHERE score_date = (SELECT max(score_date) FROM history WHERE score_date <= DATE '{date}'))"""


def _master(date: str) -> str:
    severity = "CASE WHEN n_chars >= 500 THEN least(10e0, n_chars / 1000e0) END"
    return f"""{_history(date)},
docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS cve_id,
         DATE '2015-01-01' + CAST(doc_id % 3000 AS INTEGER) AS published,
         text AS description,
         CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'CWE-' || (doc_id % 7) END AS cwes,
         {severity} AS cvss_score,
         {_class(severity)} AS cvss_severity,
         CASE WHEN doc_id % 4 <> 0 THEN source END AS cpe_vendors,
         CASE WHEN doc_id % 4 <> 0 THEN lang END AS cpe_products
  FROM documents),
listed AS (
  SELECT CAST(doc_id AS VARCHAR) AS cve_id,
         DATE '2020-01-01' + CAST(doc_id % 900 + 400 AS INTEGER) AS kev_date_added,
         'maker-' || (doc_id % 9) AS kev_vendor, 'thing-' || quality AS kev_product,
         'name ' || doc_id AS kev_vulnerability_name, 'short' AS kev_short_description,
         'patch' AS kev_required_action,
         CASE WHEN toxic = 1 THEN 'Known' ELSE 'Unknown' END AS known_ransomware_campaign_use,
         toxic = 1 AS is_ransomware
  FROM labels WHERE toxic = 1 OR quality = 0),
master AS (
  SELECT docs.*, kev_date_added, kev_vendor, kev_product, kev_vulnerability_name,
         kev_short_description, kev_required_action, known_ransomware_campaign_use,
         coalesce(is_ransomware, false) AS is_ransomware,
         CASE WHEN listed.cve_id IS NULL THEN 0 ELSE 1 END AS is_kev,
         coalesce(epss_score, 0e0) AS epss_score,
         coalesce(epss_percentile, 0e0) AS epss_percentile,
         score_date AS epss_score_date,
         DATE '{date}' AS snapshot_date,
         coalesce(cpe_vendors, kev_vendor) AS primary_vendor,
         coalesce(cpe_products, kev_product) AS primary_product
  FROM docs LEFT JOIN listed USING (cve_id) LEFT JOIN known USING (cve_id))"""


MASTER = _master("2024-01-15")


def _percent(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) * 100e0 / count(*)"


PROFILE = f"""
SELECT DATE '2024-01-15' AS snapshot_date, count(*) AS row_count,
       count(DISTINCT cve_id) AS distinct_cve_count,
       {_percent("cvss_score IS NULL")} AS pct_null_cvss,
       {_percent("epss_score = 0")} AS pct_null_epss,
       {_percent("coalesce(cwes, '') = ''")} AS pct_null_cwes,
       {_percent("cpe_vendors IS NULL")} AS pct_null_cpe,
       {_percent("epss_score > 0.7e0")} AS pct_epss_gt_07,
       {_percent("epss_score > 0.9e0")} AS pct_epss_gt_09,
       round(avg(epss_score), 6) AS mean_epss,
       quantile_disc(epss_score, 0.5) AS median_epss,
       CAST(sum(is_kev) AS BIGINT) AS kev_count,
       count(*) FILTER (WHERE is_kev = 1) AS nvd_kev_intersection,
       count(*) FILTER (WHERE epss_score > 0) AS nvd_epss_intersection,
       count(*) FILTER (WHERE is_kev = 1 AND epss_score > 0) AS nvd_kev_epss_intersection
FROM master"""

CHANGES = """
base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cve_id, o_orderkey AS number, o_orderdate AS last_modified,
         o_orderstatus AS description, CAST(year(o_orderdate) AS INTEGER) AS published_year
  FROM orders),
changes AS (
  SELECT cve_id, last_modified + INTERVAL 2 DAY AS last_modified, 'changed 2' AS description,
         CASE WHEN published_year = 1995 THEN 1996 WHEN number % 100 = 0 THEN published_year + 1
              ELSE published_year END AS published_year
  FROM base WHERE number % 50 = 0 OR published_year = 1995
  UNION ALL
  SELECT 'new-' || cve_id, last_modified, 'new', published_year FROM base WHERE number % 70 = 0),
valid AS (SELECT * FROM changes WHERE published_year >= 1996),
upserted AS (
  SELECT cve_id, last_modified, description, published_year, published_year AS year
  FROM base WHERE cve_id NOT IN (SELECT cve_id FROM changes)
  UNION ALL SELECT *, published_year FROM valid),
touched AS (
  SELECT published_year FROM valid
  UNION SELECT published_year FROM base WHERE cve_id IN (SELECT cve_id FROM changes))"""

FEED = """
feed AS (
  SELECT *, 'CVE-' || o_orderkey AS cve_id, substr(o_orderpriority, 1, 1) AS urgency,
         substr(o_orderpriority, 3) AS words, (o_orderkey % 101) / 10e0 AS score
  FROM orders)"""

RISK = """
risk AS (
  SELECT coalesce(cluster_id, -1) AS cluster_id, count(cve_id) AS cluster_size,
         round(avg(priority_score_final), 6) AS avg_priority_final,
         round(avg(cvss_score), 6) AS avg_cvss, round(avg(epss_score), 6) AS avg_epss,
         max(epss_score) AS max_epss, avg(is_kev) AS kev_density,
         CAST(sum(is_kev) AS BIGINT) AS n_kev
  FROM final GROUP BY 1)"""


def _top_values(name: str, column: str, source: str, k: int, out: str) -> str:
    return f"""
{name} AS (
  SELECT cluster_id, string_agg(v, ',' ORDER BY nth) AS {out} FROM (
    SELECT cluster_id, {column} AS v,
           row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, {column} NULLS LAST)
             AS nth
    FROM {source} GROUP BY cluster_id, {column})
  WHERE nth <= {k} GROUP BY cluster_id)"""


def _select(name: str) -> str:
    return f"""WITH {SELECTIONS}
SELECT cve_id, cluster_id, is_kev, epss_score, priority_score_final FROM {name}"""


_RECOMMENDED = {
    "top_priority": "priority_score_final DESC, epss_score DESC, cve_id",
    "high_epss": "epss_score DESC, priority_score_final DESC, cve_id",
    "cluster_based": "priority_score_final DESC, is_kev DESC, epss_score DESC, cve_id",
    "kev_first": "is_kev DESC, priority_score_final DESC, epss_score DESC, cve_id",
    "hybrid": "is_kev DESC, priority_score_final DESC, epss_score DESC, cve_id",
}

# fixed values: what is blanked out of lower-cased text, in this order
_CLEAN = "lower(text)"
for _pattern in (r"\n", r"http\S+", r"cve-\d{4}-\d+", r"0x[0-9a-f]+", r"[^a-zA-Z\s]", r"\s+"):
    _CLEAN = f"regexp_replace({_CLEAN}, '{_pattern}', ' ', 'g')"

_WORDS = f"""
SELECT CAST(doc_id AS VARCHAR) AS cve_id,
       list_filter(string_split({_CLEAN}, ' '),
                   lambda w: length(w) >= {K.MIN_TOKEN_LENGTH} AND w NOT IN {K.DOMAIN_STOP_WORDS}) AS words
FROM documents WHERE text IS NOT NULL"""

_TERMS = f"""
documents_words AS ({_WORDS}),
counts AS (
  SELECT cve_id, term, count(*) AS n
  FROM (SELECT cve_id, unnest(words) AS term FROM documents_words) GROUP BY ALL),
often AS (
  SELECT term, ln(((SELECT count(*) FROM documents_words) + 1e0) / (count(*) + 1e0)) AS idf FROM counts GROUP BY term),
weights AS (SELECT cve_id, term, n, idf, n * idf AS weight FROM counts JOIN often USING (term))"""


def _best_terms(groups: str) -> str:
    """The ten best terms of each group in ``groups`` (cve_id, cluster_id)."""
    return f"""sums AS (
  SELECT cluster_id, term, sum(n) * min(idf) AS total FROM weights JOIN {groups} USING (cve_id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY total DESC, term) AS nth FROM sums),
keywords AS (
  SELECT cluster_id, string_agg(term, ',' ORDER BY nth) AS top_keywords FROM ranked WHERE nth <= 10 GROUP BY cluster_id)"""


def _best_values(name: str, values: str) -> str:
    """The five most frequent values of each group, from rows (cluster_id, value)."""
    return f"""{name}_ranked AS (
  SELECT cluster_id, value, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, value) AS nth
  FROM ({values}) GROUP BY cluster_id, value),
{name} AS (
  SELECT cluster_id, string_agg(value, ',' ORDER BY nth) AS {name} FROM {name}_ranked WHERE nth <= 5 GROUP BY cluster_id)"""


#: Rows (point, own, i, x) must stand in ``parts``; leaves distances of points to all groups in ``means``.
_TO_GROUPS = """norms AS (SELECT point, own, sum(x * x) AS norm FROM parts GROUP BY ALL),
sums AS (SELECT own AS other, i, sum(x) AS s FROM parts GROUP BY ALL),
sizes AS (SELECT own AS other, count(*) AS n, sum(norm) AS squares FROM norms GROUP BY ALL),
products AS (SELECT point, own, other, sum(x * s) AS dot FROM parts JOIN sums USING (i) GROUP BY ALL),
met AS (
  SELECT point, norms.own, sizes.other, n, norm, squares, coalesce(dot, 0e0) AS dot
  FROM norms CROSS JOIN sizes LEFT JOIN products USING (point, other))"""
_TO_GROUPS += """,
lengths AS (SELECT other, sum(s * s) / (n * n) AS len FROM sums JOIN sizes USING (other) GROUP BY other, n)"""

_DAVIES_BOULDIN = """spreads AS (
  SELECT own, avg(sqrt(greatest(norm - 2 * dot / n + len, 0e0))) AS s FROM met JOIN lengths USING (other)
  WHERE own = met.other GROUP BY own),
gaps AS (
  SELECT a.other AS p, b.other AS q, sum(a.s * b.s) / (min(u.n) * min(v.n)) AS cross_dot
  FROM sums a JOIN sums b ON a.i = b.i AND a.other <> b.other
  JOIN sizes u ON a.other = u.other JOIN sizes v ON b.other = v.other GROUP BY ALL),
worst AS (
  SELECT p, max((x.s + y.s) / sqrt(l.len + m.len - 2 * cross_dot)) AS w
  FROM gaps JOIN spreads x ON p = x.own JOIN spreads y ON q = y.own
  JOIN lengths l ON p = l.other JOIN lengths m ON q = m.other GROUP BY p)
SELECT round(avg(w), 6) AS davies_bouldin FROM worst"""

_VECTOR_PARTS = """parts AS (
  SELECT vec_id AS point, label AS own, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x
  FROM embeddings)"""


def _lloyd(rounds: int) -> str:
    steps = []
    for n in range(rounds):
        steps.append(f"""chosen{n} AS (
  SELECT vec_id, arg_min(c, (d, c)) AS cluster_id
  FROM (SELECT vec_id, c, sum((x - v) * (x - v)) AS d FROM parts JOIN centres{n} USING (i) GROUP BY ALL) GROUP BY vec_id),
centres{n + 1} AS (
  SELECT cluster_id AS c, i, round(avg(x), 9) AS v FROM parts JOIN chosen{n} USING (vec_id) GROUP BY ALL
  UNION ALL SELECT c, i, v FROM centres{n} WHERE c NOT IN (SELECT cluster_id FROM chosen{n}))""")
    return f"""WITH parts AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
first AS (SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS c FROM embeddings ORDER BY vec_id LIMIT 4),
centres0 AS (SELECT c, i, x AS v FROM parts JOIN first USING (vec_id)), {", ".join(steps)}
SELECT vec_id, cluster_id FROM chosen{rounds - 1}"""

_FALLBACK = """
SELECT cve_id,
       CASE urgency WHEN '1' THEN score WHEN '2' THEN score + 0.5e0 WHEN '3' THEN score + 1e0
                    WHEN '4' THEN score + 2e0 END AS cvss_score,
       CASE urgency WHEN '1' THEN 'four ' || words WHEN '2' THEN 'three-one ' || words
                    WHEN '3' THEN 'three ' || words WHEN '4' THEN 'two ' || words END
         AS cvss_severity,
       CASE urgency WHEN '1' THEN 'v4.0' WHEN '2' THEN 'v3.1' WHEN '3' THEN 'v3.0'
                    WHEN '4' THEN 'v2' END AS cvss_version
FROM feed"""

def _dot(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b})"


def _times(vector: str) -> str:
    return f"list_transform(c, lambda r: list_dot_product(r, {vector}))"


def _without(vector: str, other: str) -> str:
    """The part of a vector that is at right angles to another one of length 1."""
    return f"list_transform(list_zip({vector}, {other}), lambda p: p[1] - {_dot(vector, other)} * p[2])"


def _unit(vector: str) -> str:
    return f"list_transform({vector}, lambda x: x / sqrt({_dot(vector, vector)}))"


#: Three principal axes of the vectors by power iteration, each kept at right angles to those before.
AXES = f"""RECURSIVE parts AS (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
pairs AS (
  SELECT a.i, b.i AS j, covar_samp(a.x, b.x) AS value FROM parts a JOIN parts b USING (vec_id) GROUP BY ALL),
matrix AS (
  SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(value ORDER BY j) AS r FROM pairs GROUP BY i)),
turns AS (
  SELECT 0 AS n, list_transform(range(1, len(c) + 1), lambda i: sin(i)) AS u,
         list_transform(range(1, len(c) + 1), lambda i: cos(2 * i + 0.3)) AS v,
         list_transform(range(1, len(c) + 1), lambda i: sin(3 * i + 0.7)) AS w FROM matrix
  UNION ALL
  SELECT n, u, v, {_unit("w")} FROM (
    SELECT n, u, v, {_without("w", "v")} AS w FROM (
      SELECT n, u, {_unit("v")} AS v, {_without("w", "u")} AS w FROM (
        SELECT n, u, {_without("v", "u")} AS v, w FROM (
          SELECT n, {_unit("u")} AS u, v, w FROM (
            SELECT n + 1 AS n, {_times("u")} AS u, {_times("v")} AS v, {_times("w")} AS w
            FROM turns, matrix WHERE n < 1500)))))),
axes AS (SELECT u, v, w FROM turns WHERE n = 1500)"""

ORACLE_SQL = {
    "remediation_actions_top50": f"WITH {LINE},{_actions('scored', 'priority_score')} LIMIT 50",
    "remediation_actions_all": f"WITH {FINAL},{_actions('final', 'priority_score_final')}",
    "priority_score_levels": f"""WITH {LINE}
SELECT cve_id, cvss_normalized, recency_score, priority_score,
       {LEVEL.format("priority_score")} AS priority_level FROM scored""",
    "scoring_label": f"""
SELECT 'ev-' || event_id AS cve,
       CASE WHEN event_type = 'error' THEN 'Unknown' ELSE {LEVEL.format("value")} END AS label,
       CASE WHEN event_type = 'error' THEN NULL WHEN value <= 1 THEN value * 100 ELSE value END
         AS shown
FROM events""",
    "cluster_final_score": f"""WITH {FINAL}
SELECT cve_id, cluster_id, cluster_size, cluster_kev_density, cluster_epss_max,
       round(cluster_epss_mean, 6) AS cluster_epss_mean,
       round(cluster_avg_cvss, 6) AS cluster_avg_cvss, priority_score_final, priority_level_final
FROM final""",
    "group_sizes": f"""WITH {LINE}
SELECT cluster_id, count(*) AS size, CAST(sum(is_kev) AS BIGINT) AS kev_count
FROM line GROUP BY cluster_id ORDER BY cluster_id NULLS FIRST""",
    "master_left_joins": f"WITH {MASTER} SELECT * EXCLUDE (description) FROM master",
    "quality_summary": f"WITH {MASTER} {PROFILE}",
    "severity_distribution": f"""WITH {MASTER}
SELECT cvss_severity, count(*) AS cve_count, DATE '2024-01-15' AS snapshot_date
FROM master GROUP BY cvss_severity""",
    "flag_by_year": f"""WITH {MASTER}
SELECT CAST(year(kev_date_added) AS INTEGER) AS kev_year, count(*) AS kev_count,
       DATE '2024-01-15' AS snapshot_date
FROM master WHERE is_kev = 1 GROUP BY 1""",
    "completeness": f"""WITH {MASTER}, profile AS ({PROFILE})
SELECT snapshot_date, 100 - pct_null_cvss AS cvss_complete, 100 - pct_null_epss AS epss_complete,
       100 - pct_null_cwes AS cwes_complete, 100 - pct_null_cpe AS cpe_complete FROM profile""",
    "quality_latest": f"WITH {MASTER} {PROFILE}",
    "snapshot_asof": f"WITH {_history('2024-01-15')} SELECT * FROM known",
    "latest_within_days": f"""WITH {_history("2024-02-02")}
SELECT * FROM known WHERE score_date >= DATE '2024-02-02' - 7""",
    "dedupe_latest": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_partitions": f"WITH {CHANGES} SELECT * FROM upserted",
    "upsert_stats": f"""WITH {CHANGES}
SELECT (SELECT count(*) FROM valid) AS modified_rows,
       (SELECT count(*) FROM touched) AS affected_years,
       (SELECT count(*) FROM upserted WHERE year IN (FROM touched)) AS written_rows""",
    "nested_flatten": f"""WITH {FEED}
SELECT cve_id, o_orderdate AS published, o_orderdate AS last_modified,
       'order ' || o_orderkey AS description,
       CASE WHEN o_orderstatus <> 'P' THEN array_to_string(list_sort(list_distinct(
         ['CWE-' || (o_custkey % 10), 'CWE-' || (o_orderkey % 7)])), ',') END AS cwes,
       CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END AS reference_count,
       CAST(year(o_orderdate) AS INTEGER) AS published_year
FROM feed""",
    "nested_fallback_chain": f"WITH {FEED} {_FALLBACK}",
    "nested_exploit_flag": f"""WITH {FEED}
SELECT cve_id, CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END AS reference_count,
       o_orderstatus = 'O' AND o_orderkey % 2 = 0 AS has_exploit_reference
FROM feed""",
    "feed_window": f"""WITH {FEED}
SELECT cve_id, CAST(year(o_orderdate) AS INTEGER) AS published_year FROM feed
WHERE year(o_orderdate) >= 1997""",
    "cpe_fields": f"""WITH {FEED}, names AS (
  SELECT cve_id, unnest(CASE WHEN o_orderstatus = 'P' THEN ['cpe:2.3'] ELSE [
    concat_ws(':', 'cpe:2.3:a', o_custkey % 25, o_orderkey % 6, o_orderkey % 9, '*'),
    concat_ws(':', 'cpe:2.3:a', o_custkey % 25, o_orderkey % 6, o_orderkey % 4, '*'),
    concat_ws(':', 'cpe:2.3:a', o_custkey % 11, o_orderkey % 6 + 1, o_orderkey % 9, '*')] END)
    AS name FROM feed),
fields AS (SELECT cve_id, string_split(name, ':') AS f FROM names)
SELECT cve_id,
       string_agg(DISTINCT coalesce(f[4], '<null>'), ',' ORDER BY coalesce(f[4], '<null>'))
         AS cpe_vendors,
       string_agg(DISTINCT coalesce(f[5], '<null>'), ',' ORDER BY coalesce(f[5], '<null>'))
         AS cpe_products,
       string_agg(DISTINCT coalesce(f[6], '<null>'), ',' ORDER BY coalesce(f[6], '<null>'))
         AS cpe_versions
FROM fields GROUP BY cve_id""",
    "csv_silver": """
SELECT 'CVE-' || p_partkey AS cve_id, p_brand AS vendor_project, p_type AS product,
       p_name AS vulnerability_name,
       CASE WHEN p_size % 10 <> 0 THEN DATE '2020-01-01' + p_size END AS kev_date_added,
       p_name || ', "quoted"' || chr(10) || 'next line' AS short_description,
       'patch, now' AS required_action,
       CASE p_size % 3 WHEN 0 THEN ' KNOWN ' WHEN 1 THEN 'Unknown' END
         AS known_ransomware_campaign_use,
       p_size % 3 = 0 AS is_ransomware
FROM part""",
    "csv_probabilities": """
SELECT 'EV-' || event_id AS cve_id,
       CASE WHEN event_type <> 'error' THEN value END AS epss_score,
       CASE WHEN user_id % 2 = 0 THEN CAST(user_id AS DOUBLE) END AS epss_percentile,
       DATE '2024-01-15' AS score_date
FROM events""",
    "select_top_priority": _select("top_priority"),
    "select_high_score": _select("high_epss"),
    "select_group_quota": _select("cluster_based"),
    "select_flag_first": _select("kev_first"),
    "select_hybrid": _select("hybrid"),
    "strategy_ranking": f"""WITH {RANKS}
SELECT strategy, cve_id, pos AS place FROM ranked""",
    "strategy_comparison": f"""WITH {SELECTIONS}, chosen AS ({CHOSEN}),
mix AS (
  SELECT strategy, -sum(p * log2(p)) AS entropy FROM (
    SELECT strategy, count(*) / sum(count(*)) OVER (PARTITION BY strategy) AS p
    FROM chosen GROUP BY strategy, cluster_id) GROUP BY strategy)
SELECT strategy,
       round(sum(is_kev) / (SELECT sum(is_kev) FROM facts), 4) AS kev_coverage,
       round(sum(epss_score), 4) AS epss_expected_mitigated,
       round(any_value(entropy), 4) AS cluster_diversity,
       round(avg(priority_score_final), 4) AS mean_priority_selected,
       count(*) AS n_selected, 50 AS daily_capacity, 30 AS simulation_days, 150 AS arrival_rate
FROM chosen JOIN mix USING (strategy) GROUP BY strategy ORDER BY kev_coverage DESC, strategy""",
    "backlog_projection": f"""WITH {RANKS},
totals AS (SELECT count(*) AS n, sum(is_kev) AS k FROM facts),
work AS (
  SELECT strategy, day, count(*) AS done, sum(is_kev) AS flagged, sum(epss_score) AS epss
  FROM ranked JOIN range(1, 31) AS days(day) ON pos <= 50 * day GROUP BY strategy, day)
SELECT strategy, CAST(day AS INTEGER) AS day,
       CAST(greatest(n + 150 * day - done, 0) AS BIGINT) AS backlog_size,
       CAST(greatest(k + round_even(150 * day * (k / n), 0) - flagged, 0) AS BIGINT)
         AS kev_in_backlog,
       round(epss, 4) AS cumulative_mitigated_epss, CAST(day AS DOUBLE) AS mean_age_in_backlog,
       50 AS daily_capacity, 30 AS simulation_days, 150 AS arrival_rate
FROM work, totals ORDER BY strategy, day""",
    "cluster_risk_summary": f"WITH {FINAL},{RISK} SELECT * FROM risk",
    "cluster_overview": f"""WITH {FINAL},{RISK},
grouped AS (SELECT * REPLACE (coalesce(cluster_id, -1) AS cluster_id) FROM line),
{_top_values("kinds", "primary_product", "grouped", 3, "top_keywords").strip()},
{_top_values("makers", "primary_vendor", "grouped", 5, "topic_vendors").strip()}
SELECT risk.*, DATE '2001-12-01' AS snapshot_date, top_keywords, topic_vendors,
       CASE WHEN top_keywords IS NOT NULL THEN 'none' END AS top_cwes
FROM risk LEFT JOIN kinds USING (cluster_id) LEFT JOIN makers USING (cluster_id)
ORDER BY kev_density DESC, cluster_size DESC, cluster_id""",
    "top5_clusters": f"""WITH {FINAL},{RISK}
SELECT * FROM risk ORDER BY kev_density DESC, cluster_size DESC, cluster_id LIMIT 5""",
    "cluster_totals": f"""WITH {FINAL},{RISK}
SELECT count(*) AS n_clusters, CAST(sum(cluster_size) AS BIGINT) AS n_records,
       count(*) FILTER (WHERE n_kev > 0) AS n_clusters_with_kev FROM risk""",
    "top_values_per_group": f"""WITH words AS (
  SELECT CASE WHEN doc_id % 4 <> 0 THEN lang END AS cluster_id,
         unnest(string_split(text, ' ')) AS word
  FROM documents),
{_top_values("top", "word", "words", 5, "top_words").strip()}
SELECT * FROM top""",
    "top_n_filtered": f"""WITH {FINAL}
SELECT cve_id, primary_vendor, epss_score, priority_score_final, priority_level_final FROM final
WHERE priority_level_final = 'Critical' AND is_kev = 1 AND primary_vendor ILIKE '%bRAND#1%'
  AND epss_score >= 0.3e0
ORDER BY priority_score_final DESC, cve_id LIMIT 50""",
    "recommendations_by_strategy": f"WITH {SELECTIONS}\n"
    + "\nUNION ALL ".join(
        f"(SELECT '{name}' AS strategy, cve_id, is_kev, epss_score, priority_score_final "
        f"FROM {name} ORDER BY {order} LIMIT 20)"
        for name, order in _RECOMMENDED.items()
    ),
    "point_lookup": f"""WITH {MASTER}
SELECT cve_id, is_kev, epss_score, primary_vendor, cvss_score FROM master WHERE cve_id = '17'""",
    "overview_kpis": f"""WITH {FINAL}
SELECT count(*) AS n_total, CAST(sum(is_kev) AS BIGINT) AS n_kev,
       {_percent("priority_level_final = 'Critical'")} AS pct_critical,
       count(*) FILTER (WHERE epss_score > 0.7e0) AS n_high_epss FROM final""",
    "severity_fixed_domain": f"""WITH {LINE},
domain AS (SELECT * FROM (VALUES (0, 'CRITICAL'), (1, 'HIGH'), (2, 'MEDIUM'), (3, 'LOW'),
                                 (4, 'NONE')) AS d(position, severity))
SELECT position, severity, count(cve_id) AS n
FROM domain LEFT JOIN line ON upper(cvss_severity) = severity
GROUP BY position, severity ORDER BY position""",
    "score_share_of_max": f"""WITH {FINAL}
SELECT cve_id, round(100 * priority_score_final / (SELECT max(priority_score_final) FROM final), 6)
         AS share_of_max FROM final""",
    "write_snapshot": f"""WITH {LINE}
SELECT CAST(year(published) AS INTEGER) AS published_year,
       make_date(year(published), 12, 31) AS snapshot_date, count(*) AS n,
       round(sum(CASE WHEN year(published) = 2001 THEN 0 ELSE cvss_score END), 6) AS severity
FROM line GROUP BY 1, 2""",
    "read_one_snapshot": f"""WITH {LINE}
SELECT cve_id, cvss_score, DATE '1998-12-31' AS snapshot_date FROM line
WHERE year(published) = 1998""",
    "available_snapshots": f"""WITH {LINE}
SELECT DISTINCT make_date(year(published), 12, 31) AS snapshot_date FROM line
ORDER BY snapshot_date DESC""",
    "settings_resolution": """
SELECT CAST((SELECT count(*) FROM nation) AS INTEGER) AS daily_capacity,
       CAST((SELECT count(*) FROM region) + 7 AS INTEGER) AS simulation_days""",
    "csv_export": f"""WITH {LINE}
SELECT cve_id, cvss_score, cvss_severity, epss_score, is_kev, primary_vendor, primary_product,
       published FROM line""",
    "text_clean": f"SELECT CAST(doc_id AS VARCHAR) AS cve_id, {_CLEAN} AS clean_text FROM documents",
    "nested_multiline": f"""WITH {FEED}
SELECT fallback.*, CAST(year(o_orderdate) AS INTEGER) AS published_year
FROM ({_FALLBACK}) AS fallback JOIN feed USING (cve_id)""",
    "cpe_fields_wide": """
SELECT 'CVE-' || s_suppkey AS cve_id, 60 AS vendors, CAST(s_suppkey % 290 + 11 AS INTEGER) AS products,
       CAST(60 * (s_suppkey % 290 + 11) AS INTEGER) AS versions,
       CAST(59000 + s_suppkey % 290 + 10 AS INTEGER) AS last_version
FROM supplier""",
    "upsert_null_partition": f"""WITH {CHANGES}
SELECT cve_id, CASE WHEN number % 27 = 0 THEN last_modified + INTERVAL 1 DAY ELSE last_modified END
         AS last_modified,
       CASE WHEN number % 27 = 0 THEN 'dated' ELSE description END AS description, y AS published_year,
       y AS year
FROM (SELECT *, CAST(CASE WHEN number % 27 = 0 THEN 1997 WHEN number % 9 <> 0 THEN published_year END
                     AS INTEGER) AS y FROM base)""",
    "upsert_leaves_window": f"""WITH {CHANGES}
SELECT cve_id, last_modified, CASE WHEN number % 6 = 0 THEN 'moved' ELSE description END AS description,
       published_year, published_year AS year
FROM base WHERE number % 12 <> 0""",
    "upsert_new_columns": f"""WITH {CHANGES}
SELECT cve_id, last_modified, CASE WHEN number % 10 <> 0 THEN description END AS description,
       CASE WHEN number % 10 = 0 THEN 'seen' END AS review, published_year, published_year AS year
FROM base""",
    "upsert_key_index": """WITH quarters AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cve_id, o_orderdate AS last_modified, o_orderstatus AS description,
         CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS q, o_orderkey % 97 = 0 AS changed
  FROM orders),
named AS (
  SELECT *, changed AND q IN (19932, 19974) AS hit, CASE WHEN changed AND q = 19932 THEN 19961 ELSE q END AS now
  FROM quarters)
SELECT cve_id, last_modified,
       CASE WHEN hit AND q = 19932 THEN 'moved' WHEN hit THEN 'changed' ELSE description END AS description,
       CAST(now AS INTEGER) AS published_year, CAST(now AS INTEGER) AS year,
       now IN (SELECT q FROM named WHERE hit) AS searched
FROM named""",
    "upsert_empty": f"""WITH {CHANGES}
SELECT cve_id, last_modified, description, published_year, published_year AS year, 0 AS written_rows
FROM base""",
    "full_refresh": f"""WITH {CHANGES}
SELECT cve_id, last_modified, description, published_year, published_year AS year
FROM base WHERE number % 4 <> 0 AND published_year >= 1996""",
    "repartition_table": f"""WITH {CHANGES}
SELECT cve_id, last_modified, description, published_year FROM base WHERE published_year >= 1995""",
    "document_words": f"SELECT cve_id, array_to_string(words, ' ') AS words FROM ({_WORDS})",
    "tfidf_weights": f"""WITH {_TERMS}
SELECT cve_id, term, n, round(weight, 6) AS weight FROM weights""",
    "top_terms_given": f"""WITH {_TERMS},
given AS (SELECT cve_id, CAST(cve_id AS BIGINT) % 5 AS cluster_id FROM documents_words),
{_best_terms("given")}
SELECT * FROM keywords""",
    "topics_given": f"""WITH {MASTER}, {_TERMS},
given AS (
  SELECT cve_id, CASE WHEN CAST(cve_id AS BIGINT) % 20 = 0 THEN 5 ELSE CAST(cve_id AS BIGINT) % 5 END AS cluster_id,
         cwes, cpe_vendors, is_kev
  FROM master WHERE description IS NOT NULL),
{_best_terms("given")},
{_best_values("top_vendors", "SELECT cluster_id, cpe_vendors AS value FROM given WHERE cpe_vendors IS NOT NULL")},
{_best_values("top_cwes", "SELECT cluster_id, unnest(string_split(cwes, ',')) AS value FROM given WHERE coalesce(cwes, '') <> ''")}
SELECT cluster_id, coalesce(top_keywords, '') AS top_keywords, coalesce(top_vendors, '') AS top_vendors,
       coalesce(top_cwes, '') AS top_cwes, size, kev_count
FROM (SELECT cluster_id, count(*) AS size, CAST(sum(is_kev) AS BIGINT) AS kev_count FROM given GROUP BY cluster_id)
LEFT JOIN keywords USING (cluster_id) LEFT JOIN top_vendors USING (cluster_id) LEFT JOIN top_cwes USING (cluster_id)""",
    "category_values": f"""WITH {MASTER}
SELECT DISTINCT cve_id, 'cwes' AS kind, unnest(string_split(cwes, ',')) AS value FROM master WHERE coalesce(cwes, '') <> ''
UNION SELECT cve_id, 'cpe_vendors', cpe_vendors FROM master WHERE cpe_vendors IS NOT NULL""",
    "davies_bouldin_terms": f"""WITH {_TERMS},
parts AS (SELECT cve_id AS point, CAST(cve_id AS BIGINT) % 5 AS own, term AS i, weight AS x FROM weights),
{_TO_GROUPS}, {_DAVIES_BOULDIN}""",
    "pca_variance": f"""WITH {AXES},
total AS (SELECT sum(value) AS t FROM pairs WHERE i = j)
SELECT CAST(component AS INTEGER) AS component, round(value / t, 6) AS share
FROM total, (SELECT unnest([1, 2, 3]) AS component,
             unnest([{_dot("u", _times("u"))}, {_dot("v", _times("v"))}, {_dot("w", _times("w"))}]) AS value
             FROM axes, matrix)""",
    "pca_lengths": f"""WITH {AXES},
vectors AS (SELECT vec_id, list(x ORDER BY i) AS x FROM parts GROUP BY vec_id)
SELECT vec_id, round({_dot("x", "u")} ** 2 + {_dot("x", "v")} ** 2 + {_dot("x", "w")} ** 2, 6) AS length
FROM vectors, axes""",
    "silhouette_given": f"""WITH {_VECTOR_PARTS}, {_TO_GROUPS},
means AS (SELECT *, norm + squares / n - 2 * dot / n AS d FROM met),
pairs AS (
  SELECT point, max(CASE WHEN own = other AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d END) AS b
  FROM means GROUP BY point)
SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) <= 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM pairs""",
    "lloyd_given": _lloyd(3),
    "read_merged_snapshots": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS DOUBLE) AS quantity,
       CASE WHEN l_linenumber <= 2 THEN l_returnflag END AS flag, CASE WHEN l_linenumber > 3 THEN 'new' END AS extra,
       CASE WHEN l_linenumber <= 2 THEN DATE '2024-01-01' WHEN l_linenumber = 3 THEN DATE '2024-01-02' ELSE DATE '2024-01-03' END AS snapshot_date
FROM lineitem""",
    "daily_scores_final": f"""WITH {MASTER},
changed AS (
  SELECT * REPLACE (
    CASE WHEN CAST(cve_id AS BIGINT) % 10 = 3 THEN 9.5e0 ELSE cvss_score END AS cvss_score,
    CASE WHEN CAST(cve_id AS BIGINT) % 20 = 3 THEN published + 366 ELSE published END AS published)
  FROM master),
weighted AS (
  SELECT *, CASE WHEN cve_id NOT LIKE '%3' THEN CAST(CAST(cve_id AS BIGINT) % 7 AS INTEGER) END AS cluster_id,
         round(0.4e0 * (coalesce(cvss_score, 0e0) / 10e0) + 0.4e0 * epss_percentile + 0.2e0 * is_kev, 4) AS plain
  FROM changed),
scored AS (
  SELECT *, CASE WHEN is_kev = 1 THEN greatest(plain, 0.9e0) ELSE plain END AS priority_score FROM weighted),
stats AS (
  SELECT cluster_id, count(*) AS cluster_size, avg(is_kev) AS density, max(epss_score) AS top_epss
  FROM scored WHERE cluster_id IS NOT NULL GROUP BY cluster_id),
boosted AS (
  SELECT scored.*, cluster_size,
         least(1.5e0, greatest(0e0, priority_score * (1e0 + 0.5e0 * coalesce(density, 0e0)) + 0.1e0 * coalesce(top_epss, 0e0))) AS boosted_score
  FROM scored LEFT JOIN stats USING (cluster_id))
SELECT cve_id, CAST(published AS DATE) AS published, epss_score, is_kev, cluster_id, cluster_size, priority_score, {LEVEL.format("priority_score")} AS priority_level,
       round(boosted_score, 6) AS priority_score_final, {LEVEL.format("boosted_score")} AS priority_level_final
FROM boosted""",
    "numeric_features": f"""WITH {MASTER}
SELECT cve_id, coalesce(cvss_score, 0e0) / 10e0 AS cvss_scaled, epss_percentile, is_kev FROM master""",
    "davies_bouldin_given": """WITH parts AS (
  SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
centres AS (SELECT label, i, avg(x) AS c FROM parts GROUP BY ALL),
distances AS (
  SELECT vec_id, label, sqrt(sum((x - c) * (x - c))) AS d FROM parts JOIN centres USING (label, i) GROUP BY ALL),
spreads AS (SELECT label, avg(d) AS s FROM distances GROUP BY label),
gaps AS (
  SELECT a.label AS p, b.label AS q, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS gap
  FROM centres a JOIN centres b ON a.i = b.i AND a.label <> b.label GROUP BY ALL),
worst AS (
  SELECT p, max((x.s + y.s) / gap) AS w FROM gaps JOIN spreads x ON p = x.label JOIN spreads y ON q = y.label
  GROUP BY p)
SELECT round(avg(w), 6) AS davies_bouldin FROM worst""",
    "best_count_given": """WITH measures AS (
  SELECT l_linenumber AS k, round(avg(l_discount), 9) AS silhouette, round(sum(l_tax), 6) AS cost,
         round(avg(l_quantity), 9) AS db FROM lineitem GROUP BY 1),
ranked AS (
  SELECT k, row_number() OVER (ORDER BY silhouette DESC, k) + row_number() OVER (ORDER BY cost, k)
            + row_number() OVER (ORDER BY db, k) AS total FROM measures)
SELECT CAST(k AS INTEGER) AS k FROM ranked ORDER BY total, k LIMIT 1""",
    "attach_given_clusters": f"""WITH {MASTER}
SELECT cve_id, is_kev,
       CASE WHEN cve_id NOT LIKE '%3' THEN CAST(CAST(cve_id AS BIGINT) % 7 AS INTEGER) END AS cluster_id
FROM master""",
    "scoring_nan": f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN 0e0 ELSE value END AS number,
       CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN 'Unknown' ELSE {LEVEL.format("value")} END AS level
FROM events""",
    "action_details": f"""
SELECT primary_vendor, primary_product,
       array_to_string(list_slice(string_split(top_cves, ','), 1, 3), ',') AS top_cves
FROM (WITH {FINAL},{_actions('final', 'priority_score_final')})""",
}
