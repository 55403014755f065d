"""DuckDB SQL for the queries: shared common table expressions, and one final select each."""

from __future__ import annotations

from ..functions.normalize import ENGLISH_RULES, FRENCH_RULES, LEGAL_SUFFIXES

W = r"\p{L}\p{N}_"


def _rules(column: str, rules: list[tuple[str, str]]) -> str:
    for pattern, word in rules:
        column = rf"regexp_replace({column}, '([^{W}])(?:{pattern})([^{W}])', '\1{word}\2', 'g')"
    return column


_EN = _rules("d", ENGLISH_RULES)
_FR = _rules("en", FRENCH_RULES)


def _postings(prefix: str, counts: str, vocab: str) -> str:
    return f"""
{prefix}_raw AS MATERIALIZED (SELECT c.country, c.term, c.entity_id, c.tf * v.idf AS w FROM {counts} c JOIN {vocab} v USING (country, term)),
{prefix}_norm AS (SELECT country, entity_id, sqrt(sum(w * w)) AS norm FROM {prefix}_raw GROUP BY ALL),
{prefix} AS MATERIALIZED (SELECT r.country, r.term, r.entity_id, r.w / n.norm AS weight FROM {prefix}_raw r JOIN {prefix}_norm n USING (country, entity_id))"""


def _counts(name: str, source: str, terms: str, country: str = "country") -> str:
    return f"""
{name} AS MATERIALIZED (SELECT entity_id, country, term, count(*) AS tf FROM (SELECT entity_id, {country} AS country, unnest({terms}) AS term FROM {source}) GROUP BY ALL)"""


def _vocab(name: str, counts: str, min_df: int, most: int) -> str:
    return f"""
{name} AS MATERIALIZED (SELECT country, term, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
  SELECT country, term, count(*) AS df, row_number() OVER (PARTITION BY country ORDER BY sum(tf) DESC, term) AS r FROM {counts} GROUP BY country, term HAVING count(*) >= {min_df}
) JOIN sizes USING (country) WHERE r <= {most})"""


_WORDS = r"regexp_extract_all(lower(clean_text), '[\p{L}\p{N}_]{2,}')"
_CHARS = r"""flatten(list_transform(list_filter(string_split_regex(lower(clean_text), '\s+'), lambda x: x <> ''), lambda x: list_transform(range(1, length(x) + 1), lambda k: substr(' ' || x || ' ', k, 3))))"""
_LEFT = r"regexp_replace(coalesce(text, ''), '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g')"

CTES = rf"""
w AS (SELECT *, string_split_regex({_LEFT}, '[ \t\n\r]+') AS w FROM documents),
records AS MATERIALIZED (SELECT doc_id, 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id,
  array_to_string(w[1:4], ' ') || CASE doc_id % 4 WHEN 0 THEN ' Inc' WHEN 1 THEN ' Pvt Ltd' WHEN 2 THEN ' SARL' ELSE '' END AS business_name,
  n_chars || ' ' || array_to_string(w[5:], ' ') || ' ' || (10000 + n_chars) AS business_address,
  CASE lang WHEN 'en' THEN 'US' WHEN 'de' THEN 'India' WHEN 'fr' THEN 'France' WHEN 'es' THEN 'Spain' END AS raw_country FROM w),
n1 AS (SELECT *, upper(trim(coalesce(raw_country, 'UNKNOWN'))) AS country,
  trim(regexp_replace(replace(replace(lower(strip_accents(coalesce(business_name, ''))), '&', ' and '), '@', ' at '), '[^{W}]+', ' ', 'g')) AS sp,
  ' ' || regexp_replace(replace(replace(lower(strip_accents(coalesce(business_address, ''))), '#', ' unit '), '/', ' '), '([^{W}])', '\1\1', 'g') || ' ' AS d,
  regexp_extract_all(' ' || regexp_replace(coalesce(business_address, ''), '([^{W}])', '\1\1', 'g') || ' ', '[^{W}](\p{{Nd}}{{1,6}})[^{W}]', 1) AS nums FROM records),
n2 AS (SELECT *, regexp_extract(sp, '(?:^|[^{W}])((?:{'|'.join(LEGAL_SUFFIXES)}))$', 1) AS legal_suffix, {_EN} AS en, list_filter(nums, lambda v, i: list_position(nums, v) = i) AS extracted_numbers FROM n1),
n3 AS (SELECT *, trim(left(sp, length(sp) - length(legal_suffix))) AS rest, trim(regexp_replace(CASE WHEN country = 'FRANCE' THEN {_FR} ELSE en END, '[^{W}]+', ' ', 'g')) AS clean_address FROM n2),
norm AS MATERIALIZED (SELECT doc_id, entity_id, country, CASE WHEN rest = '' THEN sp ELSE rest END AS clean_name, legal_suffix, clean_address, extracted_numbers,
  CASE WHEN rest = '' THEN sp ELSE rest END || ' | ' || clean_address || ' | ' || country AS clean_text FROM n3),
s1 AS (SELECT * FROM norm WHERE entity_id LIKE 'S1-%'),
tgt AS (SELECT * FROM norm WHERE entity_id NOT LIKE 'S1-%'),
same AS (SELECT entity_id, raw_country, sha256(regexp_replace({_LEFT}, '[ \t\n\r]+', ' ', 'g')) AS h FROM records JOIN documents USING (doc_id)),
truth AS MATERIALIZED (SELECT a.entity_id AS source1_entity_id, b.entity_id AS matched_id FROM same a JOIN same b USING (h) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%'),
sizes AS (SELECT country, count(*) AS n FROM tgt GROUP BY country),
qmap AS (SELECT s1.*, sizes.country AS target FROM s1 JOIN sizes ON s1.country = sizes.country UNION ALL SELECT s1.*, sizes.country AS target FROM s1, sizes WHERE s1.country NOT IN (SELECT country FROM sizes)),
{_counts('wc', 'tgt', _WORDS)}, {_vocab('wv', 'wc', 2, 35000)}, {_postings('wp', 'wc', 'wv')},
{_counts('cc', 'tgt', _CHARS)}, {_vocab('cv', 'cc', 1, 40000)}, {_postings('cp', 'cc', 'cv')},
{_counts('wqc', 'qmap', _WORDS, 'target')}, {_postings('wq', 'wqc', 'wv')},
{_counts('cqc', 'qmap', _CHARS, 'target')}, {_postings('cq', 'cqc', 'cv')},
wsim AS (SELECT q.country, q.entity_id AS s, t.entity_id AS c, round(sum(q.weight * t.weight), 9) AS word FROM wq q JOIN wp t USING (country, term) GROUP BY ALL HAVING round(sum(q.weight * t.weight), 9) > 0),
pool AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country, s ORDER BY word DESC, c) AS r FROM wsim) WHERE r <= 60),
csim AS (SELECT p.country, p.s, p.c, sum(q.weight * t.weight) AS chars FROM pool p JOIN cq q ON q.country = p.country AND q.entity_id = p.s JOIN cp t ON t.country = p.country AND t.entity_id = p.c AND t.term = q.term GROUP BY ALL),
alone AS (SELECT q.country, q.entity_id AS s, t.entity_id AS c, round(sum(q.weight * t.weight), 9) AS score FROM cq q JOIN cp t USING (country, term) WHERE NOT EXISTS (SELECT 1 FROM pool p WHERE p.country = q.country AND p.s = q.entity_id) GROUP BY ALL),
both_ AS (SELECT country, s, c, round(0.5 * word + 0.5 * coalesce(chars, 0.0), 9) AS score FROM pool LEFT JOIN csim USING (country, s, c) UNION ALL SELECT * FROM alone),
lex AS MATERIALIZED (SELECT * FROM (SELECT country, s, c, score, row_number() OVER (PARTITION BY country, s ORDER BY score DESC, c) AS r FROM both_ WHERE score > 0) JOIN sizes USING (country) WHERE r <= least(80, n)),
lex2 AS (SELECT * FROM (SELECT s, c, score, row_number() OVER (PARTITION BY s ORDER BY score DESC, c) AS r FROM lex) WHERE r <= 80),
fused AS MATERIALIZED (SELECT * FROM (SELECT s AS source1_entity_id, c AS candidate_entity_id, round(1.0 / (60 + r), 12) AS rrf, r AS lexical_rank, score AS sim, row_number() OVER (PARTITION BY s ORDER BY round(1.0 / (60 + r), 12) DESC, score DESC, c) AS fused_rank FROM lex2) WHERE fused_rank <= 40),
labelled AS (SELECT f.*, CASE WHEN t.matched_id IS NULL THEN 0 ELSE 1 END AS label FROM fused f LEFT JOIN (SELECT DISTINCT * FROM truth) t ON t.source1_entity_id = f.source1_entity_id AND t.matched_id = f.candidate_entity_id),
n_true AS (SELECT s1.entity_id AS source1_entity_id, count(DISTINCT matched_id) AS n_true FROM s1 LEFT JOIN truth ON truth.source1_entity_id = s1.entity_id GROUP BY ALL),
best AS (SELECT *, max(sim) OVER (PARTITION BY source1_entity_id) AS best FROM labelled),
gated AS (SELECT * FROM best WHERE best >= 0.75 AND sim >= 0.90 AND best - sim <= 0.11),
ent AS (SELECT n.source1_entity_id, n_true, count(candidate_entity_id) AS n_pred, coalesce(sum(label), 0)::BIGINT AS n_hit FROM n_true n LEFT JOIN gated g USING (source1_entity_id) GROUP BY ALL),
scores AS (SELECT *, CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN n_pred = 0 OR n_true = 0 OR n_hit = 0 THEN 0.0 ELSE 1.25 * (n_hit / n_pred) * (n_hit / n_true) / (0.25 * (n_hit / n_pred) + n_hit / n_true) END AS f05 FROM ent),
"""


def sql(final: str, more: str = "", without: str | None = None) -> str:
    """without: a country that no target has."""
    shared = CTES.replace("WHERE entity_id NOT LIKE 'S1-%'),", f"WHERE entity_id NOT LIKE 'S1-%' AND country <> '{without}'),") if without else CTES
    return f"WITH {(shared + more).strip().rstrip(',')}\n{final}"


def trials(rows: list[tuple[int, int, int, int]]) -> str:
    """CTEs that evaluate settings (top_k, tau_s, tau_m, delta in percent)."""
    values = ", ".join(f"({k}, {a}, {b}, {c}, {d})" for k, (a, b, c, d) in enumerate(rows))
    return f"""
settings(trial, top_k, tau_s, tau_m, delta) AS (VALUES {values}),
used AS (SELECT trial, tau_s, tau_m, delta, l.*, max(sim) OVER (PARTITION BY trial, source1_entity_id) AS best FROM labelled l JOIN settings ON fused_rank <= top_k),
t_sums AS (SELECT trial, source1_entity_id, count(*) FILTER (ok) AS n_pred, count(*) FILTER (ok AND label = 1) AS n_hit, count(*) AS n_any FROM (
  SELECT *, best >= tau_s / 100.0 AND sim >= tau_m / 100.0 AND round(best - sim, 9) <= delta / 100.0 AS ok FROM used) GROUP BY ALL),
t_ent AS (SELECT s.*, n.source1_entity_id, n_true, coalesce(n_pred, 0) AS n_pred, coalesce(n_hit, 0) AS n_hit, coalesce(n_any, 0) AS n_any FROM n_true n CROSS JOIN settings s LEFT JOIN t_sums USING (trial, source1_entity_id)),
metrics AS (SELECT trial::INTEGER AS trial, top_k::INTEGER AS top_k, tau_s::INTEGER AS tau_s, tau_m::INTEGER AS tau_m, delta::INTEGER AS delta,
  round(avg(CASE WHEN n_pred = 0 AND n_true = 0 THEN 1.0 WHEN n_pred = 0 OR n_true = 0 OR n_hit = 0 THEN 0.0 ELSE 1.25 * (n_hit / n_pred) * (n_hit / n_true) / (0.25 * (n_hit / n_pred) + n_hit / n_true) END), 4) AS macro_f05,
  round(coalesce(avg(CASE WHEN n_pred > 0 THEN n_hit / n_pred ELSE 0.0 END) FILTER (n_any > 0 AND (n_pred > 0 OR n_true > 0)), 0.0), 4) AS macro_precision,
  round(coalesce(avg(CASE WHEN n_true > 0 THEN n_hit / n_true ELSE 0.0 END) FILTER (n_any > 0 AND (n_pred > 0 OR n_true > 0)), 0.0), 4) AS macro_recall,
  round(CASE WHEN count(*) FILTER (n_true = 0) > 0 THEN count(*) FILTER (n_true = 0 AND n_pred = 0) / count(*) FILTER (n_true = 0) ELSE 1.0 END, 4) AS singleton_acc
  FROM t_ent GROUP BY ALL),
"""
