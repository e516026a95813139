"""Reference SQL (DuckDB) of those queries that SQL can express."""

from __future__ import annotations

from candlewick.llm.quality import FENCE, MIN_GROUP, RATES

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x20\x09-\x0D]+"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, line, pos, translate(trim(line, {_BLANKS}), {_LOWER}) AS key
  FROM (
    SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
  )
), shared AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT lines.*, coalesce(doc_id < last, false) AS dropped FROM lines LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_LEVELS = {"own": "lang, source", "by_lang": "lang", "whole": ""}


def _bounds(name: str, keys: str) -> str:
    by = f"{keys}, rate" if keys else "rate"
    return f"""
{name} AS (
  SELECT {by}, total,
    q1 - {FENCE} * greatest(q3 - q1, q2 // 4, least_gap) AS low,
    q3 + {FENCE} * greatest(q3 - q1, q2 // 4, least_gap) AS high
  FROM (
    SELECT {by}, total, any_value(least_gap) AS least_gap,
      min(bucket) FILTER (WHERE upto * 4 >= total) AS q1,
      min(bucket) FILTER (WHERE upto * 4 >= total * 2) AS q2,
      min(bucket) FILTER (WHERE upto * 4 >= total * 3) AS q3
    FROM (
      SELECT {by}, bucket, least_gap, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto,
        sum(n) OVER (PARTITION BY {by}) AS total
      FROM (SELECT {by}, bucket, any_value(least_gap) AS least_gap, sum(n) AS n
            FROM sketch GROUP BY {by}, bucket)
    ) GROUP BY {by}, total
  )
)"""


QUALITY_RULES = rf"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents)
), windows AS (
  SELECT doc_id, pos, {" || ' ' || ".join(f"lead(word, {k}) OVER (PARTITION BY doc_id ORDER BY pos)" for k in range(8))} AS words
  FROM words
), repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(pos, pos + 8)) AS place FROM (
      SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, words) AS found
      FROM windows WHERE words IS NOT NULL
    ) WHERE found > 1
  ) GROUP BY doc_id
), word_sums AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM words GROUP BY doc_id
), line_sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, lang, source, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Z]', '', 'g')) AS n_upper,
    coalesce(n_lines, 0) AS n_lines
  FROM documents d LEFT JOIN word_sums USING (doc_id) LEFT JOIN line_sums USING (doc_id)
    LEFT JOIN repeats USING (doc_id)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), rated AS (
  SELECT doc_id, lang, source, base_failed, unnest([
    {{'rate': 'chars_per_word', 'v': if(n_words > 0, word_chars * 1000 // n_words, 0)}},
    {{'rate': 'symbols_per_word', 'v': if(n_words > 0, n_symbols * 1000 // n_words, 0)}},
    {{'rate': 'upper_per_char', 'v': if(word_chars > 0, n_upper * 1000 // word_chars, 0)}},
    {{'rate': 'dup_lines_per_line', 'v': if(n_lines > 0, n_dup_lines * 1000 // n_lines, 0)}}
  ], recursive := true)
  FROM based
), sketch AS (
  SELECT lang, source, rate, (v >> shift) << shift AS bucket, count(*) AS n,
    CASE rate {" ".join(f"WHEN '{name}' THEN {gap}" for name, gap in RATES.items())} END AS least_gap
  FROM (SELECT *, greatest(0, length(bin(v)) - 7) AS shift FROM rated WHERE NOT base_failed)
  GROUP BY ALL
), {", ".join(_bounds(name, keys) for name, keys in _LEVELS.items())}
, inside AS (
  SELECT doc_id, bool_and(coalesce(v BETWEEN
      CASE WHEN own.total >= {MIN_GROUP} THEN own.low WHEN by_lang.total >= {MIN_GROUP} THEN by_lang.low ELSE whole.low END
      AND
      CASE WHEN own.total >= {MIN_GROUP} THEN own.high WHEN by_lang.total >= {MIN_GROUP} THEN by_lang.high ELSE whole.high END,
      true)) AS ok
  FROM rated r
    LEFT JOIN own ON r.lang IS NOT DISTINCT FROM own.lang AND r.source IS NOT DISTINCT FROM own.source AND r.rate = own.rate
    LEFT JOIN by_lang ON r.lang IS NOT DISTINCT FROM by_lang.lang AND r.rate = by_lang.rate
    LEFT JOIN whole ON r.rate = whole.rate
  GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ok AS kept
FROM based JOIN inside USING (doc_id)
"""

_HOST_RULES = (
    ("www.example.com", "/en/", "allow"),
    ("example.com", "/en/", "block"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
    ("com", "/", "allow"),
)


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR host LIKE '%.{host}') AND starts_with(path, '{path}')"


URL_FILTER = rf"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN split_part(substr(url, position('://' IN url) + 3), '#', 1) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest, split_part(split_part(rest, '?', 1), '/', 1) AS raw_host,
    split_part(rest, '?', 1) AS site FROM rest
), split AS (
  SELECT page_id, translate(raw_host, {_LOWER}) AS host, substr(site, length(raw_host) + 1) AS path,
    translate(raw_host, {_LOWER}) || substr(rest, length(raw_host) + 1) AS canonical
  FROM parts
), ruled AS (
  SELECT *, CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _HOST_RULES)} END AS rule
  FROM split
)
SELECT page_id, host, path, rule,
  CASE {" ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in _HOST_RULES)}
    WHEN regexp_matches(canonical, '^[^/]*casino[^/]*/')
      OR contains(canonical, '/login') OR contains(canonical, '/wp-admin/')
      OR ends_with(canonical, '.exe') OR ends_with(canonical, '.zip')
      OR regexp_matches(canonical, '(?s)\?.*sessionid=') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

TOP_K = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id,
    list_sum(list_transform(list_zip(q.v, p.v), lambda x: x[1] * x[2]))::BIGINT AS score
  FROM sound q JOIN sound p ON q.vec_id % 20 = 0 AND q.vec_id <> p.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

HARD_NEGATIVES = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, p.vec_id, a.label = p.label AS same,
    coalesce(list_sum(list_transform(list_zip(a.v, p.v), lambda x: x[1] * x[2])), 0)::BIGINT AS score
  FROM sound a JOIN sound p ON a.vec_id % 100 = 0 AND a.vec_id <> p.vec_id
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""

ORACLES: dict[str, str] = {
    "op4_exact_top_k": TOP_K,
    "op6_url_filter": URL_FILTER,
    "op8_line_dedup": LINE_DEDUP,
    "op10_quality_rules": QUALITY_RULES,
    "op13_hard_negatives": HARD_NEGATIVES,
}
