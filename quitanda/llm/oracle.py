"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from quitanda.llm.mixing import MAX_RATE, SEED, WEIGHTS
from quitanda.llm.urls import ESCAPED_LETTERS, LIMIT, RULES, SOFT, STRICT

QUALITY = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows
  ) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT doc_id, i, unnest([0, 1, 2, 3, 4]) AS k FROM repeated) GROUP BY doc_id
), features AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)),
          lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_no_letter,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z][A-Z]'))) AS n_shouted
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM features
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR 100 * n_symbols > 20 * n_words
    OR 100 * n_exclamations > 30 * n_words
    OR 100 * n_no_letter > 30 * n_words
    OR 100 * n_shouted > 50 * n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM judged
"""


def _url_filter() -> str:
    rules = "\n".join(
        f"    WHEN (host = '{domain}' OR ends_with(host, '.{domain}'))"
        f" AND starts_with(path, '/{start}') THEN '{{{verdict}}}{rule}'"
        for verdict, rule in sorted(RULES, key=lambda pair: -len(pair[1]))
        for domain, _, start in [rule.partition("/")]
    )
    edge = "[^a-z0-9]"

    def has(term: str) -> str:
        return f"regexp_matches(body, '(^|{edge}){term}({edge}|$)')"

    body = (
        "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    for escape, letter in ESCAPED_LETTERS:
        body = f"replace({body}, '{escape}', '{letter}')"
    strict = " OR ".join(map(has, STRICT))
    soft = " + ".join(f"CAST({has(term)} AS INT) * {weight}" for term, weight in SOFT.items())
    return rf"""
WITH parts AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (
  SELECT *, {body} AS body,
    CASE
{rules}
    END AS found
  FROM parts
)
SELECT page_id, host, path, regexp_replace(found, '^[{{][a-z]*[}}]', '') AS rule,
  CASE WHEN starts_with(found, '{{allow}}') THEN 'allow'
    WHEN starts_with(found, '{{block}}') THEN 'block'
    WHEN {strict} THEN 'block'
    WHEN {soft} >= {LIMIT} THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


def _mixing() -> str:
    weights = ", ".join(map(str, WEIGHTS))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, text,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CAST(([{weights}])[CAST(place % {len(WEIGHTS)} AS INT) + 1] AS HUGEINT) AS weight,
    CAST({MAX_RATE} * source_size AS HUGEINT) AS cap
  FROM sources
), total AS (
  SELECT sum(CAST(source_size AS HUGEINT)) AS words FROM weighted
), cut AS (
  SELECT a.source, sum(least(b.cap * a.weight, a.cap * b.weight)) <= any_value(words) * a.weight AS above
  FROM weighted a, weighted b, total GROUP BY a.source, a.weight, a.cap
), rest AS (
  SELECT CAST(any_value(words) - coalesce(sum(cap) FILTER (above), 0) AS DOUBLE) AS budget,
    CAST(sum(weight) FILTER (NOT above) AS DOUBLE) AS weights
  FROM weighted w JOIN cut c ON w.source IS NOT DISTINCT FROM c.source, total
), targets AS (
  SELECT w.source, source_size,
    CASE WHEN above THEN CAST(cap AS DOUBLE) ELSE budget * CAST(weight AS DOUBLE) / weights END AS target
  FROM weighted w JOIN cut c ON w.source IS NOT DISTINCT FROM c.source, rest
), rated AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / CAST(source_size AS DOUBLE) ELSE 0.0::DOUBLE END AS rate,
    CAST(CAST('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR), text)), 1, 8)
      AS UBIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS chance
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (CAST(floor(rate) AS BIGINT) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM rated
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": QUALITY,
        "op5_url_filter": _url_filter(),
        "op13_mixing": _mixing(),
    }
