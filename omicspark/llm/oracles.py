"""DuckDB SQL of the queries that SQL can express; doc_id is taken to be unique, as in the given tables."""

from __future__ import annotations

from . import line_templates, quality, warc

_SPLIT = r"'[\x20\x09-\x0D]+'"
_WITH_WORD = r"'[^\x20\x09-\x0D]'"


def quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
    bounds = " AND ".join(f"{name} {op} {limit}" for name, least, most in quality.THRESHOLDS for op, limit in ((">=", least), ("<=", most)) if limit is not None)
    symbols = quality.SYMBOLS.replace("'", "''")
    ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN ({a}) / ({b}) ELSE 0 END"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, [x FOR x IN regexp_split_to_array(t, {_SPLIT}) IF x <> ''] AS w, [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, {_WITH_WORD})] AS ls FROM d),
g AS (SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS s FROM w, unnest(range(1, len(w) - 1)) u(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, unnest([0, 1, 2]) v(k) GROUP BY 1),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, {_SPLIT}, '', 'g')) AS BIGINT) AS word_chars, CAST(length(t) - length(translate(t, '{symbols}', '')) AS BIGINT) AS n_symbols,
 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
 len([x FOR x IN w IF x IN ({stop})]) AS stops, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS upper,
 len([l FOR l IN ls IF regexp_matches(l, '^\s*[-*•]')]) AS bullets, len([l FOR l IN ls IF regexp_matches(l, '(\.\.\.|…)\s*$')]) AS dots FROM w LEFT JOIN c USING (doc_id)),
q AS (SELECT *, {ratio("word_chars", "n_words")} AS mean_word_chars, {ratio("n_symbols", "n_words")} AS symbol_ratio, {ratio("stops", "n_words")} AS stop_word_ratio, {ratio("n_dup_lines", "n_lines")} AS dup_line_ratio,
 {ratio("upper", "word_chars")} AS upper_ratio, {ratio("bullets", "n_lines")} AS bullet_line_ratio, {ratio("dots", "n_lines")} AS ellipsis_line_ratio,
 n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {bounds} AS kept FROM q"""


def line_templates_sql() -> str:
    lead = f"greatest({line_templates.DEPTH}, CAST(ceil({line_templates.SHARE} * len(w)) AS BIGINT))"
    return rf"""
WITH l AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line, text IS NULL AS missing FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) u(i)),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(regexp_replace(line, '\S*\d\S*', '<*>', 'g'), '\s+') IF x <> ''] AS w FROM l),
t AS (SELECT doc_id, i, line, missing, CASE WHEN len(w) >= {line_templates.MIN_TOKENS} THEN concat(len(w), ' ', array_to_string(w[1:{lead}], ' ')) END AS t FROM w),
o AS (SELECT t, min(doc_id) AS first FROM t WHERE t IS NOT NULL GROUP BY 1 HAVING count(DISTINCT doc_id) >= {line_templates.MIN_DOCS}),
k AS (SELECT doc_id, i, line, missing, coalesce(o.first <> doc_id, false) AS gone FROM t LEFT JOIN o USING (t))
SELECT doc_id, CASE WHEN bool_or(missing) THEN 0 ELSE count(*) END AS n_lines, count(*) FILTER (gone) AS n_dropped, CASE WHEN NOT bool_or(missing) THEN sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) END AS kept_sha256 FROM k GROUP BY 1"""


def warc_sql() -> str:
    return f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to FROM r"""
