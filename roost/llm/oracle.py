"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
_WORDS = rf"regexp_extract_all({{}}, '{WORD}')"


def words(text: str) -> str:
    return _WORDS.format(text)


def _count(text: str, piece: str) -> str:
    return f"((length({text}) - length(replace({text}, '{piece}', ''))) // {len(piece)})"


_MARKS = "length(regexp_replace(l, '[^#*$%&<>]+', '', 'g'))"
_N = f"len({words('l')})"
_NOTICES = " + ".join(_count("l", phrase) for phrase in (
    "ll rights reserved", "erms of use", "erms of service", "rivacy policy", "ookie policy", "ses cookies",
    "nable javascript", "nable JavaScript", "ubscribe to our", "orem ipsum", "icensed under ", "eleased under ",
))
_FAILS = f"""({_N} > 0 AND (({_MARKS} >= 3 AND {_MARKS} * 2 >= {_N})
    OR ({_count('l', '!!')} >= 3 AND {_count('l', '!!')} * 2 >= {_N})
    OR ({_count('l', '|')} >= 3 AND {_count('l', '|')} * 4 >= {_N})
    OR (n_stutters >= 3 AND n_stutters * 3 >= {_N})
    OR ({_NOTICES} > 0 AND ({_NOTICES}) * 20 >= {_N})))"""


def quality(source: str) -> str:
    """CTEs ending in ``judged``, one row for each row of ``source`` (with a unique ``rid``)."""
    return f"""q_docs AS (SELECT *, coalesce(text, '') AS body FROM {source}),
q_words AS (SELECT rid, {words('body')} AS w FROM q_docs),
q_parts AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM q_words),
q_windows AS (SELECT rid, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
  lead(word, 4) OVER o) AS v, lead(word, 4) OVER o AS last FROM q_parts WINDOW o AS (PARTITION BY rid ORDER BY i)),
q_keyed AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, v) AS n FROM q_windows WHERE last IS NOT NULL),
q_steps AS (SELECT rid, least(5, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 5)) AS step
  FROM q_keyed WHERE n > 1),
q_repeats AS (SELECT rid, sum(step) AS n_repeat_words FROM q_steps GROUP BY rid),
q_lines0 AS (SELECT rid, unnest(string_split(body, chr(10))) AS l,
  unnest(range(1, len(string_split(body, chr(10))) + 1)) AS k FROM q_docs),
q_lines1 AS (SELECT rid, k, l, {words('l')} AS lw FROM q_lines0),
q_pairs AS (SELECT rid, k, unnest(lw[2:]) AS b, unnest(lw[1:len(lw) - 1]) AS a FROM q_lines1 WHERE len(lw) > 1),
q_stutter AS (SELECT rid, k, count(*) AS n_stutters FROM q_pairs WHERE a = b GROUP BY rid, k),
q_lines AS (SELECT rid, k, l, {_N} AS n, {_FAILS} AS failed
  FROM (SELECT c.rid, c.k, l, coalesce(n_stutters, 0) AS n_stutters FROM q_lines1 c LEFT JOIN q_stutter s USING (rid, k))),
q_line_sums AS (SELECT rid, coalesce(sum(n) FILTER (failed), 0) AS lost,
  count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines,
  coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (NOT failed), '') AS clean_text FROM q_lines GROUP BY rid),
q_counts AS (SELECT d.* EXCLUDE (body), len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, lost, clean_text
  FROM q_docs d JOIN q_words USING (rid) JOIN q_line_sums USING (rid) LEFT JOIN q_repeats USING (rid)),
q_base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM q_counts),
judged AS (SELECT *, NOT base_failed AND 100 * lost <= 30 * n_words AS kept FROM q_base)"""


_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
DIVERGENCE = rf"""WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source, translate(coalesce(text, ''), {_A_TO_Z}) AS body FROM documents),
tokens AS (SELECT rid, lang, source,
  unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM (SELECT DISTINCT rid, lang, term FROM tokens)
  GROUP BY lang, term HAVING count(*) >= 3),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
langs AS (SELECT lang, sum(n) AS total FROM counts GROUP BY lang),
sizes AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source
  GROUP BY g.lang, g.source),
groups AS (SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n,
  1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 1) // (s.total + v) AS p
  FROM sizes s JOIN vocabulary USING (lang) JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
wholes AS (SELECT c.lang, c.term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 1) // (any_value(total) + any_value(v)) AS q
  FROM counts c JOIN langs USING (lang) JOIN vocabulary USING (lang) GROUP BY c.lang, c.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(d), 0) AS value
  FROM sizes a JOIN sizes b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // y.p) AS d
    FROM groups x JOIN groups y ON x.lang = y.lang AND x.term = y.term GROUP BY x.lang, x.source, y.source) z
  ON z.lang = a.lang AND z.source = a.source AND z.other = b.source GROUP BY a.lang, a.source, b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
  FROM groups JOIN wholes USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""

ORACLE: dict[str, str] = {
    "op11_source_divergence": DIVERGENCE,
    "op5_quality_rules": f"""WITH src AS (SELECT row_number() OVER () AS rid, * FROM documents),
{quality('src')}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, kept FROM judged""",
}
