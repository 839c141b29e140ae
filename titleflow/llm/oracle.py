"""DuckDB SQL of the queries that SQL can express, written apart from the
Spark code (own patterns, own rule conditions)."""

from __future__ import annotations

from titleflow.llm import collocations

_WORD = r"[^\x20\x09-\x0D]+"

#: Ledger rows of a table ``{docs}`` (rid, doc_id, text).
QUALITY = rf"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {{docs}}),
w AS (SELECT rid, unnest(regexp_extract_all(t, '{_WORD}')) AS word,
             generate_subscripts(regexp_extract_all(t, '{_WORD}'), 1) AS i FROM docs),
tri AS (SELECT rid, i, word, lead(word, 1) OVER d AS w2, lead(word, 2) OVER d AS w3
        FROM w WINDOW d AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY rid, word, w2, w3) > 1 AS twice FROM tri),
cov AS (SELECT rid, i, twice OR coalesce(lag(twice, 1) OVER d, false) OR coalesce(lag(twice, 2) OVER d, false) AS c
        FROM rep WINDOW d AS (PARTITION BY rid ORDER BY i)),
rw AS (SELECT rid, count(*) FILTER (c) AS n_repeat_words FROM cov GROUP BY rid),
ws AS (SELECT rid, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
              count(*) FILTER (regexp_matches(word, '[^\x00-\x40\x5B-\x60\x7B-\x7F]')) AS n_letter_words
       FROM w GROUP BY rid),
ls AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM docs),
m AS (SELECT rid, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
             coalesce(n_letter_words, 0) AS n_letter_words,
             len(regexp_extract_all(t, '[A-Z]{{2,}}')) AS n_capital_runs
      FROM docs JOIN ls USING (rid) LEFT JOIN ws USING (rid) LEFT JOIN rw USING (rid)),
ledger AS (SELECT *,
    (n_words < 50)::BIGINT + 2 * (2 * n_repeat_words > n_words)::BIGINT
    + 4 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT
    + 8 * (n_symbols * 10 > n_words)::BIGINT + 16 * (5 * n_dup_lines > 3 * n_lines)::BIGINT
    + 32 * (10 * n_letter_words < 7 * n_words)::BIGINT + 64 * (2 * n_capital_runs > n_words)::BIGINT AS failed_bits
    FROM m)"""

OP5 = "WITH " + QUALITY.replace("{docs}", "documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept,
       n_lines, n_letter_words, n_capital_runs, failed_bits FROM ledger"""


#: The base32 digits of a SHA-1 in hex: 5 hex digits hold 4 base32 digits.
OP7 = r"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, url, octet_length(b) AS payload_bytes, sha1(b) AS h FROM p),
g AS (SELECT h, max(page_id) AS keeper FROM d GROUP BY h HAVING count(*) > 1)
SELECT page_id, url, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::BIGINT) >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN keeper IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM d LEFT JOIN g USING (h)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": OP5, "op7_warc": OP7, "op12_collocations": collocations.SQL}
