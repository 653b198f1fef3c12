"""SQL for the operators whose whole result SQL can express."""

from __future__ import annotations


def _shingles(table: str, key: str, lower: str) -> str:
    """(key, s): the distinct five-word shingles of each row; fewer words are one shingle."""
    return f"""
{table}_words AS (
  SELECT {key}, list_filter(string_split_regex({lower}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table}
),
{table}_shingles AS (
  SELECT {key}, unnest(list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i+4], ' ')))) AS s
  FROM {table}_words WHERE len(w) > 0
)"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": f"""WITH {_shingles('documents', 'doc_id', 'lower(text)')}, {_shingles('benchmark', 'item_id', 'lower(text)')},
sizes AS (SELECT item_id, count(*) AS n_item FROM benchmark_shingles GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_found, count(*) / n_item AS containment
FROM benchmark_shingles JOIN documents_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) * 100 >= n_item * 80""",
    "op5_near_duplicates": f"""WITH RECURSIVE {_shingles('documents', 'doc_id', f"translate(text, '{_UPPER}', '{_LOWER}')")},
sizes AS (SELECT doc_id, count(*) AS n FROM documents_shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM documents_shingles a JOIN documents_shingles b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, b.y FROM reached r JOIN both_ways b ON b.x = r.other
)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(other) AS component_id, min(other) = r.doc_id AS kept
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op10_quality_rules": """WITH
m AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS body,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents
),
windows AS (
  SELECT doc_id, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i+2], ' '))) AS s,
         unnest(generate_series(1, len(w) - 2)) AS i
  FROM m WHERE len(w) >= 3
),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS c FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
v AS (
  SELECT doc_id, host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(body, '[^A-Z]+', '', 'g')) AS capitals,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c, 0) AS n_repeat_words
  FROM m LEFT JOIN covered USING (doc_id)
),
f AS (
  SELECT *, concat_ws(',', CASE WHEN n_words < 50 THEN 'too_few_words' END, CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeated_words' END,
                      CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 'repeated_lines' END,
                      CASE WHEN n_symbols > 0.5 * n_words THEN 'symbols' END, CASE WHEN 100 * capitals > 60 * word_chars THEN 'capitals' END) AS failed_rules
  FROM v
),
hosts AS (
  SELECT host, count(*)::DOUBLE AS n, count(*) FILTER (failed_rules <> '')::DOUBLE AS bad FROM f WHERE host IS NOT NULL GROUP BY host
),
g AS (SELECT sum(n) AS total, sum(bad) AS failed, sum(n * n) AS squares, sum(bad * bad / n) AS weighted, count(*) AS k FROM hosts),
prior AS (
  SELECT failed / total AS mean, failed / total * (1 - failed / total) AS noise,
         (weighted - failed * failed / total - (k - 1) * noise) / (noise * (total - squares / total - (k - 1))) AS share,
         CASE WHEN share > 0 THEN least(1000, greatest(1, (1 - share) / share)) ELSE 1000 END AS weight
  FROM g
),
rated AS (SELECT host, (bad + mean * weight) / (n + weight) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       failed_rules = '' AND coalesce(host_rate <= 0.6, true) AS kept, failed_rules,
       round(host_rate, 9) AS host_rate, coalesce(host_rate > 0.6, false) AS host_rejected
FROM f LEFT JOIN rated USING (host)""",
    "op12_fill_in_middle": """WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(sha256('1:' || doc_id), i, 8))::BIGINT) AS h
  FROM documents
), cut AS (
  SELECT doc_id, t, len(u) AS n, u, h, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS lo, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts""",
}
