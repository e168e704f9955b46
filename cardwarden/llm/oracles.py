"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from cardwarden.llm import host_rules as rules

_WHITE = r"[\x20\x09-\x0D]"

HOST_RULES = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_WHITE}+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) AS u(i)),
dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM dup, unnest(range(i, i + 8)) AS v(j) GROUP BY 1),
measured AS (
  SELECT w.doc_id, source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::BIGINT
           - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
judged AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured),
hosts AS (
  SELECT source, count(*) AS host_docs, count(*) FILTER (base_failed) AS host_failed FROM judged WHERE source IS NOT NULL GROUP BY 1),
s AS (
  SELECT count(*)::DOUBLE AS h, sum(host_docs)::DOUBLE AS n, sum(host_failed)::DOUBLE AS f,
         sum(host_docs::DOUBLE * host_docs) AS n2, sum(host_failed::DOUBLE * host_failed / host_docs) AS f2 FROM hosts),
m AS (SELECT *, f / n AS mean, n - n2 / n - (h - 1) AS spread FROM s),
r AS (
  SELECT *, CASE WHEN h < 2 OR mean IN (0, 1) OR spread <= 0 THEN NULL
                 ELSE ((f2 - f * mean) / (mean * (1 - mean)) - (h - 1)) / spread END AS rho FROM m),
prior AS (
  SELECT mean, CASE WHEN rho IS NULL THEN {rules.DEFAULT_STRENGTH}::DOUBLE WHEN rho <= 0 THEN {rules.STRENGTHS[1]}::DOUBLE
                    ELSE least(greatest((1 - rho) / rho, {rules.STRENGTHS[0]}::DOUBLE), {rules.STRENGTHS[1]}::DOUBLE) END AS strength FROM r),
post AS (
  SELECT source, host_docs, host_failed, host_failed + mean * strength AS a,
         host_docs - host_failed + (1 - mean) * strength AS b FROM hosts, prior),
verdict AS (
  SELECT source, host_docs, host_failed,
         a / (a + b) - {rules.HOST_DEVIATIONS}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {rules.HOST_RATE}::DOUBLE AS rejected FROM post)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept, host_docs, host_failed, coalesce(rejected, false) AS host_rejected
FROM judged LEFT JOIN verdict ON verdict.source = judged.source"""

CHATS = """
WITH c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns FROM conversations GROUP BY 1),
same AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_snapshots FROM c GROUP BY 1),
kept AS (
  SELECT * FROM same a WHERE NOT EXISTS (
    SELECT 1 FROM same b WHERE b.turns[1] = a.turns[1] AND len(b.turns) > len(a.turns) AND b.turns[1:len(a.turns)] = a.turns))
SELECT conv_id, 0::BIGINT AS part, len(turns)::BIGINT AS n_turns, n_snapshots,
       list_aggregate(list_transform(turns, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), 'string_agg', '') AS chat
FROM kept"""
