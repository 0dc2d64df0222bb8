"""DuckDB SQL for the queries of this subpackage that SQL can express."""

import re

from zonecast.llm.chat_format import CONTROLS, END, ESC, START

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op7_tree_merge_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""

MIX = r"""
sizes AS MATERIALIZED (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn
  FROM {documents}),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source),
weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         3 * source_size AS lim
  FROM per),
left_over AS (
  SELECT *,
    CAST(sum(source_size) OVER () - coalesce(sum(lim) OVER prev, 0) AS BIGINT) AS left_words,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER prev, 0) AS BIGINT) AS left_weight
  FROM weighed
  WINDOW prev AS (ORDER BY CAST(lim AS DOUBLE) / weight, rank
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stops AS (
  SELECT *, max(CASE WHEN lim * left_weight <= left_words * weight THEN 0 ELSE 1 END)
              OVER (ORDER BY CAST(lim AS DOUBLE) / weight, rank) AS is_open
  FROM left_over),
rest AS (
  SELECT left_words, left_weight FROM stops WHERE is_open = 1
  ORDER BY CAST(lim AS DOUBLE) / weight, rank LIMIT 1),
targets AS (
  SELECT s.source, s.source_size, s.rank,
         CASE WHEN s.is_open = 0 THEN CAST(s.lim AS DOUBLE)
              ELSE CAST((SELECT left_words FROM rest) AS DOUBLE) * s.weight
                   / (SELECT left_weight FROM rest) END AS target
  FROM stops s),
queue AS (
  SELECT z.*, t.source_size, t.rank, t.target,
         sum(z.size) OVER (PARTITION BY t.rank ORDER BY z.turn, z.doc_id, z.size
                           ROWS UNBOUNDED PRECEDING) AS upto,
         row_number() OVER (ORDER BY t.rank, z.turn, z.doc_id, z.size) AS row_no
  FROM sizes z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT row_no, size, rank,
         (CAST(e.i * source_size + upto AS DOUBLE)) / target AS finish
  FROM queue, (VALUES (0), (1), (2)) AS e(i)
  WHERE target > 0 AND size > 0),
served AS (
  SELECT row_no, count(*) AS copies
  FROM (SELECT row_no, sum(size) OVER (ORDER BY finish, rank, row_no
                                       ROWS UNBOUNDED PRECEDING) AS used FROM entries)
  WHERE used <= (SELECT sum(source_size) FROM targets)
  GROUP BY row_no),
mixed AS (
  SELECT q.doc_id, q.size, q.source_size, q.target,
         CAST(q.size * coalesce(s.copies, 0) AS BIGINT) AS taken,
         CAST(coalesce(s.copies, 0) AS INTEGER) AS copies
  FROM queue q LEFT JOIN served s USING (row_no))
"""

ORACLE_SQL["op10_weighted_fair_mix"] = (
    "WITH " + MIX.replace("{documents}", "documents") + "SELECT * FROM mixed")

ORACLE_SQL["op3_suffix_array_decontamination"] = r"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM items WHERE len(w) > 0),
starts AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM starts),
doc_starts AS (
  SELECT rid, w, s.n, unnest(range(1, len(w) - s.n + 2)) AS i
  FROM docs, (SELECT DISTINCT n FROM sized) s),
grams AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM doc_starts),
hits AS MATERIALIZED (SELECT rid, i, n, item_id FROM grams JOIN windows USING (n, gram)),
places AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (rid) LEFT JOIN named USING (rid)
"""

ORACLE_SQL["op6_bloom_cascade_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://')
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
hosts AS (
  SELECT row_number() OVER () AS rid, page_id, path,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM parts),
rules(verdict, h, p) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT rid, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM hosts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM hosts LEFT JOIN fits USING (rid)
"""

# The control strings of the chat template, as a pattern; each gets ESC 1
# after its first character.
_CONTROL = "|".join(re.escape(c[1:]) for c in CONTROLS)
ORACLE_SQL["op1_schema_fingerprint_chat"] = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, regexp_replace(replace(text, '{ESC}', '{ESC}0'), '([<\[])({_CONTROL})', '\1{ESC}1\2', 'g')
              AS body
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                         FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({len(START)} + length(role) + 1 + length(body) + {len(END)} + 1) AS BIGINT)
         AS formatted_chars
FROM escaped GROUP BY conv_id
"""

ORACLE_SQL["op2_merkle_fixity"] = """
WITH records AS (
  SELECT page_id, printf('crawl-%08d.warc', page_id // 500) AS file,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
         || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS content,
         CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 4) AS INTEGER) % 100 AS mark
  FROM pages),
placed AS (
  SELECT file, mark, content, CAST(coalesce(sum(strlen(content)) OVER (
           PARTITION BY file ORDER BY page_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM records),
copies AS (
  SELECT *, CASE mark WHEN 1 THEN content[1:4] || '#' || content[6:]
                      WHEN 2 THEN content[1:40] END AS damaged
  FROM placed WHERE mark IN (1, 2, 3))
SELECT file, "offset", CASE mark WHEN 3 THEN 'missing' ELSE 'corrupt' END AS status,
       sha256("offset" || ',' || sha256('1' || content)) AS left_hash,
       CASE WHEN mark < 3 THEN sha256("offset" || ',' || sha256('1' || damaged)) END AS right_hash
FROM copies
"""


def _license_sql() -> str:
    """Windows of three words of texts and notices joined by their words;
    diagonals at most three apart are one span (gaps and islands)."""
    from zonecast.llm.license_scan import TEMPLATES

    quoted = ", ".join(f"({i}, '{t.label}', '{t.text}', {str(t.base).lower()}, '{t.text if t.base else t.required}')"
                       for i, t in enumerate(TEMPLATES))
    return r"""
WITH notice(t, label, said, is_base, needed) AS (VALUES """ + quoted + r"""),
tw AS (SELECT t, label, is_base, string_split(said, ' ') AS w, string_split(needed, ' ') AS need FROM notice),
tg AS (
  SELECT t, len(w) - 2 AS windows, q, array_to_string(w[q + 1:q + 3], ' ') AS gram
  FROM (SELECT t, w, unnest(range(0, len(w) - 2)) AS q FROM tw)),
needed AS (
  SELECT t, CAST(bit_or(CAST(1 AS BIGINT) << q) AS BIGINT) AS bits
  FROM (
    SELECT t, array_to_string(w, ' ') AS said, array_to_string(need, ' ') AS need,
           unnest(range(0, len(w) - 2)) AS q, len(need) AS m,
           len(string_split(split_part(' ' || array_to_string(w, ' ') || ' ',
                                       ' ' || array_to_string(need, ' ') || ' ', 1), ' ')) - 1 AS fro
    FROM tw)
  WHERE q >= fro AND q <= fro + m - 3 GROUP BY t),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
grams AS (
  SELECT rid, p, array_to_string(w[p + 1:p + 3], ' ') AS gram
  FROM (SELECT rid, w, unnest(range(0, len(w) - 2)) AS p FROM docs)),
votes AS (
  SELECT rid, t, p - q AS diagonal, CAST(bit_or(CAST(1 AS BIGINT) << q) AS BIGINT) AS bits, max(windows) AS windows
  FROM grams JOIN tg USING (gram) GROUP BY rid, t, p - q),
parted AS (
  SELECT *, sum(apart) OVER (PARTITION BY rid, t ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, t ORDER BY diagonal) <= 3
                       THEN 0 ELSE 1 END AS apart FROM votes)),
whole AS (SELECT p.*, p.bits & n.bits = n.bits AS is_whole FROM parted p JOIN needed n USING (t)),
spans AS (
  SELECT rid, t, bool_or(is_whole) AS is_whole, count(*) FILTER (WHERE is_whole) AS n,
         min(diagonal) FILTER (WHERE is_whole) AS lo, max(diagonal) FILTER (WHERE is_whole) AS hi,
         CAST(bit_count(CAST(bit_or(bits) AS BIGINT)) AS DOUBLE) / max(windows) AS covered
  FROM whole GROUP BY rid, t, span),
found AS (SELECT s.*, tw.label, tw.is_base FROM spans s JOIN tw USING (t)),
per AS (
  SELECT rid, sum(n) FILTER (WHERE is_base) AS n_base, min(lo) FILTER (WHERE is_base) AS lo,
         max(hi) FILTER (WHERE is_base) AS hi, max(covered) AS score,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base AND n > 0) AS base,
         string_agg(DISTINCT label, ',' ORDER BY label)
           FILTER (WHERE is_base AND n > 0 OR is_whole AND covered >= CAST(0.8 AS DOUBLE)) AS labels
  FROM found GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word, coalesce(base, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM docs LEFT JOIN per USING (rid)
"""


ORACLE_SQL["op13_diagonal_license_scan"] = _license_sql()
