"""DuckDB SQL for the training-data queries that SQL can express.

The others (added secret spans, learned scores, fingerprints, token ids, seeds)
are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op3_warc": """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
digested AS (
  SELECT page_id, payload_bytes,
         list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(hex, CAST(10 * (i // 8) + 1 AS INT), 10) AS BIGINT)
                  >> CAST(35 - 5 * (i % 8) AS INT)) & 31) + 1 AS INT), 1) FOR i IN range(32)], 'string_agg', '') AS payload_digest
  FROM hashed),
led AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS lead_id FROM digested)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = lead_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead_id THEN lead_id END AS refers_to
FROM led""",
    "op4_content_sort_dedup": r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
grouped AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id FROM plain)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM grouped""",
    "op10_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.first_doc AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op11_ngram_join": r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s FROM worded),
sized AS (SELECT doc_id, len(s) AS n, s FROM shingled),
grams AS (SELECT doc_id, n, unnest(s) AS g FROM sized),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 90 * (na + nb - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, d.n AS n_shingles, min(r.b) AS component_id FROM sized d JOIN reach r ON d.doc_id = r.a
GROUP BY d.doc_id, d.n""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, [ascii(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')] AS b FROM documents),
crc AS (
  SELECT doc_id, CAST(4294967295 AS BIGINT) AS c, 1 AS k, b FROM bytes
  UNION ALL
  SELECT doc_id, list_reduce([xor(c, CAST(b[k] AS BIGINT)), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)), k + 1, b
  FROM crc WHERE k <= len(b)),
marked AS (SELECT doc_id, xor(c, 4294967295) % 7 = 0 AS tampered FROM crc WHERE k = len(b) + 1),
fields AS (
  SELECT d.doc_id, lang, tampered,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') AS f1, coalesce(strlen(source) || ':' || source, '-') AS f2,
    coalesce(strlen(lang) || ':' || lang, '-') AS f3, n_chars,
    coalesce(strlen(text) || ':' || text, '-') AS f5 FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id),
leaves AS (
  SELECT doc_id, lang, sha256(f1 || f2 || f3 || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || f5) AS leaf,
    sha256(f1 || f2 || f3 || coalesce(strlen(CAST(t AS VARCHAR)) || ':' || t, '-') || f5) AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM (SELECT *, CASE WHEN tampered THEN n_chars + 1 ELSE n_chars END AS t FROM fields)),
tree AS (
  SELECT 0 AS h, coalesce('=' || lang, '') AS g, pos, leaf AS node, count(*) OVER (PARTITION BY lang) AS total FROM leaves
  UNION ALL
  SELECT h + 1, g, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), any_value((total + 1) // 2) FROM tree
  WHERE total > 1 GROUP BY h, g, pos // 2),
subroots AS (
  SELECT g, node, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS total FROM tree WHERE total = 1),
top AS (
  SELECT 0 AS h, pos, node, total FROM subroots
  UNION ALL
  SELECT h + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), any_value((total + 1) // 2) FROM top
  WHERE total > 1 GROUP BY h, pos // 2),
root AS (SELECT node AS root FROM top WHERE total = 1),
fold AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, 'l' AS part, 0 AS h, pos, changed AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, g, part, h, pos, node, proof FROM (
    SELECT f.doc_id, f.g, f.part, f.h + 1 AS h, f.pos // 2 AS pos,
      sha256(CASE WHEN s.pos < f.pos THEN s.node ELSE '' END || f.node || CASE WHEN s.pos > f.pos THEN s.node ELSE '' END) AS node,
      f.proof || coalesce(s.node, '') AS proof
    FROM fold f JOIN tree me ON f.part = 'l' AND me.g = f.g AND me.h = f.h AND me.pos = f.pos AND me.total > 1
    LEFT JOIN tree s ON s.g = f.g AND s.h = f.h AND s.pos = xor(f.pos, 1)
    UNION ALL
    SELECT f.doc_id, f.g, 't', 0, r.pos, f.node, f.proof
    FROM fold f JOIN tree me ON f.part = 'l' AND me.g = f.g AND me.h = f.h AND me.pos = f.pos AND me.total = 1
    JOIN subroots r ON r.g = f.g
    UNION ALL
    SELECT f.doc_id, f.g, 't', f.h + 1, f.pos // 2,
      sha256(CASE WHEN s.pos < f.pos THEN s.node ELSE '' END || f.node || CASE WHEN s.pos > f.pos THEN s.node ELSE '' END),
      f.proof || coalesce(s.node, '')
    FROM fold f JOIN top me ON f.part = 't' AND me.h = f.h AND me.pos = f.pos AND me.total > 1
    LEFT JOIN top s ON s.h = f.h AND s.pos = xor(f.pos, 1))),
done AS (SELECT f.doc_id, f.node, f.proof FROM fold f JOIN top t ON f.part = 't' AND t.h = f.h AND t.pos = f.pos AND t.total = 1)
SELECT l.doc_id, l.leaf, s.node AS subroot, root.root, sha256(d.proof) AS proof_sha256, d.node AS folded_root,
       d.node = root.root AS verified
FROM leaves l JOIN subroots s ON s.g = coalesce('=' || l.lang, '') JOIN done d ON l.doc_id = d.doc_id CROSS JOIN root""",
    "op13_fill_middle": r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || doc_id) AS hex FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n, CAST('0x' || hex[1:8] AS BIGINT) % (len(u) + 1) AS a,
         CAST('0x' || hex[9:16] AS BIGINT) % (len(u) + 1) AS b, CAST('0x' || hex[17:24] AS BIGINT) % 100 AS h3,
         CAST('0x' || hex[25:32] AS BIGINT) % 100 AS h4 FROM units),
parted AS (
  SELECT doc_id, text, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                               OR h3 >= 50 THEN 'plain' WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(list_slice(u, 1, least(a, b)), '') AS prefix,
         array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') AS middle,
         array_to_string(list_slice(u, greatest(a, b) + 1, n), '') AS suffix FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parted""",
}
