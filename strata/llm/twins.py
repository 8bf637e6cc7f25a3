"""DuckDB twins of the Merkle manifest and conversation repair queries."""

#: CRC-32 (reflected polynomial 0xEDB88320) of every byte value, as a list.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t"""


def crc(text: str) -> str:
    """CRC-32 of ASCII text, with the list ``t`` of CRC_TABLE in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295, {codes}), "
            "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)")


MERKLE = f"""WITH RECURSIVE crc_table AS (
  {CRC_TABLE}),
field AS (
  SELECT row_number() OVER () AS r, *,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-')
    || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text,
    {crc('doc_id::VARCHAR')} AS crc
  FROM documents, crc_table),
hashed AS (
  SELECT r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(CASE WHEN crc % 3 = 0 THEN strlen(lower_text) || ':' || lower_text
      ELSE strlen(text) || ':' || text END, '-')) AS met FROM field),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM hashed),
nodes AS (
  SELECT lang, 0 AS lvl, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes
  WHERE n > 1 GROUP BY lang, lvl, n, idx // 8),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, idx, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM tops
  WHERE n > 1 GROUP BY lvl, n, idx // 8),
steps AS (
  SELECT a.lang, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lhs,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rhs
  FROM nodes a JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND a.idx // 8 = b.idx // 8
  WHERE a.n > 1 GROUP BY a.lang, a.lvl, a.idx),
top_steps AS (
  SELECT a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS lhs,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS rhs
  FROM tops a JOIN tops b ON a.lvl = b.lvl AND a.idx // 8 = b.idx // 8 WHERE a.n > 1 GROUP BY a.lvl, a.idx),
paths AS (
  SELECT l.r, s.lvl, s.lhs, s.rhs FROM leaves l JOIN steps s
    ON l.lang IS NOT DISTINCT FROM s.lang AND s.idx = l.idx >> (3 * s.lvl)
  UNION ALL
  SELECT l.r, 100 + s.lvl, s.lhs, s.rhs FROM leaves l JOIN subroots u ON l.lang IS NOT DISTINCT FROM u.lang
    JOIN top_steps s ON s.idx = u.idx >> (3 * s.lvl)),
listed AS (
  SELECT r, list(struct_pack(lhs := lhs, rhs := rhs) ORDER BY lvl) AS path,
    sha256(string_agg(lhs || rhs, '' ORDER BY lvl)) AS proof FROM paths GROUP BY r),
fold AS (
  SELECT l.r, 1 AS k, l.met AS h, p.path FROM leaves l LEFT JOIN listed p USING (r)
  UNION ALL
  SELECT r, k + 1, sha256(path[k].lhs || h || path[k].rhs), path FROM fold WHERE k <= len(path)),
root AS (SELECT h AS root FROM tops WHERE n = 1)
SELECT l.doc_id, l.leaf, u.h AS subroot, root.root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f.h AS folded_root, f.h = root.root AS verified
FROM leaves l JOIN subroots u ON l.lang IS NOT DISTINCT FROM u.lang CROSS JOIN root
LEFT JOIN listed p USING (r) JOIN fold f ON f.r = l.r AND f.k = coalesce(len(f.path), 0) + 1"""

# Edits of one row after another from four states (0 nothing yet, 1 after s, 2 after u, 3 after a), with the least
# (cost, audit) kept for each state. Two insertions in a row are never cheapest, so one before each row is enough.
CONVERSATIONS = rf"""WITH RECURSIVE crc_table AS (
  {CRC_TABLE}),
spaced AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
kinds AS (SELECT c, conv_id, turn, role, text, {crc('key')} % 20 AS kind FROM spaced, crc_table),
damaged AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS p,
    left(role, 1) AS i FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY p) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(i) OVER (PARTITION BY c ORDER BY p) || i AS pair FROM placed),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY c),
path AS (
  SELECT DISTINCT c, 0 AS p, 0 AS st, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM spaced
  UNION ALL
  SELECT c, p, st, min(cost), arg_min(audit, {{'cost': cost, 'audit': audit}}),
    arg_min(lines, {{'cost': cost, 'audit': audit}}) FROM (
    SELECT b.c, r.p, e.st, b.cost + e.cost AS cost, b.audit || e.edit AS audit,
      CASE WHEN e.line IS NULL THEN b.lines ELSE list_append(b.lines, e.line) END AS lines
    FROM (SELECT c, p, st, cost, audit, lines FROM path UNION ALL
          SELECT c, p, CASE WHEN st = 2 THEN 3 ELSE 2 END, cost + 5, audit || 'I',
            list_append(lines, CASE WHEN st = 2 THEN 'assistant:' ELSE 'user:' END) FROM path) b
    JOIN faulty r ON r.c = b.c AND r.p = b.p + 1,
    LATERAL (SELECT unnest([
      {{'edit': 'D', 'st': b.st, 'cost': 2, 'line': NULL, 'ok': true}},
      {{'edit': 'K', 'st': 1, 'cost': 0 + CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END,
        'line': r.role || ':' || r.text, 'ok': r.fault NOT IN ('blank', 'duplicate') AND b.st = 0 AND r.i = 's'}},
      {{'edit': CASE WHEN r.i = CASE WHEN b.st = 2 THEN 'a' ELSE 'u' END THEN 'K' ELSE 'R' END,
        'st': CASE WHEN b.st = 2 THEN 3 ELSE 2 END,
        'cost': CASE WHEN r.i = CASE WHEN b.st = 2 THEN 'a' ELSE 'u' END THEN 0 ELSE 1 END
          + CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END,
        'line': CASE WHEN r.i = CASE WHEN b.st = 2 THEN 'a' ELSE 'u' END THEN r.role
          WHEN b.st = 2 THEN 'assistant' ELSE 'user' END || ':' || r.text,
        'ok': r.fault NOT IN ('blank', 'duplicate')}}], recursive := true)) AS e
    WHERE e.ok) GROUP BY c, p, st),
ends AS (
  SELECT c, cost, audit, lines FROM (
    SELECT c, p, st, cost, audit, lines FROM path UNION ALL
    SELECT c, p, 3, cost + 5, audit || 'I', list_append(lines, 'assistant:') FROM path WHERE st = 2) z
  WHERE st IN (0, 3) AND p = (SELECT count(*) FROM faulty f WHERE f.c = z.c)),
best AS (
  SELECT c, min(cost) AS cost, arg_min(audit, {{'cost': cost, 'audit': audit}}) AS audit,
    arg_min(lines, {{'cost': cost, 'audit': audit}}) AS lines FROM ends GROUP BY c)
SELECT s.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
  coalesce(n.truncated, 0) AS truncated, coalesce(n.illegal, 0) AS illegal, b.cost::BIGINT AS cost, b.audit,
  sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM spaced) s JOIN best b USING (c) LEFT JOIN counted n USING (c)"""
