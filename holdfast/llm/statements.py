"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_url_verdicts"] = r"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 2, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's'), '') AS path
  FROM pages
),
rules(name, site, start, action) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
    ('example.org/en/1', 'example.org', '/en/1', 'allow'), ('com/fr/', 'com', '/fr/', 'allow'),
    ('com/de/', 'com', '/de/', 'block')
),
best AS (
  SELECT host, path, arg_max(name, length(name)) AS rule, arg_max(action, length(name)) AS action
  FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE (host = site OR ends_with(host, '.' || site)) AND starts_with(path, start)
  GROUP BY host, path
)
SELECT page_id, p.host, p.path, rule,
  coalesce(action, CASE WHEN regexp_matches(p.host || p.path,
    '(^|[^0-9A-Za-z])(casino-win|free-bets|cheap-pills|spam-farm)([^0-9A-Za-z]|$)') THEN 'block' ELSE 'allow' END)
    AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path
"""

# Words split at the same six characters; windows of eight words are compared as joined text.
ORACLES["op6_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
windows AS (
  SELECT row, i, array_to_string(words[i : i + 7], ' ') AS own
  FROM docs, unnest(range(1, len(words) - 6)) AS t(i)
),
twice AS (
  SELECT row, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY row, own) > 1
),
covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM twice, range(0, 8) AS s(k) GROUP BY row
),
lines AS (
  SELECT row, line, count(*) - 1 AS more
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY row, line
),
dup AS (SELECT row, sum(more) AS n FROM lines GROUP BY row),
counts AS (
  SELECT d.row, doc_id, text, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
    len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN dup ON d.row = dup.row LEFT JOIN covered ON d.row = covered.row
),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    len(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_letters,
    len(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
    len(regexp_replace(text, '[^!]', '', 'g')) AS marks,
    len(string_split(text, chr(10))) AS n_lines
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR 10 * n_symbols > 3 * n_words OR 2 * upper_letters > letters
    OR 3 * n_dup_lines > n_lines OR 10 * marks > 3 * n_words) AS kept
FROM judged
"""

# The same edits as a table of steps between the states of (s?(ua)+)?: 0 nothing yet, 1 after s,
# 2 after u, 3 after a. Row by row the cheapest way into each state is kept, of equally cheap
# ones the one with the smallest letters; a row's letters end with its own, so prefixes compare
# as the whole strings do.
ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS place
  FROM conversations
),
-- crc32 of the places, bit by bit.
places AS (SELECT DISTINCT place FROM source),
crc(place, i, c) AS (
  SELECT place, 0, 4294967295::BIGINT FROM places
  UNION ALL
  SELECT place, i + 1, list_reduce(
    list_prepend(xor(c, ascii(substr(place, (i + 1)::BIGINT, 1))::BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
  FROM crc WHERE i < length(place)
),
faults AS (SELECT place, xor(c, 4294967295::BIGINT) % 20 AS fault FROM crc WHERE i = length(place)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM source JOIN faults USING (place), range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged
),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'right' END AS kind,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1)
      NOT IN ('su', 'ua', 'au'), false) AS wrong_pair
  FROM numbered
),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
    count(*) FILTER (kind = 'truncated') AS truncated, count(*) FILTER (wrong_pair) AS illegal
  FROM judged GROUP BY conv_id
),
-- Up to two insertions from a state: cost, letters, state, lines.
inserts(q, cost, letters, r, lines) AS (
  VALUES (0, 0, '', 0, ''), (1, 0, '', 1, ''), (2, 0, '', 2, ''), (3, 0, '', 3, ''),
    (0, 2, 'I', 2, E'user:\n'), (1, 2, 'I', 2, E'user:\n'), (3, 2, 'I', 2, E'user:\n'), (2, 2, 'I', 3, E'assistant:\n'),
    (0, 4, 'II', 3, E'user:\nassistant:\n'), (1, 4, 'II', 3, E'user:\nassistant:\n'),
    (3, 4, 'II', 3, E'user:\nassistant:\n'), (2, 4, 'II', 2, E'assistant:\nuser:\n')
),
accepts(r, initial, role, q) AS (
  VALUES (0, 's', NULL, 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)
),
edges AS (
  SELECT conv_id, i, q AS start, r AS q, cost + 3 AS cost, letters || 'D' AS letters, lines
  FROM judged, inserts
  UNION ALL
  SELECT conv_id, i, n.q, a.q, cost + (kind = 'truncated')::INT + (left(j.role, 1) <> initial)::INT * 2,
    letters || CASE WHEN left(j.role, 1) = initial THEN 'K' ELSE 'R' END,
    lines || CASE WHEN left(j.role, 1) = initial THEN j.role ELSE a.role END || ':' || text || chr(10)
  FROM judged j, inserts n JOIN accepts a ON n.r = a.r
  WHERE kind IN ('right', 'truncated') AND (left(j.role, 1) = initial OR a.role IS NOT NULL)
),
paths(conv_id, i, q, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0, 'audit': '', 'lines': ''} FROM counts
  UNION ALL
  SELECT p.conv_id, p.i + 1, e.q, min({'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.letters,
    'lines': p.best.lines || e.lines})
  FROM paths p JOIN edges e ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = p.i + 1 AND e.start = p.q
  GROUP BY p.conv_id, p.i, e.q
),
endings AS (
  SELECT p.conv_id, min({'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.letters,
    'lines': p.best.lines || e.lines}) AS best
  FROM paths p JOIN counts c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n
  JOIN inserts e ON e.q = p.q AND e.r IN (0, 3)
  GROUP BY p.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
  sha256(regexp_replace(coalesce(best.lines, ''), '\n\z', '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN endings e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""
