"""SQL forms of the queries that SQL can state, for the same tables."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

EXACT = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm,
         row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS place,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

LINES = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), one AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, {_WHITE}), '{_UPPER}', '{_UPPER.lower()}') AS key FROM one
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), ''))
         AS kept_sha256
FROM keyed LEFT JOIN common ON keyed.key = common.key
GROUP BY doc_id
"""

CHATS = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS text_chars,
         length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '<|br|>')) AS role_chars
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       sum(12 + role_chars + 1 + text_chars + 11)::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(role, '>' ORDER BY turn, role, text),
                         '(system>)?(user>assistant>)*user>assistant') AS valid
FROM e GROUP BY conv_id
"""

COLLOCATIONS = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece
), gram AS (
  SELECT lang, 1 AS size, unnest(w) AS w1, '' AS w2, '' AS w3 FROM w
  UNION ALL
  SELECT lang, 2, w[i], w[i + 1], '' FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w)
  UNION ALL
  SELECT lang, 3, w[i], w[i + 1], w[i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), f AS (
  SELECT lang, size, w1, w2, w3, count(*) AS a FROM gram GROUP BY ALL
), total AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang
), candidate AS (
  SELECT * FROM f WHERE size > 1 AND a >= 10
), part AS (
  SELECT *, concat_ws(' ', w1, nullif(w2, ''), nullif(w3, '')) AS words FROM f WHERE size < 3 AND a >= 10
), split AS (
  SELECT *, 1 AS k, w1 AS head, concat_ws(' ', w2, nullif(w3, '')) AS tail FROM candidate
  UNION ALL
  SELECT *, 2, w1 || ' ' || w2, w3 FROM candidate WHERE size = 3
), cut AS (
  SELECT s.*, l.a AS l, r.a AS r, ((1000000::HUGEINT * s.a * s.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM split s JOIN part l ON l.lang = s.lang AND l.words = s.head
  JOIN part r ON r.lang = s.lang AND r.words = s.tail
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, size, w1, w2, w3 ORDER BY score, k) = 1
), longer AS (
  SELECT lang, w1, w2, max(a) AS most FROM (
    SELECT lang, w1, w2, a FROM candidate WHERE size = 3
    UNION ALL SELECT lang, w2, w3, a FROM candidate WHERE size = 3) GROUP BY ALL
), kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, w1, w2)
  WHERE size = 3 OR most IS NULL OR 100 * most < 50 * a
), phrased AS (
  SELECT *, concat_ws(' ', w1, w2, nullif(w3, '')) AS phrase FROM kept
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM phrased JOIN total USING (lang)
QUALIFY rank <= 2000
"""

ORACLE = {
    "op5_content_sort": EXACT,
    "op6_line_dedup": LINES,
    "op8_chat_format": CHATS,
    "op12_collocations": COLLOCATIONS,
}
