"""The queries in DuckDB SQL, where it can express them."""

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_TEXT_WORDS = WORDS.format("text")

OP3 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
pairs AS (
  SELECT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM docs WHERE len(w) > 0)),
shingles AS (SELECT DISTINCT doc_id, s FROM pairs),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT reach.x, b.y FROM reach JOIN both_ways b ON reach.y = b.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) AS kept
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON x = d.doc_id
"""

OP4 = """
WITH told AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
said AS (
  SELECT *, coalesce(length(role) || ':' || role, '-') || '|' || coalesce(length(text) || ':' || text, '-') AS s,
         '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS shown
  FROM told),
prefixes AS (
  SELECT conv_id, string_agg(s, '') OVER o AS prefix, string_agg(shown, '') OVER o AS rendered, row_number() OVER o AS n,
         count(*) OVER (PARTITION BY conv_id) AS total
  FROM said WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING)),
whole AS (SELECT * FROM prefixes WHERE n = total),
longest AS (SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM prefixes WHERE n < total))
SELECT conv_id, total AS n_turns, rendered FROM longest
QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY conv_id NULLS FIRST) = 1
"""

OP5 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_TEXT_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS shuffle FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS source_no FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (source_no - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size::DOUBLE AS cap FROM sources),
levelled AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source_no)),
reached AS (SELECT level FROM levelled WHERE level * weight < cap ORDER BY cap / weight, source_no LIMIT 1),
targets AS (
  SELECT source, source_no, source_size, least(cap, coalesce((SELECT level FROM reached), 'inf'::DOUBLE) * weight) AS target FROM levelled),
placed AS (
  SELECT s.*, source_no, source_size, target, floor(target)::BIGINT AS words,
         sum(size) OVER (PARTITION BY s.source ORDER BY shuffle, doc_id ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranges AS (
  SELECT source_no, ceil(floor(target) / 256)::BIGINT AS blocks, (sum(target) OVER o - target) / sum(target) OVER () AS low,
         sum(target) OVER o / sum(target) OVER () + (source_no = max(source_no) OVER ())::INTEGER AS high
  FROM targets WHERE target >= 1 WINDOW o AS (ORDER BY source_no)),
slots AS (
  SELECT slot, (slot + 1) * 0.6180339887498949::DOUBLE AS turn FROM (SELECT unnest(range((SELECT sum(blocks) FROM ranges)::BIGINT)) AS slot)),
hits AS (
  SELECT slot, source_no, blocks, row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS block_no
  FROM slots JOIN ranges ON turn - floor(turn) >= low AND turn - floor(turn) < high),
have AS (SELECT source_no, count(*) AS n FROM hits GROUP BY source_no),
tail AS (SELECT source_no, unnest(range(coalesce(n, 0)::BIGINT, blocks)) AS block_no FROM ranges LEFT JOIN have USING (source_no)),
schedule AS (
  SELECT source_no, block_no, slot FROM hits WHERE block_no < blocks
  UNION ALL SELECT source_no, block_no, (SELECT sum(blocks) + 0 FROM ranges) + block_no * (SELECT max(source_no) FROM ranges) + source_no FROM tail),
rounds AS (
  SELECT doc_id, source_no, r * source_size + start AS a, least(r * source_size + start + size, words) AS b
  FROM placed, (SELECT unnest([0, 1]) AS r) WHERE size > 0),
drawn AS (SELECT doc_id, source_no, unnest(range((a // 256)::BIGINT, ((b - 1) // 256 + 1)::BIGINT)) AS block_no FROM rounds WHERE a < b),
met AS (SELECT doc_id, min(slot)::BIGINT AS first_slot, max(slot)::BIGINT AS last_slot FROM drawn JOIN schedule USING (source_no, block_no) GROUP BY doc_id)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(start + size, words) - start)
        + greatest(0, least(source_size + start + size, words) - source_size - start))::BIGINT AS taken, first_slot, last_slot
FROM placed LEFT JOIN met USING (doc_id)
"""

OP7 = r"""
WITH numbered AS (
  SELECT doc_id, unnest(range(len(lines))) AS line_no, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)),
solid AS (
  SELECT *, translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ') AS spaced FROM numbered
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
texts AS (
  SELECT line, min({'d': doc_id, 'n': line_no}) AS first, string_split(any_value(spaced), ' ') AS w FROM solid GROUP BY line),
long AS (SELECT first, w, unnest(range(1, len(w) + 1)) AS i FROM texts WHERE len(w) >= 5),
cuts AS (
  SELECT first, len(w) AS n, i, array_to_string(w[1:i - 1], ' ') AS a, array_to_string(w[i + 1:], ' ') AS b FROM long),
changed AS (SELECT first, md5(n || ':' || i || ':' || a || chr(1) || b) AS k FROM cuts),
less AS (
  SELECT DISTINCT first, md5(n - 1 || ':' || CASE WHEN i = 1 THEN b WHEN i = n THEN a ELSE a || ' ' || b END) AS k FROM cuts),
own AS (SELECT first, md5(len(w) || ':' || array_to_string(w, ' ')) AS k FROM texts WHERE len(w) >= 4),
near AS (
  SELECT c.first FROM changed c JOIN (SELECT k, min(first) AS m FROM changed GROUP BY k) g ON c.k = g.k AND g.m < c.first
  UNION SELECT o.first FROM own o JOIN (SELECT k, min(first) AS m FROM less GROUP BY k) g ON o.k = g.k AND g.m < o.first
  UNION SELECT l.first FROM less l JOIN (SELECT k, min(first) AS m FROM own GROUP BY k) g ON l.k = g.k AND g.m < l.first),
gone AS (
  SELECT doc_id, line_no FROM solid s JOIN texts t USING (line)
  WHERE {'d': doc_id, 'n': line_no} <> t.first OR t.first IN (SELECT first FROM near)),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(g.line_no) AS n_removed,
         coalesce(string_agg(CASE WHEN g.line_no IS NULL THEN line END, chr(10) ORDER BY line_no), '') AS text
  FROM numbered LEFT JOIN gone g USING (doc_id, line_no) GROUP BY doc_id)
SELECT d.doc_id, k.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP8 = rf"""
WITH docs AS (SELECT doc_id, {_TEXT_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE len(w) >= 13)),
repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT s, min(doc_id) AS m FROM windows GROUP BY s) USING (s) WHERE m < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM repeated),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
kept AS (
  SELECT doc_id, count(c.i) AS n, string_agg(CASE WHEN c.i IS NULL THEN word END, ' ' ORDER BY i) AS t
  FROM words LEFT JOIN covered c USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""

OP11 = """
WITH rows AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
met AS (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n USING (anchor_id)
  WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 5
"""

ORACLE_SQL = {
    "op3_near_dedup": OP3,
    "op4_chat_formatting": OP4,
    "op5_mixing": OP5,
    "op7_line_dedup": OP7,
    "op8_substring_dedup": OP8,
    "op9_top_k": OP9,
    "op11_hard_negatives": OP11,
}
