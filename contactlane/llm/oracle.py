"""DuckDB SQL for the registered queries that SQL can express.

Not expressible: op7 (mined rules), op8 (spans added in context), op9 (merges of a vocabulary file), op10 (a
fitted model), op3 and op4 (a searched graph, a trained model); their tests
hold them against brute force, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Water-filling in closed form: sources in order of size/weight are capped until
# the shared unit lies below the next one's cap. Documents in md5 order.
ORACLE["op2_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, n, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
                      WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM docs GROUP BY source)),
ordered AS (
  SELECT *, 3 * n AS cap, row_number() OVER (ORDER BY n / w, source IS NULL, source) AS k FROM sources),
capped AS (
  SELECT k, n, w, cap,
         coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
  FROM ordered),
units AS (
  SELECT k, CAST((SELECT sum(n) FROM sources) - cap_before AS DOUBLE)
            / CAST((SELECT sum(w) FROM sources) - w_before AS DOUBLE) AS unit, w, cap FROM capped),
firsts AS (SELECT k, unit FROM units WHERE w * unit <= cap ORDER BY k LIMIT 1),
targets AS (
  SELECT o.source, o.n AS source_size,
         CASE WHEN o.k < f.k THEN CAST(o.cap AS DOUBLE) ELSE o.w * f.unit END AS target
  FROM ordered o, firsts f),
plan AS (
  SELECT source, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM targets),
lined AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.quota,
         CASE WHEN p.source_size > 0 THEN p.quota // p.source_size ELSE 0 END AS passes,
         coalesce(sum(d.size) OVER (PARTITION BY d.source
           ORDER BY md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * passes + greatest(0, least(size, quota - passes * source_size - before)) AS BIGINT) AS taken
FROM lined"""

ORACLE["op6_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations),
prefixes AS (
  SELECT conv_id, pos, max(pos) OVER (PARTITION BY conv_id) AS n,
         string_agg(md5(role || chr(31) || text), ',') OVER (PARTITION BY conv_id ORDER BY pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM turns),
whole AS (SELECT min(conv_id) AS conv_id, n, upto FROM prefixes WHERE pos = n GROUP BY n, upto),
kept AS (SELECT w.* FROM whole w ANTI JOIN (SELECT pos, upto FROM prefixes WHERE pos < n) p
         ON w.n = p.pos AND w.upto = p.upto)
SELECT t.conv_id, CAST(0 AS BIGINT) AS part, CAST(max(k.n) AS BIGINT) AS n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM turns t JOIN kept k USING (conv_id) GROUP BY t.conv_id"""

# Sets of distinct 4-word shingles, pairs that share any, and the smallest id
# reachable over links.
ORACLE["op1_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(2, len(w) - 2)),
                                              lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
grams AS (SELECT doc_id, md5(unnest(s)) AS g FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have
          FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS other FROM (SELECT DISTINCT a FROM edges)
          UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT w.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, coalesce(c.least, w.doc_id) AS component_id
FROM words w LEFT JOIN sizes z USING (doc_id)
LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY 1) c USING (doc_id)"""

ORACLE["op5_topk"] = r"""
WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM vecs q JOIN vecs c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 5"""

ORACLE["op12_hard_negatives"] = r"""
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM vecs a JOIN vecs c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""

# crc32 bit by bit: a list entry of 256 or more brings in the next byte.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
  regexp_extract_all(coalesce(CAST(doc_id AS VARCHAR), ''), '.'),
  lambda c: list_prepend(CAST(256 + ascii(c) AS BIGINT), [CAST(0 AS BIGINT) FOR i IN range(8)])))),
  lambda crc, e: CASE WHEN e >= 256 THEN xor(crc, e - 256)
                      ELSE xor(crc >> 1, CAST(3988292384 AS BIGINT) * (crc & 1)) END)"""


def _field(x: str) -> str:
    return f"coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# Nodes level by level, per source and over the subroots; a proof is each level's
# siblings, and the fold walks the levels with the tampered leaf.
ORACLE["op13_merkle"] = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN xor({_CRC}, CAST(4294967295 AS BIGINT)) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")}
              ELSE {_leaf('text')} END AS claimed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM docs),
trees AS (
  SELECT source, 0 AS level, rank AS idx, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 2) // 3
  FROM trees WHERE n > 1 GROUP BY source, level, idx // 3),
subroots AS (
  SELECT source, level AS height, digest AS subroot,
         row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS rank FROM trees WHERE n = 1),
tops AS (
  SELECT 0 AS level, rank AS idx, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 2) // 3
  FROM tops WHERE n > 1 GROUP BY level, idx // 3),
ids AS (
  SELECT l.*, s.height, s.subroot, s.rank AS srank, row_number() OVER () AS row
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
steps AS (
  SELECT i.row, t.level, t.idx AS at, string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx < t.idx) AS pre,
         string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx > t.idx) AS post
  FROM ids i
  JOIN trees t ON t.source IS NOT DISTINCT FROM i.source AND t.n > 1 AND t.idx = i.rank // CAST(pow(3, t.level) AS BIGINT)
  JOIN trees o ON o.source IS NOT DISTINCT FROM i.source AND o.level = t.level AND o.idx // 3 = t.idx // 3
  GROUP BY ALL
  UNION ALL
  SELECT i.row, i.height + t.level, t.idx AS at, string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx < t.idx),
         string_agg(o.digest, '' ORDER BY o.idx) FILTER (o.idx > t.idx)
  FROM ids i JOIN tops t ON t.n > 1 AND t.idx = i.srank // CAST(pow(3, t.level) AS BIGINT)
  JOIN tops o ON o.level = t.level AND o.idx // 3 = t.idx // 3
  GROUP BY ALL),
walks AS (
  SELECT row, claimed AS node, list(coalesce(pre, '') ORDER BY level) FILTER (level IS NOT NULL) AS pre,
         list(coalesce(post, '') ORDER BY level) FILTER (level IS NOT NULL) AS post,
         sha256(coalesce(string_agg(coalesce(pre, '') || coalesce(post, ''), '' ORDER BY level), '')) AS proof_sha256
  FROM ids LEFT JOIN steps USING (row) GROUP BY row, claimed),
folds AS (
  SELECT row, node, pre, post, 0 AS done FROM walks
  UNION ALL
  SELECT row, sha256(pre[done + 1] || node || post[done + 1]), pre, post, done + 1 FROM folds
  WHERE done < len(coalesce(pre, [])))
SELECT i.doc_id, i.leaf, i.subroot, r.digest AS root, w.proof_sha256, f.node AS folded_root,
       f.node = r.digest AS verified
FROM ids i JOIN walks w USING (row) JOIN folds f ON f.row = i.row AND f.done = len(coalesce(f.pre, []))
JOIN (SELECT digest FROM tops WHERE n = 1) r ON true"""
