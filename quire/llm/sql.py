"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP6 = f"""
WITH lines AS (
  SELECT doc_id, u.line, u.i AS pos, translate(trim(u.line, {_TRIM}), '{_UPPER}', '{_LOWER}') AS key
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS u(line, i)
), often AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.doc_id, l.line, l.pos, o.key IS NOT NULL AND l.doc_id <> o.last AS gone
  FROM lines l LEFT JOIN often o ON l.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP7 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i AS start, array_to_string(w[i:i + 49], ' ') AS words
  FROM words, unnest(range(1, len(w) - 48)) AS u(i) WHERE len(w) >= 50
), firsts AS (
  SELECT words, min(doc_id) AS first FROM windows GROUP BY words HAVING min(doc_id) <> max(doc_id)
), covered AS (
  SELECT DISTINCT v.doc_id, v.start + k AS pos
  FROM windows v JOIN firsts f ON v.words = f.words AND v.doc_id > f.first, unnest(range(0, 50)) AS u(k)
), each_word AS (
  SELECT doc_id, u.word, u.i AS pos FROM words, unnest(w) WITH ORDINALITY AS u(word, i)
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.pos) FILTER (WHERE c.pos IS NULL) AS t, count(c.pos) AS n
  FROM each_word e LEFT JOIN covered c ON e.doc_id = c.doc_id AND e.pos = c.pos GROUP BY e.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(k.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

OP9 = r"""
WITH grams AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), '[^\x20\x09-\x0D]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), '[^\x20\x09-\x0D]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s
  FROM grams, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5
), items AS (
  SELECT id, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE side = 'b'
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(i.n) AS item_shingles, count(*) AS found_shingles,
       count(*)::DOUBLE / any_value(i.n) AS containment
FROM items i JOIN shingles d ON d.side = 'd' AND d.s = i.s
GROUP BY d.id, i.id HAVING 100 * count(*) >= 75 * any_value(i.n)
""".replace("UPPER", _UPPER).replace("LOWER", _LOWER)

OP11 = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'UPPER', 'LOWER'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), counted AS (
  SELECT row, doc_id, w, len(w) AS n FROM doc_words WHERE len(w) > 0
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM counted
), postings AS (
  SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, u.term, count(*) AS tf FROM counted, unnest(w) AS u(term) GROUP BY row, u.term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, corpus GROUP BY term, docs
), items AS (
  SELECT item_id, u.term, count(*) AS times
  FROM benchmark, unnest(regexp_extract_all(translate(text, 'UPPER', 'LOWER'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS u(term)
  GROUP BY item_id, u.term
), scores AS (
  SELECT i.item_id, p.row, any_value(p.doc_id) AS doc_id,
         CAST(sum(i.times * w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * c.docs) // c.words)))) AS BIGINT) AS score
  FROM items i JOIN weights w USING (term) JOIN postings p USING (term), corpus c GROUP BY i.item_id, p.row
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores WHERE score > 0
) WHERE rank <= 20
""".replace("UPPER", _UPPER).replace("LOWER", _LOWER)

OP12 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""

# crc32 of a string, byte by byte; the table of the 256 single bytes follows from the polynomial
OP13 = r"""
WITH crc_table AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
  FROM range(256) AS r(n)
), texts AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(text, 'UPPER', 'LOWER'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'UPPER', 'LOWER'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), features AS (
  SELECT side, id, u.g FROM texts, unnest(w) AS u(g)
  UNION ALL
  SELECT side, id, w[i] || ' ' || w[i + 1] FROM texts, unnest(range(1, len(w))) AS r(i)
), counted AS (
  SELECT side, id, g, count(*) AS n FROM features GROUP BY side, id, g
), hashed AS (
  SELECT g, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(1, octet_length(encode(g)) + 1), lambda i: ('0x' || substr(hex(encode(g)), 2 * i - 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM counted), crc_table
), buckets AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t
  FROM counted JOIN hashed USING (g) GROUP BY bucket
), sums AS (
  SELECT coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s_all, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t_all FROM counted
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM buckets, sums
), weights AS (
  SELECT id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
  FROM counted JOIN hashed USING (g) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT d.id AS doc_id, coalesce(len(d.w), 0) AS n_words, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
         CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM texts d LEFT JOIN weights w ON w.id = d.id WHERE d.side = 'd'
), ranked AS (
  SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS r FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND r <= (25 * (SELECT count(*) FROM scored WHERE n_words >= 20)) // 100 THEN r END AS rank
FROM ranked
""".replace("UPPER", _UPPER).replace("LOWER", _LOWER)

ORACLES: dict[str, str] = {"op6_line_dedup": OP6, "op7_substring_dedup": OP7, "op9_benchmark_decontamination": OP9, "op11_ranked_lexical_search": OP11,
                           "op12_exact_top_k": OP12, "op13_importance_resampling": OP13}
