"""DuckDB SQL of the contract queries that SQL can express."""

ORACLE: dict[str, str] = {}

# CRC-32 in SQL: the table of 256 entries follows from the polynomial (fixed value
# 3988292384 = 0xEDB88320), then one fold over the UTF-8 bytes of each distinct word.
ORACLE["op13_target_resampling"] = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc_counts AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM doc_words) GROUP BY w),
item_counts AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM item_words) GROUP BY w),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM doc_counts UNION SELECT w FROM item_counts)),
hashed AS (
  SELECT w, xor(list_reduce([4294967295] || list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
                            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS b
  FROM hexed, crc_table),
s AS (SELECT b, sum(n) AS n FROM doc_counts JOIN hashed USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM item_counts JOIN hashed USING (w) GROUP BY b),
totals AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s_all, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t_all),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS g
  FROM s FULL JOIN t USING (b), totals),
word_gain AS (SELECT w, g FROM hashed JOIN gain USING (b)),
weights AS (
  SELECT doc_id, sum(g)::BIGINT AS weight
  FROM (SELECT doc_id, unnest(w) AS w FROM doc_words) JOIN word_gain USING (w) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN r <= (SELECT 10 * count(*) // 100 FROM ranked) THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
