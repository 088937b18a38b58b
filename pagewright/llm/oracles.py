r"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from pagewright.llm.fixtures import MAIN_TEXT

OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
), m AS (
  SELECT x, min(y) AS component_id FROM r GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN m ON x = doc_id
"""

OP2 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages
), q AS (
  SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, (5 * (i // 4) + 1)::INT, 5))::BIGINT >> (5 * (3 - i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""

OP3 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), u AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND NOT list_bool_or(list_transform(e, lambda x: x IS NULL OR NOT isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))
), p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), e AS (
  SELECT x, y FROM p UNION ALL SELECT y, x FROM p
), r(x, y) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
), m AS (
  SELECT x, min(y) AS component_id FROM r GROUP BY x
), n AS (
  SELECT x, count(*) AS n_links FROM e GROUP BY x
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN m ON m.x = vec_id LEFT JOIN n ON n.x = vec_id
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s
), r AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS level FROM w
), f AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0.0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS water
  FROM r WINDOW o AS (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), h AS (
  SELECT *, level <= water AS is_full, min(CASE WHEN level > water THEN {'level': level, 'water': water} END) OVER () AS height FROM f
), t AS (
  SELECT source, source_size, coalesce(CASE WHEN is_full THEN cap ELSE least(cap, height['water'] * weight) END, 0.0::DOUBLE) AS target FROM h
), p AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END) AS whole FROM t
), q AS (
  SELECT *, target - whole * source_size AS part FROM p
), b AS (
  SELECT source, u >> 8 AS bin, sum(size) AS words FROM d GROUP BY ALL
), c AS (
  SELECT b.source, bin, words, sum(words) OVER (PARTITION BY b.source ORDER BY bin) AS so_far, part
  FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source
), x AS (
  SELECT source, min(bin) AS bin FROM c WHERE so_far > part GROUP BY source
), l AS (
  SELECT c.source, (c.bin + CASE WHEN 2 * (part - (so_far - words)) >= words THEN 1 ELSE 0 END) << 8 AS lim
  FROM c JOIN x ON c.source IS NOT DISTINCT FROM x.source AND c.bin = x.bin
)
SELECT d.doc_id, d.size, q.source_size, q.target,
  ((q.whole::BIGINT + CASE WHEN part > 0 AND (CASE WHEN lim IS NOT NULL THEN u < lim ELSE part >= q.source_size END) THEN 1 ELSE 0 END) * d.size)::BIGINT AS taken,
  d.source,
  (q.whole::BIGINT + CASE WHEN part > 0 AND (CASE WHEN lim IS NOT NULL THEN u < lim ELSE part >= q.source_size END) THEN 1 ELSE 0 END)::BIGINT AS repeats
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN l ON d.source IS NOT DISTINCT FROM l.source
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents
), k AS (
  SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id ASC) AS keep_id,
    count(*) OVER (PARTITION BY norm) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""

# Every page of the table has its text in one plain article element.
OP4 = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM pages
), d AS (
  SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM a
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM d
"""

MAIN_TEXT_FIXTURES = "SELECT page_id::BIGINT AS page_id, text, length(text)::BIGINT AS n_chars FROM (VALUES " + ", ".join(
    f"({i}, '{text}')" for i, (_, text) in enumerate(MAIN_TEXT)
) + ") AS v(page_id, text)"

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": OP1,
    "op2_warc": OP2,
    "op3_embedding_dedup": OP3,
    "main_text_fixtures": MAIN_TEXT_FIXTURES,
    "op4_html_text": OP4,
    "op7_mixing": OP7,
    "op9_exact_dedup": OP9,
}
