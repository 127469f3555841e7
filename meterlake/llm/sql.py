"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""

OP12 = """
WITH RECURSIVE framed AS (
  SELECT doc_id, source, text,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head,
    list_reduce(range(8 * strlen(doc_id::VARCHAR)), LAMBDA c, i: xor(
      xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) ELSE 0 END) >> 1,
      3988292384 * (xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) ELSE 0 END) & 1)
    ), 4294967295) AS inverted_crc
  FROM documents
), digested AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN inverted_crc & 1 = 1 AND text IS NOT NULL
      THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) END AS tampered
  FROM framed
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n,
    count(*) OVER (PARTITION BY source) AS size, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM digested
), up AS (
  SELECT tree, n, size, 0 AS level, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, n // 3, (size + 2) // 3, level + 1, sha256(string_agg(digest, '' ORDER BY n))
  FROM up WHERE size > 1 GROUP BY tree, n // 3, size, level
), top AS (
  SELECT tree AS n, count(*) OVER () AS size, 0 AS level, digest FROM up WHERE size = 1
  UNION ALL
  SELECT n // 3, (size + 2) // 3, level + 1, sha256(string_agg(digest, '' ORDER BY n))
  FROM top WHERE size > 1 GROUP BY n // 3, size, level
), nodes AS (
  SELECT tree, n, level, 0 AS part, digest FROM up WHERE size > 1
  UNION ALL SELECT -1, n, level, 1, digest FROM top WHERE size > 1
), sides AS (
  SELECT tree, n, level, part,
    coalesce(string_agg(digest, '') OVER (w ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(digest, '') OVER (w ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WINDOW w AS (PARTITION BY tree, level, n // 3)
), ways AS (
  SELECT l.tree, l.n, list(s.before || '|' || s.after ORDER BY s.part, s.level) AS way,
    coalesce(string_agg(s.before || s.after, '' ORDER BY s.part, s.level), '') AS siblings
  FROM leaves l JOIN sides s
    ON s.part = 0 AND s.tree = l.tree AND s.n = l.n // (3 ** s.level)::BIGINT
    OR s.part = 1 AND s.n = l.tree // (3 ** s.level)::BIGINT
  GROUP BY l.tree, l.n
), folded AS (
  SELECT l.doc_id, l.leaf, u.digest AS subroot, t.digest AS root, sha256(coalesce(w.siblings, '')) AS proof_sha256,
    list_reduce(coalesce(w.way, []::VARCHAR[]), LAMBDA node, s: sha256(split_part(s, '|', 1) || node || split_part(s, '|', 2)),
      coalesce(l.tampered, l.leaf)) AS folded_root
  FROM leaves l JOIN up u ON u.tree = l.tree AND u.size = 1 JOIN top t ON t.size = 1 LEFT JOIN ways w ON w.tree = l.tree AND w.n = l.n
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""

OP10 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, LAMBDA x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, LAMBDA x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), LAMBDA p: p[1] * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op10_threshold_topk": OP10, "op12_merkle_manifest": OP12}
