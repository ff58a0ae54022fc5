"""The removal of repeated word windows from ``documents`` in DuckDB SQL."""

SQL = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
place AS (SELECT row, doc_id, unnest(range(1, len(w) - 11)) AS i FROM split),
win AS (SELECT row, p.doc_id, i, md5_number(array_to_string(w[i:i + 12], ' ')) AS h FROM place p JOIN split USING (row)),
lowest AS (SELECT h, min(doc_id) AS lowest FROM win GROUP BY h),
covered AS (SELECT DISTINCT row, unnest(range(i, i + 13)) AS i FROM win JOIN lowest USING (h) WHERE doc_id > lowest),
gone AS (SELECT row, list(i) AS gone, count(*) AS n FROM covered GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM split LEFT JOIN gone USING (row)
"""
