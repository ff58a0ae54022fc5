"""The collocations of ``documents`` in DuckDB SQL."""

SQL = r"""
WITH piece AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang,
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
gram AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM split, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM gram GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidate AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND f >= 10),
part AS (
  SELECT lang, phrase, f AS a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
  FROM candidate, (SELECT unnest([1, 2]) AS j) WHERE j < k),
headed AS (SELECT part.*, f.f AS l FROM part JOIN f ON f.lang = part.lang AND f.phrase = head),
cut AS MATERIALIZED (
  SELECT h.lang, h.phrase, a, j, l, f.f AS r, 1000000::HUGEINT * a * a // (l::HUGEINT * f.f) AS score
  FROM headed h JOIN f ON f.lang = h.lang AND f.phrase = tail),
scored AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM candidate WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM candidate WHERE k = 3),
around AS (SELECT lang, phrase, max(f) AS f FROM inside GROUP BY ALL),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN around i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.f IS NULL OR 100 * i.f < 50 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000
"""
