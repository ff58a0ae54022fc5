"""The licence scan as DuckDB SQL."""

from __future__ import annotations

from curveloom.llm.licenses import COPYRIGHT_LINE, KNOWN, PUNCTUATION, SPELLINGS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _lines(text: str) -> str:
    plain = f"regexp_replace(lower(coalesce({text}, '')), {_quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
    plain = f"regexp_replace({plain}, {_quoted(PUNCTUATION)}, ' ', 'g')"
    for other, chosen in SPELLINGS:
        plain = f"replace({plain}, '{other}', '{chosen}')"
    return f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


SQL = f"""
WITH known(license, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}),
entry AS (SELECT sha256(array_to_string({_lines("text")}, ' ')) AS key, min(license) AS name FROM known GROUP BY 1),
scanned AS (SELECT doc_id, {_lines("text")} AS lines FROM documents),
notice AS (
  SELECT doc_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT name)), ',') AS names
  FROM (SELECT doc_id, unnest(lines) AS line FROM scanned) l JOIN entry ON key = sha256(line) GROUP BY 1)
SELECT s.doc_id, sha256(array_to_string(lines, ' ')) AS digest, e.name AS license,
  coalesce(n, 0)::BIGINT AS n_notices, coalesce(names, '') AS notices
FROM scanned s LEFT JOIN entry e ON e.key = sha256(array_to_string(lines, ' ')) LEFT JOIN notice USING (doc_id)
"""
