"""The SpotSigs fingerprints as DuckDB SQL."""

from __future__ import annotations

from curveloom.llm.spotsigs import ANCHORS, CHAIN, DIGITS, NOT_WORD, REACH, SKIPPED


def _listed(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _spots(text: str) -> str:
    words = f"list_prepend('^', list_filter(regexp_split_to_array(lower({text}), '{NOT_WORD}'), lambda w: w <> ''))"
    content = (
        f"list_filter(words[i + 1:i + {REACH}], lambda x: NOT list_contains({_listed((*ANCHORS, *SKIPPED))}, x))"
    )
    spot = f"substring(md5(array_to_string(list_prepend(w, ({content})[1:{CHAIN}]), ':')), 1, {DIGITS})"
    found = (
        f"list_transform(words, lambda w, i: CASE WHEN list_contains({_listed(('^', *ANCHORS))}, w)"
        f" AND len({content}) > 0 THEN {spot} END)"
    )
    return f"(SELECT list_sort(list_distinct(list_filter({found}, lambda s: s IS NOT NULL))) FROM (SELECT {words} AS words))"


def _likeness(a: str, b: str) -> str:
    shared = f"len(list_intersect({a}, {b}))"
    return (
        f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0"
        f" ELSE {shared}::DOUBLE / (len({a}) + len({b}) - {shared}) END"
    )


SQL = f"""
WITH own AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id DESC), max(doc_id) OVER ()) AS next_id
  FROM documents),
edited AS (
  SELECT a.doc_id, a.n, a.next_id, a.text, substring(a.text, 1, a.n - a.n // 2) || substring(b.text, 1, a.n // 2) AS edited
  FROM own a JOIN own b ON b.doc_id = a.next_id),
signed AS (SELECT doc_id, n, next_id, edited, {_spots("text")} AS spots, {_spots("edited")} AS edited_spots FROM edited)
SELECT a.doc_id, a.n AS n_chars, sha256(a.edited) AS edited_sha256,
  array_to_string(a.spots, '') AS fingerprint, array_to_string(a.edited_spots, '') AS edited_fingerprint,
  {_likeness("a.spots", "a.edited_spots")} AS near_edited, {_likeness("a.spots", "b.spots")} AS near_next
FROM signed a JOIN signed b ON b.doc_id = a.next_id
"""
