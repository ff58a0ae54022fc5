"""Statements and code tables found in page text.  Page tables have (doc, page, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curveloom.fixed_values import CODE_ROW_PATTERN, CODE_TABLE_HEADER, NEXT_TABLE_PATTERN, PAGE_LABEL_PATTERN
from curveloom.functions.literal import literal_frame
from curveloom.functions.text import fold_blanks, printed_label
from curveloom.operators.skew import salted_join
from curveloom.sources.writers import materialize


def sentence_around(flat: Column, pattern: str) -> Column:
    """The first match with the rest of its sentence: back to the last full stop before it and on to
    the next one after it, or to the end of the match when none follows."""
    at = F.regexp_instr(flat, F.lit(pattern))
    match = F.regexp_extract(flat, pattern, 0)
    before = F.substr(flat, F.lit(1), at - 1)
    after = F.substr(flat, at + F.length(match))
    rest = F.when(after.contains("."), F.concat(F.substring_index(after, ".", 1), F.lit("."))).otherwise("")
    return F.trim(F.concat(F.substring_index(before, ".", -1), match, rest))


def find_evidence(pages: DataFrame, claims: list[tuple[str, str, str]]) -> DataFrame:
    """For each claim (key, doc, regex): the first page of the document that states it, the page's
    printed label and the sentence around the match; ``found`` is false when no page does.

    Pages are read once: every claim is a literal pattern tested on the folded text, and only hits
    leave the scan, so no page text is shuffled.
    """
    claim_rows = literal_frame(pages.sparkSession, claims, "key string, doc string, pattern string")
    flat = pages.where(F.col("doc").isin(sorted({doc for _, doc, _ in claims}))).select(
        "doc", "page", fold_blanks(F.col("text")).alias("flat"), printed_label(F.col("text"), PAGE_LABEL_PATTERN).alias("label")
    )
    hits = [
        F.when(
            (F.col("doc") == doc) & F.col("flat").rlike(f"(?is){pattern}"),
            F.struct(F.lit(key).alias("key"), sentence_around(F.col("flat"), f"(?is){pattern}").alias("quote")),
        )
        for key, doc, pattern in claims
    ]
    found = (
        flat.select("page", "label", F.explode(F.array(*hits)).alias("hit"))
        .where("hit IS NOT NULL")
        .select("page", "label", "hit.key", "hit.quote")
        .groupBy("key")
        .agg(F.min(F.struct("page", "label", "quote")).alias("first"))
    )
    return claim_rows.join(found, "key", "left").select(
        "key",
        "doc",
        F.col("first").isNotNull().alias("found"),
        F.col("first.page").alias("page"),
        F.col("first.label").alias("printed_page"),
        F.col("first.quote").alias("quote"),
    )


def code_rows(pages: DataFrame, header: str = CODE_TABLE_HEADER) -> DataFrame:
    """One small row per page: doc, page, has_header and ``rows``, the lines ``NN_CODE description``."""
    parsed = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            i.alias("pos"),
            F.regexp_extract(line, CODE_ROW_PATTERN, 2).alias("code"),
            fold_blanks(F.regexp_extract(line, CODE_ROW_PATTERN, 3)).alias("description"),
        ),
    )
    rows = F.filter(parsed, lambda r: r["code"] != "")
    return pages.select("doc", "page", F.col("text").contains(header).alias("has_header"), rows.alias("rows"))


def code_table(page_rows: DataFrame, strict: bool = False) -> DataFrame:
    """The code table of each document from its ``code_rows``; see ``extract_code_table``."""
    is_next = F.col("row.description").rlike(NEXT_TABLE_PATTERN)
    place = F.struct("page", F.col("row.pos").alias("pos"))
    starts = page_rows.where("has_header").groupBy("doc").agg(F.min("page").alias("start"))
    inside = salted_join(page_rows, starts, ["doc"], ["page"], "inner")
    inside = inside.where(F.col("page") >= F.col("start")).select("doc", "page", "rows")
    lines = inside.select("doc", "page", F.explode("rows").alias("row"))
    ends = lines.groupBy("doc").agg(
        F.min(F.when(is_next, place)).alias("next_table"),
        F.min(F.when(~is_next, F.col("page"))).alias("first_page"),
    )
    # the first page without rows after the table began
    blanks = (
        salted_join(inside.where(F.size("rows") == 0), ends.select("doc", "first_page"), ["doc"], ["page"], "inner")
        .where(F.col("page") > F.col("first_page"))
        .groupBy("doc")
        .agg(F.min("page").alias("blank_page"))
    )
    kept = (
        salted_join(lines, ends.join(blanks, "doc", "left"), ["doc"], ["page"], "inner")
        .where(F.col("next_table").isNull() | (place < F.col("next_table")))
        .where(F.col("blank_page").isNull() | (F.col("page") < F.col("blank_page")))
    )
    table = kept.groupBy("doc", F.col("row.code").alias("code")).agg(
        F.min("row.description").alias("description"), F.count_distinct("row.description").alias("n_descriptions")
    )
    if strict:
        message = F.concat(F.lit("code has different descriptions: "), F.col("code"))
        table = table.where(F.when(F.col("n_descriptions") == 1, True).otherwise(F.raise_error(message).cast("boolean")))
    return table


def extract_code_table(pages: DataFrame, header: str = CODE_TABLE_HEADER, strict: bool = False) -> DataFrame:
    """(doc, code, description, n_descriptions) of the code table that each document holds.

    The table starts on the first page with the header and ends at the first row of the next table,
    or at the first page without rows after it has begun.  A code with several descriptions is a
    conflict: reported by ``n_descriptions``, or an error with ``strict``.

    Page text is read and matched once; the small rows found are written to the shared folder and
    everything after works on them.
    """
    return code_table(materialize(code_rows(pages, header), "code-rows"), strict)
