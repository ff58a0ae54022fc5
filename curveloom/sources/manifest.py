"""Source declarations and integrity of the files behind a library."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sources_for(sources: DataFrame, perils: list[str], known: list[str], shared: str = "all") -> DataFrame:
    """Declared sources of the given perils plus the shared ones; an unknown peril is an error."""
    unknown = sorted(set(perils) - set(known))
    if unknown:
        raise ValueError(f"unknown peril(s) {unknown}; known: {sorted(known)}")
    return sources.where(F.col("peril").isin(*perils, shared))


def by_name(sources: DataFrame, name: str) -> DataFrame:
    return sources.where(F.col("source_file") == name)


def manifest_check(manifest: DataFrame, digests: DataFrame, expected: DataFrame | None = None,
                   row_counts: DataFrame | None = None) -> DataFrame:
    """Status of every file: ok, differs, missing, not in manifest, or not hashed (a digest that is NULL).

    ``expected`` (source_file, expected_bytes, expected_rows) adds size and row checks; a NULL
    expectation is not checked.
    """
    listed = manifest.select("source_file", F.col("sha256").alias("recorded"))
    found = digests.select("source_file", F.col("sha256").alias("actual"), "bytes")
    status = (
        F.when(F.col("bytes").isNull(), "missing")
        .when(F.col("recorded").isNull(), "not in manifest")
        .when(F.col("actual").isNull(), "not hashed")
        .when(F.col("recorded") == F.col("actual"), "ok")
        .otherwise("differs")
    )
    out = listed.join(found, "source_file", "full_outer").select("source_file", "bytes", status.alias("status"))
    if expected is None:
        return out
    out = out.join(expected, "source_file", "left")
    size_ok = F.col("expected_bytes").isNull() | F.col("bytes").isNull() | (F.col("bytes") == F.col("expected_bytes"))
    if row_counts is None:
        return out.select("source_file", "bytes", "status", size_ok.alias("size_ok"))
    counted = out.join(row_counts, "source_file", "left")
    rows_ok = F.col("expected_rows").isNull() | F.col("n_rows").isNull() | (F.col("n_rows") == F.col("expected_rows"))
    return counted.select("source_file", "bytes", "status", size_ok.alias("size_ok"), rows_ok.alias("rows_ok"))
