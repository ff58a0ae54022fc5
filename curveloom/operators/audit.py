"""Column profiles, claims against measurements, and code lists against the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def profile_table(df: DataFrame, columns: list[str] | None = None, exact: bool = True, n_sample: int = 3) -> DataFrame:
    """Per column: type, rows, NULLs, distinct values and the smallest sample values as text.

    Values are counted per (column, value) and combined before the shuffle; only distinct values
    travel.  ``exact=False`` uses a sketch in one aggregate instead; its only sample is the smallest value.
    """
    names = columns or df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    if not exact:
        stats = []
        for i, c in enumerate(names):
            stats += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.approx_count_distinct(c).alias(f"d{i}"), F.min(F.col(c).cast("string")).alias(f"s{i}")]
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), *stats)
        rows = [
            F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("type"), F.col("n_rows").alias("n_rows"),
                     F.col(f"n{i}").alias("n_null"), F.col(f"d{i}").alias("n_distinct"),
                     *[(F.col(f"s{i}") if k == 0 else F.lit(None).cast("string")).alias(f"sample_{k + 1}") for k in range(n_sample)])
            for i, c in enumerate(names)
        ]
        return one.select(F.inline(F.array(*rows)))
    long = df.select([F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "column_name", "value")
    values = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
    )
    # Each task keeps n_sample values per column before the shuffle.  Reading n here too makes both
    # branches ask for the same shuffle of distinct values, which Spark then runs once.
    smallest = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_last())
    sample = (
        values.where("n > 0")
        .withColumn("rank", F.row_number().over(smallest))
        .where(F.col("rank") <= n_sample)
        .groupBy("column_name")
        .agg(*[F.max(F.when(F.col("rank") == i + 1, F.col("value"))).alias(f"sample_{i + 1}") for i in range(n_sample)])
    )
    type_of = F.create_map(*[F.lit(v) for c in names for v in (c, types[c])])
    return (
        counts.join(sample, "column_name", "left")
        .select("column_name", type_of[F.col("column_name")].alias("type"), "n_rows", "n_null", "n_distinct",
                *[f"sample_{i + 1}" for i in range(n_sample)])
    )


def stated_vs_measured(claims: DataFrame, measures: DataFrame) -> DataFrame:
    """Claims (key, stated) with what the data says; a claim nobody measured is kept as not measured."""
    verdict = (
        F.when(F.col("measured").isNull(), "not measured")
        .when(F.col("stated") == F.col("measured"), "match")
        .otherwise("differs")
    )
    return claims.join(measures, "key", "left").select("key", "stated", "measured", verdict.alias("verdict"))


def code_census(used: DataFrame, documented: DataFrame, column: str = "code") -> DataFrame:
    """One row: distinct codes documented, used, used but undocumented, and in either."""
    both = (
        used.select(column, F.lit(1).alias("u"), F.lit(0).alias("d"))
        .unionByName(documented.select(column, F.lit(0).alias("u"), F.lit(1).alias("d")))
        .groupBy(column)
        .agg(F.max("u").alias("u"), F.max("d").alias("d"))
    )
    return both.agg(
        F.count_if(F.col("d") == 1).alias("n_documented"),
        F.count_if(F.col("u") == 1).alias("n_used"),
        F.count_if((F.col("u") == 1) & (F.col("d") == 0)).alias("n_undocumented"),
        F.count(F.lit(1)).alias("n_union"),
    )


def dimension_gaps(data_codes: DataFrame, listed: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """Codes in the data but not listed (``missing``), and listed but not in the data (``unused``).

    Only a missing code is an error; ``strict`` fails the job on it.
    """
    present = data_codes.where(F.col(column).isNotNull()).select(column).distinct()
    known = listed.select(column).distinct()
    marked = present.join(known.withColumn("_known", F.lit(True)), column, "left")
    missing_test = F.col("_known").isNull()
    if strict:
        message = F.concat(F.lit("no description found for: "), F.col(column))
        missing_test = F.when(F.col("_known"), False).otherwise(F.raise_error(message).cast("boolean"))
    missing = marked.where(missing_test).select(column, F.lit("missing").alias("gap"))
    unused = known.join(present, column, "left_anti").withColumn("gap", F.lit("unused"))
    return missing.unionByName(unused)
