"""Wide source tables to tidy curves, points and attributes, and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from curveloom.fixed_values import CODE_WIDTH, TERRITORY_KEYWORDS, UNMAPPED_KEY
from curveloom.functions.axis import axis_of, measure_columns
from curveloom.functions.text import clean_text, parse_measure, strip


def melt_points(wide: DataFrame, measures: list[str] | None = None, text: bool = False) -> DataFrame:
    """(curve_id, x, y), one row per curve and grid value; NULL y is kept.

    ``text`` parses measures read as text and stops on a value that is no number.
    """
    names = measures or list(measure_columns(wide.columns))
    value = (lambda c: parse_measure(F.col(c), strict=True)) if text else (lambda c: F.col(c).cast("double"))
    # x follows from the schema, so no column name is decoded per point
    cells = [F.struct(F.lit(axis_of(c)).cast("double").alias("x"), value(c).alias("y")) for c in names]
    return wide.select("curve_id", F.inline(F.array(*cells)))


def melt_curves(wide: DataFrame, roles: dict[str, str], literals: dict[str, str]) -> DataFrame:
    """One metadata row per curve: mapped columns are cleaned and renamed, literals added.

    Rows whose id is blank carry no curve and are skipped.
    """
    mapped = [
        clean_text(F.col(source)).alias(target)
        for source, target in roles.items()
        if source in wide.columns and not target.startswith("attr:")
    ]
    rows = wide.select(*(["curve_id"] if "curve_id" in wide.columns else []), *mapped)
    rows = rows.where("source_row_id IS NOT NULL")
    return rows.select("*", *[F.lit(v).alias(k) for k, v in literals.items()])


def melt_attributes(wide: DataFrame, keys: dict[str, str]) -> DataFrame:
    """(curve_id, key, value) from the columns in ``keys`` (column -> key); NULLs dropped."""
    as_text = wide.select("curve_id", *[F.col(c).cast("string").alias(k) for c, k in keys.items()])
    return as_text.unpivot(["curve_id"], list(keys.values()), "key", "value").where("value IS NOT NULL")


def split_codes(df: DataFrame, column: str, width: int = CODE_WIDTH) -> DataFrame:
    """One row per fixed-width code of ``column``: adds ``pos`` (from 0) and ``code``."""
    text = F.coalesce(strip(F.col(column)), F.lit(""))
    last = F.ceil(F.length("_codes") / F.lit(width)).cast("int") - 1
    return (
        df.withColumn("_codes", text)
        .where(F.length("_codes") > 0)
        .withColumn("pos", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("code", F.substr("_codes", F.col("pos") * width + 1, F.lit(width)))
        .drop("_codes")
    )


def decode_codes(
    typed: DataFrame, key: str, column: str, dictionary: DataFrame, width: int = CODE_WIDTH
) -> DataFrame:
    """(key, attribute key, value) decoded from code strings.

    ``typed`` has one row per type, not per curve, so each string is split once.  ``dictionary`` is
    (code, char_type, name).  A code without an entry keeps its text: all of them are joined with
    commas in source order under one reserved key.  That list is no longer than the code string.
    """
    split = split_codes(typed.select(key, column), column, width)
    joined = split.join(dictionary, "code", "left")
    known = joined.where("char_type IS NOT NULL AND name IS NOT NULL").select(
        key, F.col("char_type").alias("key"), F.col("name").alias("value")
    )
    unknown = (
        joined.where("char_type IS NULL")
        .groupBy(key)
        .agg(F.array_sort(F.collect_set(F.struct("pos", "code"))).alias("codes"))
        .select(key, F.lit(UNMAPPED_KEY).alias("key"), F.array_join("codes.code", ",").alias("value"))
    )
    return known.unionByName(unknown)


def unmapped_histogram(typed: DataFrame, column: str, dictionary: DataFrame, width: int = CODE_WIDTH) -> DataFrame:
    """How often each code without a dictionary entry occurs, most frequent first."""
    counts = split_codes(typed.select(column), column, width).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(dictionary, "code", "left_anti").orderBy(F.desc("n"), "code")


def code_totals(typed: DataFrame, column: str, dictionary: DataFrame, width: int = CODE_WIDTH) -> DataFrame:
    """Occurrences of codes with and without a dictionary entry."""
    counts = split_codes(typed.select(column), column, width).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    marked = counts.join(dictionary.select("code", F.lit(1).alias("hit")), "code", "left")
    return marked.agg(
        F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n"))), F.lit(0)).alias("n_decoded"),
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("n"))), F.lit(0)).alias("n_undecoded"),
    )


def attributes_map(attributes: DataFrame) -> DataFrame:
    """(curve_id, map of key to value).  Copies of a row count once; two values of a key fail the job."""
    entries = F.collect_set(F.struct("key", "value"))
    return attributes.groupBy("curve_id").agg(F.map_from_entries(entries).alias("attributes"))


def widen_points(points: DataFrame, grid: list[float], prefix: str = "y") -> DataFrame:
    """One row per curve with one column per grid value (``y_0`` .. ``y_n``), plus point counts.

    Conditional aggregates have a fixed-size buffer and combine before the shuffle, so neither a
    long curve nor a repeated one can grow a task.
    """
    grid = sorted(float(g) for g in grid)
    cells = [F.max(F.when(F.col("x") == g, F.col("y"))).alias(f"{prefix}_{i}") for i, g in enumerate(grid)]
    present = [F.bool_or(F.col("x") == g).alias(f"has_{i}") for i, g in enumerate(grid)]
    return points.groupBy("curve_id").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(~F.col("x").isin(grid)).alias("n_off_grid"), *cells, *present
    )


def pack_curve(points: DataFrame, grid: list[float]) -> DataFrame:
    """(curve_id, n_points, ys): the y values in x order as one array, NULL kept.

    The grid contract bounds the array; a curve off the grid stops the job.
    """
    wide = widen_points(points, grid)
    ys = F.array(*[F.col(f"y_{i}") for i in range(len(grid))])
    broken = (F.col("n_off_grid") > 0) | (F.col("n_points") != len(grid))
    message = F.concat(F.lit("curve is not sampled once per grid value: "), F.col("curve_id"))
    checked = F.when(broken, F.raise_error(message).cast("array<double>")).otherwise(ys)
    return wide.select("curve_id", "n_points", checked.alias("ys"))


def pack_pairs(packed: DataFrame, grid: list[float]) -> DataFrame:
    """Packed y arrays as arrays of (x, y) pairs."""
    xs = F.array(*[F.lit(float(g)) for g in sorted(grid)])
    pairs = F.transform(F.arrays_zip(xs.alias("x"), F.col("ys").alias("y")), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return packed.select("curve_id", pairs.alias("points"))


def union_vintages(*parts: DataFrame) -> DataFrame:
    """Stack tables by column name; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dedup_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark limits each key to one row per task before the shuffle, so a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def flags_to_zones(df: DataFrame, flags: dict[str, str], ids: list[str]) -> DataFrame:
    """One row per zone whose flag is 1; blank, NULL and 0 mean not set."""
    flagged = df.select(*ids, *[parse_measure(F.col(c).cast("string")).alias(z) for z, c in flags.items()])
    long = flagged.unpivot(ids, list(flags), "flood_zone", "_flag")
    return long.where("_flag = 1").drop("_flag")


def decompose_cases(cases: DataFrame) -> DataFrame:
    """(case_name, territory, case_description): territories named in each case's description.

    A description that names none fails the job rather than being guessed.
    """
    low = F.lower("case_description")
    named = F.filter(
        F.array(*[F.when(low.contains(word), F.lit(place)) for word, place in TERRITORY_KEYWORDS]),
        lambda t: t.isNotNull(),
    )
    message = F.concat(F.lit("no territory named for case "), F.col("case_name"), F.lit(": "), F.col("case_description"))
    checked = F.when(F.size("_named") == 0, F.raise_error(message).cast("array<string>")).otherwise(F.col("_named"))
    return (
        cases.select(
            clean_text(F.col("case_name"), ("",)).alias("case_name"),
            F.coalesce(clean_text(F.col("case_description"), ("",)), F.lit("")).alias("case_description"),
        )
        .where("case_name IS NOT NULL")
        .withColumn("_named", named)
        .select("case_name", F.explode(checked).alias("territory"), "case_description")
    )


def slice_tables(tables: dict[str, DataFrame], peril: str) -> dict[str, DataFrame]:
    """The rows of each table that belong to one peril; tables keyed by curve follow their curves."""
    curves = tables["curves"].where(F.col("peril") == peril)
    ids = curves.select("curve_id")
    out = {"curves": curves}
    for name, df in tables.items():
        if name == "curves":
            continue
        if "peril" in df.columns:
            out[name] = df.where(F.col("peril") == peril)
        elif "curve_id" in df.columns:
            out[name] = df.join(ids, "curve_id", "left_semi")
        else:
            out[name] = df
    return out
