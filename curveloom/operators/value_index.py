"""Inverted index of attribute values, for many filters on one library.

Every (key, value) has one bitmap per block of curves.  A filter reads the bitmaps of its values
only and combines them bit by bit; neither curves nor attributes are scanned again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.functions.literal import literal_frame
from curveloom.sources.writers import materialize, write_clustered

#: bytes of a bitmap, each for eight curves of a block
BITMAP_BYTES = 4096


def curve_numbers(curves: DataFrame, path: str) -> DataFrame:
    """(curve_id, block, place) of every curve, written once to ``path``.

    Numbers follow the order of the ids inside a range of them, and each range starts at a block of
    its own, so nothing is counted in one task.  They are read back from the files, since a second
    run of the job could deal the ranges differently.  Repeated ids have one number; NULL has none.
    """
    ids = curves.where("curve_id IS NOT NULL").select("curve_id").distinct()
    ranged = ids.repartitionByRange("curve_id").sortWithinPartitions("curve_id")
    number = F.monotonically_increasing_id() + 1
    ranged.select(
        "curve_id", F.bitmap_bucket_number(number).alias("block"), F.bitmap_bit_position(number).alias("place")
    ).write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return curves.sparkSession.read.parquet(path)


def write_value_index(numbers: DataFrame, attributes: DataFrame, path: str) -> DataFrame:
    """(key, value, block, bitmap) of all values of numbered curves, clustered by key and value in ``path``.

    Bitmaps are built by partial aggregation, so a value that a third of all curves have moves one
    bitmap per task and block.  A NULL value and a curve without a number are in no bitmap.
    """
    known = attributes.where("key IS NOT NULL AND value IS NOT NULL").select("curve_id", "key", "value")
    bitmaps = (
        known.join(numbers, "curve_id").groupBy("key", "value", "block")
        .agg(F.bitmap_construct_agg("place").alias("bitmap"))
    )
    # stored first: the range bounds and the row count would each compute the bitmaps again
    bitmaps = materialize(bitmaps, "bitmaps")
    write_clustered(bitmaps, path, ["key", "value", "block"])
    return attributes.sparkSession.read.parquet(path)


def filter_blocks(index: DataFrame, filters: DataFrame) -> DataFrame:
    """(filter_id, block, bitmap) of the curves that each filter leaves; blocks without any are absent.

    ``filters`` has filter_id, condition, key and value.  A filter is met where all its conditions
    are, and a condition where one of its (key, value) rows is, so a set of cases is one condition.
    Repeated rows change nothing; a NULL key or value is never met.
    """
    conditions = filters.select("filter_id", "condition", "key", "value").distinct()
    wanted = conditions.groupBy("filter_id").agg(F.count_distinct("condition").alias("n_wanted"))
    met = (
        index.join(conditions, ["key", "value"]).groupBy("filter_id", "condition", "block")
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    )
    all_met = met.groupBy("filter_id", "block").agg(
        F.count(F.lit(1)).alias("n_met"), F.bitmap_and_agg("bitmap").alias("bitmap")
    )
    kept = all_met.join(wanted, "filter_id").where("n_met = n_wanted AND bitmap_count(bitmap) > 0")
    return kept.select("filter_id", "block", "bitmap")


def filter_counts(index: DataFrame, filters: DataFrame) -> DataFrame:
    """(filter_id, n_curves) for every filter, 0 included, from the bitmaps alone."""
    counts = filter_blocks(index, filters).groupBy("filter_id").agg(F.sum(F.bitmap_count("bitmap")).alias("n"))
    every = filters.select("filter_id").distinct()
    return every.join(counts, "filter_id", "left").select("filter_id", F.coalesce("n", F.lit(0)).alias("n_curves"))


def filter_members(index: DataFrame, numbers: DataFrame, filters: DataFrame) -> DataFrame:
    """(filter_id, curve_id) of all curves that the filters leave."""
    # bytes without a curve go before anything is exploded
    byte = lambda nth: F.conv(F.hex(F.substring("bitmap", nth, F.lit(1))), 16, 10).cast("int")
    filled = F.filter(
        F.transform(F.sequence(F.lit(1), F.lit(BITMAP_BYTES)), lambda nth: F.struct((nth - 1).alias("at"), byte(nth).alias("byte"))),
        lambda b: b["byte"] != 0,
    )
    bits = (
        filter_blocks(index, filters).select("filter_id", "block", F.inline(filled))
        .select("filter_id", "block", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
    )
    places = bits.where("getbit(byte, bit) = 1").select(
        "filter_id", "block", (F.col("at") * 8 + F.col("bit")).cast("long").alias("place")
    )
    return places.join(numbers, ["block", "place"]).select("filter_id", "curve_id")


def pair_filter(index: DataFrame, pairs: list[tuple[str, str]], cases: DataFrame | None = None, territory: str | None = None) -> DataFrame:
    """``filters`` of one search: all (key, value) pairs, and a case that covers the territory."""
    columns = "filter_id int, condition int, key string, value string"
    rows = [(0, i, k, v) for i, (k, v) in enumerate(pairs)]
    if territory is None:
        return literal_frame(index.sparkSession, rows, columns)
    # the row without a value keeps the condition when no case covers the territory
    rows.append((0, len(pairs), "geographic_case", None))
    covering = cases.where(F.col("territory") == territory).select(
        F.lit(0).alias("filter_id"), F.lit(len(pairs)).alias("condition"),
        F.lit("geographic_case").alias("key"), F.col("case_name").alias("value"),
    )
    return literal_frame(index.sparkSession, rows, columns).unionByName(covering)
