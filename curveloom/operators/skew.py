"""Joins whose left side may have hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SALT = 8


def spread(df: DataFrame, columns: list[str], salt: int) -> DataFrame:
    """Add ``_salt`` from the row's own values, so a task that is run again places it the same way."""
    types = {f.name: f.dataType for f in df.schema}
    hashed = [c for c in columns if not isinstance(types[c], (T.MapType, T.VariantType))]
    return df.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(salt)))


def replicate(df: DataFrame, salt: int) -> DataFrame:
    """Each row once per salt value."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint"))))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    salt: int = SALT,
    condition: Column | None = None,
) -> DataFrame:
    """Equi join on ``keys`` in which a hot key of the left side is spread over ``salt`` partitions.

    The right side is repeated ``salt`` times, so it should be the small one.  The salt also gives
    both sides a shuffle of their own, which Spark needs to split what is still skewed: an aggregate
    that already has the right partitioning would be joined as it is, and is never split.  A salt of
    1 repeats nothing and only brings that shuffle.
    """
    a, b = spread(left, spread_by, salt), replicate(right, salt)
    if condition is None:
        return a.join(b, [*keys, "_salt"], how).drop("_salt")
    b = b.withColumnsRenamed({c: f"_right_{c}" for c in [*keys, "_salt"]})
    on = condition
    for c in [*keys, "_salt"]:
        on = on & (F.col(c) == F.col(f"_right_{c}"))
    return a.join(b, on, how).drop("_salt", "_right__salt")
