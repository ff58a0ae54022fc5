"""Decoding the x value a measure column's name stands for."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Column-name forms and the sign each gives to its number.
AXIS_FORMS = [
    (r"^\s*ft(\d+)m\s*$", -1.0),
    (r"^\s*ft(\d+)\s*$", 1.0),
    (r"^\s*m(\d+)\s*$", -1.0),
    (r"^\s*p(\d+)\s*$", 1.0),
    (r"^\s*WS(\d+)\s*$", 1.0),
]


def axis_of(name: str) -> float | None:
    """x of one column name, for contract checks on a schema; None for a metadata column."""
    for pattern, sign in AXIS_FORMS:
        found = re.match(pattern, name)
        if found:
            return sign * int(found[1]) + 0.0
    return None


def axis_value(c: Column) -> Column:
    """The same decoding as a column, for names that are data."""
    hits = [
        F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1).cast("double") * sign + 0.0)
        for pattern, sign in AXIS_FORMS
    ]
    return F.coalesce(*hits)


def measure_columns(columns: list[str]) -> dict[str, float]:
    """Measure columns of a wide table with their x, in x order."""
    found = {c: axis_of(c) for c in columns}
    return dict(sorted(((c, x) for c, x in found.items() if x is not None), key=lambda item: item[1]))
