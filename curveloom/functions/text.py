"""Cleaning, parsing and key-building column functions (all stay in generated code)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from curveloom.fixed_values import BLANKS, FLOOD_NULL_TOKENS


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def fold_blanks(c: Column) -> Column:
    """Runs of blanks become one space; outer blanks go.

    Text without a character from the upper range needs only the one-byte blanks, which match much
    faster than the whole list.
    """
    one_byte = "".join(b for b in BLANKS if ord(b) < 256)
    folded = F.when(
        c.rlike("[\u1680\u2000-\u3000]"), F.regexp_replace(c, f"[{BLANKS}]+", " ")
    ).otherwise(F.regexp_replace(c, f"[{one_byte}]+", " "))
    return F.trim(folded)


def clean_text(c: Column, null_tokens: tuple[str, ...] = FLOOD_NULL_TOKENS) -> Column:
    stripped = strip(c)
    return F.when(~stripped.isin(*null_tokens), stripped)


def parse_measure(
    c: Column, null_tokens: tuple[str, ...] = FLOOD_NULL_TOKENS, strict: bool = False
) -> Column:
    """Text to double; missing stays NULL.  ``strict`` stops on text that is not a number."""
    text = clean_text(c, null_tokens)
    value = text.try_cast("double")
    if not strict:
        return value
    bad = text.isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a number: "), text))).otherwise(value)


def unparsable(c: Column, null_tokens: tuple[str, ...] = FLOOD_NULL_TOKENS) -> Column:
    """True where a value is present but is not a number."""
    return clean_text(c, null_tokens).isNotNull() & parse_measure(c, null_tokens).isNull()


def numeric_coerce(c: Column) -> Column:
    return c.try_cast("double")


def normalise_id(c: Column) -> Column:
    """105.0, '105.0' and ' 105 ' all become '105'; any other text is kept trimmed.

    Digits are never read as a number, so '007', '1e3' and ids of any length stay what they are.
    A double is written as a whole number when it is one.
    """
    text = strip(c.cast("string"))
    whole = F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")
    # a large double prints with an exponent; typeof is a constant that the optimizer folds
    number = F.when(F.typeof(c).isin("double", "float"), c.try_cast("double"))
    exact = F.when(number == number.try_cast("bigint"), number.try_cast("bigint").cast("string"))
    return F.coalesce(exact, F.nullif(whole, F.lit("")))


def make_curve_id(*parts: Column | str, sep: str = "-") -> Column:
    """Join key parts (a str is a column name); any NULL part makes the key NULL."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces: list[Column] = []
    for i, part in enumerate(columns):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def family_of(building_type: Column) -> Column:
    return F.substr(building_type, F.lit(1), F.lit(4))


def stories_of(building_type: Column) -> Column:
    return F.right(building_type, F.lit(1))


def terrain_of(curve_id: Column, pattern: str = "t([0-9]+)$") -> Column:
    return F.regexp_extract(curve_id, pattern, 1)


def printed_label(text: Column, pattern: str) -> Column:
    """Label printed in the page header, which is the first 600 characters by definition."""
    return F.nullif(F.regexp_extract(F.substr(text, F.lit(1), F.lit(600)), pattern, 1), F.lit(""))
