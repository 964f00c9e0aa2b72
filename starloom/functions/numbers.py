"""Number parsers, size bands and exact ratios. Every function gives a Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schema import FACTOR, MONEY

# Texts that stand for "no number".
NO_NUMBER = ["", "-"]
# Fixed value: digits grouped by dots in threes and nothing else, such as 1.200. Ends
# in \z, as $ would also match before a final line feed.
DOT_THOUSANDS = r"^[0-9]{1,3}(\.[0-9]{3})+\z"


def _cast(col: Column, kind: T.DataType, strict: bool) -> Column:
    return col.cast(kind) if strict else col.try_cast(kind)


def _without(col: Column, text: str) -> Column:
    return F.replace(col, F.lit(text), F.lit(""))


def money_text(col: Column) -> Column:
    """Rewrite money text so that a cast can read it; "no number" becomes NULL.

    A comma marks the decimals and makes dots thousands separators. Without a
    comma, dots in groups of three are thousands separators, else a decimal point.
    """
    bare = _without(col, "R$")
    packed = _without(bare, " ")
    return (
        F.when(F.trim(bare).isin(*NO_NUMBER), F.lit(None).cast("string"))
        .when(F.contains(packed, F.lit(",")), F.replace(_without(packed, "."), F.lit(","), F.lit(".")))
        .when(packed.rlike(DOT_THOUSANDS), _without(packed, "."))
        .otherwise(packed)
    )


def parse_money_br(col: Column, strict: bool = True) -> Column:
    """Mixed Brazilian and plain money text as DECIMAL(15,2).

    ``strict`` raises on text that is no number (under ANSI mode); otherwise NULL.
    """
    return _cast(money_text(col), MONEY, strict)


def parse_int(col: Column, nulls: Sequence[str] = NO_NUMBER, strict: bool = True) -> Column:
    """Whole number; texts in ``nulls`` become NULL."""
    text = F.trim(col)
    return F.when(~text.isin(*nulls), _cast(text, T.IntegerType(), strict))


def parse_thousands_int(col: Column, strict: bool = True) -> Column:
    """``148.000`` as 148000."""
    return _cast(_without(col, "."), T.IntegerType(), strict)


def parse_factor(col: Column, strict: bool = True) -> Column:
    """``0,85`` as DECIMAL(6,4)."""
    return _cast(F.replace(col, F.lit(","), F.lit(".")), FACTOR, strict)


def size_band(
    area: Column,
    low: int = 150,
    high: int = 400,
    labels: Sequence[str] = ("Pequena", "Media", "Grande"),
) -> Column:
    """Band of a sales area; both bounds belong to the middle band, NULL stays NULL."""
    small, middle, large = labels
    return (
        F.when(area < low, F.lit(small)).when(area <= high, F.lit(middle)).when(area > high, F.lit(large))
    )


def rounded_ratio(
    top: str, bottom: str, digits: int = 2, scale: int = 2, bottom_scale: int = 0, times: int = 1
) -> Column:
    """``times * top / bottom`` rounded once, half away from zero; NULL for a zero bottom.

    ``top`` and ``bottom`` are SQL expressions that carry ``scale`` and ``bottom_scale``
    decimal places. The quotient is formed on whole numbers, so no intermediate rounding
    can tip a tie.
    """

    def whole(value: str, places: int) -> str:
        return f"abs(cast(({value}) * {10**places} as decimal(38,0)))"

    upper = f"{whole(top, scale)} * {times * 10**bottom_scale}"
    lower = f"nullif({whole(bottom, bottom_scale)} * {10**scale}, 0)"
    units = f"({upper} * {2 * 10**digits} + {lower}) div ({lower} * 2)"
    signed = f"if((({top}) < 0) <> (({bottom}) < 0), -1, 1) * ({units})"
    return F.expr(f"cast(cast({signed} as decimal(20,0)) / {10**digits} as decimal(20,{digits}))")
