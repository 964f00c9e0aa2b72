"""Why a text could not be read.

Each function takes the raw text and what a lenient parser made of it, and gives the rule that the text
breaks: NULL if there is a value, or if the text stands for none.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.numbers import NO_NUMBER, money_text
from starloom.functions.text import blank_to_null

# Rules, as they stand in the table of rejects.
NO_US_TIMESTAMP = "fora da mascara americana"
NO_ISO_DATE = "fora do formato ISO"
NO_SUCH_DAY = "dia ou hora inexistente"
NO_INTEGER = "nao e inteiro"
NO_DECIMAL = "nao e numero"
OUT_OF_RANGE = "numero fora da faixa"

_US_SHAPE = r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2} [AaPp][Mm]\z"
_ISO_SHAPE = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?\z"
_INTEGER_SHAPE = r"\A[+-]?[0-9]+\z"
_DECIMAL_SHAPE = r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def _rule(value: Column, text: Column, shape: str, fits: str, other: str) -> Column:
    """``fits`` for a text of the right shape, ``other`` for any other; ``text`` is NULL where it stands for nothing."""
    named = F.when(text.rlike(shape), F.lit(fits)).otherwise(F.lit(other))
    return F.when(value.isNull() & text.isNotNull(), named)


def timestamp_rule(raw: Column, value: Column) -> Column:
    return _rule(value, blank_to_null(raw), _US_SHAPE, NO_SUCH_DAY, NO_US_TIMESTAMP)


def date_rule(raw: Column, value: Column) -> Column:
    return _rule(value, blank_to_null(raw), _ISO_SHAPE, NO_SUCH_DAY, NO_ISO_DATE)


def integer_rule(raw: Column, value: Column) -> Column:
    text = F.trim(raw)
    return _rule(value, F.when(~text.isin(*NO_NUMBER), text), _INTEGER_SHAPE, OUT_OF_RANGE, NO_INTEGER)


def money_rule(raw: Column, value: Column) -> Column:
    return _rule(value, money_text(raw), _DECIMAL_SHAPE, OUT_OF_RANGE, NO_DECIMAL)


def thousands_rule(raw: Column, value: Column) -> Column:
    return _rule(value, F.replace(raw, F.lit("."), F.lit("")), _INTEGER_SHAPE, OUT_OF_RANGE, NO_INTEGER)


def factor_rule(raw: Column, value: Column) -> Column:
    return _rule(value, F.replace(raw, F.lit(","), F.lit(".")), _DECIMAL_SHAPE, OUT_OF_RANGE, NO_DECIMAL)


def rejects(rules: Mapping[str, tuple[Column, Column]]) -> Column:
    """The (coluna, texto, regra) of every broken rule of a row, NULL if there is none.

    ``rules`` has a raw text and its rule per column name. The list is only made for rows that need it.
    """
    broken = reduce(Column.__or__, [rule.isNotNull() for _, rule in rules.values()])
    each = [
        F.struct(F.lit(name).alias("coluna"), raw.alias("texto"), rule.alias("regra")) for name, (raw, rule) in rules.items()
    ]
    return F.when(broken, F.filter(F.array(*each), lambda r: r["regra"].isNotNull()))
