"""Metrics on a fact, formed in two steps.

``cells`` adds the fact up per foreign key or stored attribute: partial sums inside
each task, then one row per key, so a key that holds a third of all orders sends no
more rows than any other. Joins to dimensions, roll-ups, shares and ranks then run
on those few rows. Only sums and counts are kept, so cells can be added up again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.numbers import rounded_ratio
from starloom.schema import LAGS, UNKNOWN_KEY


@dataclass(frozen=True)
class Additive:
    """A sum or count over rows that also stands ready in a table of finer cells, as column ``ready``."""

    ready: str
    over_rows: Column

    def over(self, table: DataFrame) -> Column:
        if self.ready not in table.columns:
            return self.over_rows
        # In the type of the ready sum, which a sum of sums would widen.
        return F.sum(self.ready).cast(table.schema[self.ready].dataType)


def cells(fact: DataFrame, keys: Sequence[str], measures: Mapping[str, Column | Additive]) -> DataFrame:
    """Sums and counts per key; no key gives the one grand-total row.

    ``fact`` may itself be a table of finer cells: measures that are ``Additive`` are then added up from there.
    """
    over = lambda value: value.over(fact) if isinstance(value, Additive) else value
    return fact.groupBy(*keys).agg(*[over(value).alias(name) for name, value in measures.items()])


def roll_up(parts: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add cells up to a coarser key."""
    return parts.groupBy(*by).agg(*[F.sum(name).alias(name) for name in names])


def known(df: DataFrame, sk: str) -> DataFrame:
    """Rows whose reference was resolved."""
    return df.where(F.col(sk) != UNKNOWN_KEY)


def count_if(condition: Column) -> Column:
    """Rows that meet the condition; NULL, not zero, over no rows at all."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def lag_measures(lags: Sequence[str] = LAGS) -> dict[str, Additive]:
    """Sum and number of known values of every lag."""
    measures = {}
    for lag in lags:
        measures[f"sum_{lag}"] = Additive(f"sum_{lag}", F.sum(lag))
        measures[f"n_{lag}"] = Additive(f"n_{lag}", F.count(lag))
    return measures


def lag_mean(lag: str) -> Column:
    """Mean of a lag from its cells, to two places."""
    return rounded_ratio(f"sum_{lag}", f"n_{lag}", scale=0)


def share(part: str, whole: str) -> Column:
    """Money as a percentage of other money, to two places."""
    return rounded_ratio(part, whole, bottom_scale=2, times=100)


def total(name: str, within: Sequence[str] = ()) -> Column:
    """Total over all groups, or over those of one parent, beside every group.

    For rolled-up rows only, one per label, as those of a total meet in one task. Taken
    there, a total costs no second reading of the fact, which a subquery would.
    """
    return F.sum(name).over(Window.partitionBy(*within))


def under_label(
    parts: DataFrame,
    dim: DataFrame,
    sk: str,
    by: str,
    names: Sequence[str],
    unknown: bool,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Roll cells up to the label ``by`` of a dimension, with ``__listed`` telling which rows to show.

    Cells of no dimension row, and without ``unknown`` those of the -1 row, are kept as
    unlisted rows: totals taken over the result then cover the whole fact in its one pass.
    """
    listed = F.lit(True) if unknown else F.col(sk) != UNKNOWN_KEY
    labels = dim.select(sk, by, listed.alias("__listed"))
    return roll_up(parts.join(labels, sk, "left"), [*keep, by, "__listed"], names)


def champions(groups: DataFrame, within: Sequence[str], measure: str) -> DataFrame:
    """Of each parent group, the rows with the largest measure; ties stay, NULL never wins."""
    place = F.rank().over(Window.partitionBy(*within).orderBy(F.desc_nulls_last(measure)))
    ranked = groups.withColumn("__place", place)
    return ranked.where((F.col("__place") == 1) & F.col(measure).isNotNull()).drop("__place")


def per_unit(top: str, unit: str, scale: int, times: int = 1) -> Column:
    """``times * top / unit`` to two places; NULL for a unit of zero or NULL."""
    return rounded_ratio(top, unit, scale=scale, times=times)
