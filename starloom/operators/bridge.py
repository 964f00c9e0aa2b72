"""Weighted many-to-many bridge between stores and territories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import parse_factor


def build_bridge(territories: DataFrame, dim_praca: DataFrame, strict: bool = True) -> DataFrame:
    """One row per store code and territory with its share; unknown territory codes drop out."""
    codes = dim_praca.select("cod_praca", "sk_praca")
    return territories.join(codes, "cod_praca").select(
        "cod_loja", "sk_praca", parse_factor(F.col("percentual_publico"), strict).alias("fator_publico")
    )


def allocate(totals: DataFrame, bridge: DataFrame, measure: str, name: str) -> DataFrame:
    """Spread a per-store total over territories: ``sum(measure * fator_publico)`` by ``sk_praca``.

    ``totals`` holds one row per store code, so the many-to-many join meets no order rows.
    """
    weighted = totals.join(bridge, "cod_loja")
    return weighted.groupBy("sk_praca").agg(F.sum(F.col(measure) * F.col("fator_publico")).alias(name))
