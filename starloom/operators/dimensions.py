"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.functions.numbers import parse_thousands_int
from starloom.functions.text import category_group, category_key, standard_category
from starloom.operators.keys import dense_keys
from starloom.schema import STAR, UNKNOWN_KEY, UNKNOWN_LABEL, UNKNOWN_MEMBERS
from starloom.sources.warehouse import conform

# Month names, and weekday names from Sunday on.
MONTHS = [
    "Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
WEEKDAYS = ["Domingo", "Segunda", "Terca", "Quarta", "Quinta", "Sexta", "Sabado"]


def _pick(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), position)


def with_unknown(dim: DataFrame, table: str) -> DataFrame:
    """``dim`` in the types of ``table``, plus the row that missing references point to.

    A row with the unknown member's key that ``dim`` may hold already gives way to it.
    """
    schema = STAR[table]
    special = UNKNOWN_MEMBERS[table]
    key = schema[0].name
    values = [
        F.lit(UNKNOWN_KEY if f.name == key else special.get(f.name, UNKNOWN_LABEL))
        .cast(f.dataType)
        .alias(f.name)
        for f in schema
    ]
    rows = conform(dim, schema).where(F.coalesce(F.col(key) != UNKNOWN_KEY, F.lit(True)))
    return rows.unionByName(dim.sparkSession.range(1).select(*values))


def calendar(bounds: DataFrame, start: str = "inicio", end: str = "fim") -> DataFrame:
    """One row per day from ``start`` to ``end``, both taken from the one row of ``bounds``."""
    day = F.col("data")
    weekday = F.dayofweek(day)
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("data"))
    return days.select(
        date_key(day).alias("sk_tempo"),
        "data",
        F.year(day).alias("ano"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        F.substring(day.cast("string"), 1, 7).alias("ano_mes"),
        _pick(MONTHS, F.month(day)).alias("nome_mes"),
        F.quarter(day).alias("trimestre"),
        _pick(WEEKDAYS, weekday).alias("dia_semana"),
        F.when(weekday.isin(1, 7), F.lit("Sim")).otherwise(F.lit("Nao")).alias("fim_de_semana"),
    )


def category_rows(spellings: DataFrame, column: str = "categoria_produto") -> DataFrame:
    """One row per raw category spelling with its standard name and group, without a key.

    Spellings are made distinct first, so the rules run once per spelling and not
    once per order. A missing spelling joins nothing and gets no row.
    """
    distinct = (
        spellings.select(F.col(column).alias("categoria_origem")).where(F.col(column).isNotNull()).distinct()
    )
    keyed = distinct.withColumn("__key", category_key(F.col("categoria_origem")))
    return keyed.select(
        "categoria_origem",
        standard_category(F.col("__key"), UNKNOWN_LABEL).alias("nome_categoria"),
        category_group(F.col("__key"), UNKNOWN_LABEL).alias("grupo_categoria"),
    )


def category_dim(spellings: DataFrame, column: str = "categoria_produto") -> DataFrame:
    """The spellings of ``category_rows``, numbered."""
    return dense_keys(category_rows(spellings, column), "categoria_origem", "sk_categoria")


def territory_rows(territories: DataFrame, strict: bool = True) -> DataFrame:
    """One row per distinct territory of the store-by-territory staging, without a key."""
    return territories.select(
        "cod_praca",
        "nome_praca",
        "regional",
        parse_thousands_int(F.col("domicilios_com_pet"), strict).alias("domicilios_com_pet"),
    ).distinct()


def territory_dim(territories: DataFrame, strict: bool = True) -> DataFrame:
    """The territories of ``territory_rows``, numbered."""
    return dense_keys(territory_rows(territories, strict), "cod_praca", "sk_praca")
