"""Text staging tables: scan, then rename headers with blanks and dots to plain names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.schema import ORDER_HEADERS, TERRITORY_HEADERS


def rename(raw: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """Keep the columns named in ``headers``, under their new names."""
    return raw.select(*[F.col(f"`{old}`").alias(new) for old, new in headers.items()])


def _scan(spark: SparkSession, path: str, kind: str, headers: Mapping[str, str]) -> DataFrame:
    """The columns named in ``headers`` as text, wherever they stand in the file; others are not read."""
    raw = spark.read.option("header", True).format(kind).load(path)
    missing = [name for name in headers if name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    other = [f.name for f in raw.schema if f.name in headers and f.dataType != T.StringType()]
    if other:
        raise ValueError(f"{path} holds no text in the columns {', '.join(other)}")
    return raw


def _named(raw: DataFrame, kind: str, headers: Mapping[str, str]) -> DataFrame:
    named = rename(raw, headers)
    # Blank fields are empty text in these tables, where the CSV reader gives NULL.
    return named.fillna("") if kind == "csv" else named


def read_orders(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Order staging, all text."""
    return _named(_scan(spark, path, kind, ORDER_HEADERS), kind, ORDER_HEADERS)


def read_territories(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """Store-by-territory staging, all text."""
    return _named(_scan(spark, path, kind, TERRITORY_HEADERS), kind, TERRITORY_HEADERS)
