"""The fact in month folders: reads that skip months, and reloads of some months only.

Month folders cost one exchange of the fact when they are written: rows are rebalanced by month, so that a month becomes
a few files of the advised size, and a month with a third of all rows is split over tasks. The plain fact needs no exchange;
choose months where reads are bounded by date, or where late corrections reload a few months of many.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import parse_us_timestamp
from starloom.operators.keys import keys_from_places, task_offsets, written_place
from starloom.plans.load import Star, build_fact
from starloom.schema import MONTH, PLACE, STAR, UNKNOWN_CODE, UNKNOWN_KEY
from starloom.session import split_methods
from starloom.sources.warehouse import conform, settle

FACT = STAR["fato_pedido"]
MONTHLY = T.StructType([*FACT, MONTH])


def month_of(date_key: Column) -> Column:
    """``2024-03`` of the key 20240315, as in ``dim_tempo``; the unknown member's label of its key."""
    text = date_key.cast("string")
    month = F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2))
    return F.when(date_key == UNKNOWN_KEY, F.lit(UNKNOWN_CODE)).otherwise(month)


def _write(fact: DataFrame, path: str, overwrite: str) -> None:
    monthly = fact.withColumn(MONTH.name, month_of(F.col("sk_tempo_pedido")))
    spread = conform(monthly, MONTHLY).hint("rebalance", F.col(MONTH.name))
    spread.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(MONTH.name).parquet(path)


def write_months(fact: DataFrame, path: str) -> DataFrame:
    """Write the fact to one folder a month of the order below ``path`` and give it back as read from there.

    Replaces all that is there. Orders without a day are a month of their own.
    """
    _write(fact, path, "static")
    return read_months(fact.sparkSession, path)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The fact with its month ``ano_mes``, by which folders are skipped."""
    return spark.read.schema(MONTHLY).parquet(path).select(*MONTHLY.names)


def on_days(monthly: DataFrame, days: DataFrame) -> DataFrame:
    """The fact rows ordered on the given days of ``dim_tempo``, with the attributes of the day.

    Joined by month as well as by day, so that only the months of these days are read, whatever the days were picked by.
    """
    attributes = days.withColumnRenamed(MONTH.name, "__mes")
    same = (F.col("sk_tempo_pedido") == F.col("sk_tempo")) & (F.col(MONTH.name) == F.col("__mes"))
    return monthly.join(attributes, same).drop("__mes", "sk_tempo")


def _checked(month: str) -> str:
    if not re.fullmatch(r"[0-9]{4}-(0[1-9]|1[0-2])", month):
        raise ValueError(f"{month!r} is no month such as 2024-03")
    return month


def _first_day(month: str) -> dt.date:
    return dt.date(int(month[:4]), int(month[5:]), 1)


def reload_months(orders: DataFrame, star: Star, path: str, first: str, last: str, strict: bool = True) -> DataFrame:
    """Build the fact of the months ``first`` to ``last`` (``2024-03``, both included) anew and replace these months only.

    ``orders`` is the staging, or any part of it that holds all orders of these months. Dimensions are taken as they stand in
    ``star``; what they lack gets the unknown member, as in any load. Other months' files are not touched. The new rows'
    keys follow the largest key of the whole table, without a gap, so no key is given twice; the old rows' keys are gone. A month
    that has no orders any more is emptied. Months are replaced one by one: a reload that fails may be repeated, and then
    replaces all of them. Reloads of one table must not run side by side.
    """
    spark, first, last = orders.sparkSession, _checked(first), _checked(last)
    if last < first:
        raise ValueError(f"{first} is after {last}")
    day = F.to_date(parse_us_timestamp(F.col("dt_hora_pedido"), strict))
    end = F.add_months(F.lit(_first_day(last)), 1)
    some = build_fact(orders.where((day >= F.lit(_first_day(first))) & (day < end)), star.dim_categoria, star.loja_chave, strict)
    files = T.StructType([*[f for f in FACT if f.name != "sk_pedido"], PLACE])
    # Written apart first: keys are formed from places in this write, and the months are read for those they have.
    with split_methods(spark):
        written = settle(conform(some.withColumn(PLACE.name, written_place()), files), "months")
    old = read_months(spark, path)
    largest = old.agg(F.max("sk_pedido")).first()[0] or 0
    numbered = keys_from_places(written, task_offsets(written, PLACE.name), PLACE.name, "sk_pedido")
    new = numbered.withColumn("sk_pedido", F.col("sk_pedido") + F.lit(largest))
    before = old.where(F.col(MONTH.name).between(first, last)).select(MONTH.name).distinct()
    after = written.select(month_of(F.col("sk_tempo_pedido")).alias(MONTH.name)).distinct()
    gone = [r[0] for r in before.exceptAll(after).collect()]  # at most one a month
    _write(new, path, "dynamic")
    for month in gone:
        conform(written.limit(0).withColumn("sk_pedido", F.lit(0)), FACT).write.mode("overwrite").parquet(f"{path}/{MONTH.name}={month}")
    return read_months(spark, path)
