"""Texts that cannot be read: the rule each breaks, and the table a lenient load writes."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from registry import derived
from registry.queries import staging
from starloom.functions import rejects as r
from starloom.functions.dates import parse_date, parse_us_timestamp
from starloom.functions.numbers import parse_factor, parse_int, parse_money_br, parse_thousands_int
from starloom.plans.load import clean_orders, load_star, read_rejects, read_star
from starloom.schema import STAR
from starloom.sources.warehouse import new_folder

READERS = {
    "timestamp": (r.timestamp_rule, lambda c: parse_us_timestamp(c, False)),
    "date": (r.date_rule, lambda c: parse_date(c, False)),
    "integer": (r.integer_rule, lambda c: parse_int(c, strict=False)),
    "money": (r.money_rule, lambda c: parse_money_br(c, False)),
    "thousands": (r.thousands_rule, lambda c: parse_thousands_int(c, False)),
    "factor": (r.factor_rule, lambda c: parse_factor(c, False)),
}
CASES = [
    ("timestamp", "9/1/2023 9:05 pm", None),
    ("timestamp", "  ", None),
    ("timestamp", None, None),
    ("timestamp", "13/01/2023 10:00 AM", r.NO_SUCH_DAY),
    ("timestamp", "02/30/2023 10:00 AM", r.NO_SUCH_DAY),
    ("timestamp", "2023-09-01 10:00", r.NO_US_TIMESTAMP),
    ("date", "2024-02-29", None),
    ("date", " 2024-3-1 23:59:59.5 ", None),
    ("date", "2023-02-29", r.NO_SUCH_DAY),
    ("date", "2024-03-01 99:99", r.NO_SUCH_DAY),
    ("date", "2024-03-01 24:00", r.NO_SUCH_DAY),
    ("date", "2024-03", r.NO_ISO_DATE),
    ("date", "2024-03-1T", r.NO_ISO_DATE),
    ("date", "20240301", r.NO_ISO_DATE),
    ("integer", " 7 ", None),
    ("integer", "-", None),
    ("integer", "7.5", r.NO_INTEGER),
    ("integer", "2147483648", r.OUT_OF_RANGE),
    ("money", "R$ 1.850,00", None),
    ("money", " - ", None),
    ("money", "a lot", r.NO_DECIMAL),
    ("money", "12345678901234,00", r.OUT_OF_RANGE),
    ("thousands", "148.000", None),
    ("thousands", "", r.NO_INTEGER),
    ("thousands", "9.999.999.999", r.OUT_OF_RANGE),
    ("factor", "0,85", None),
    ("factor", "85%", r.NO_DECIMAL),
    ("factor", "100,5", r.OUT_OF_RANGE),
]


@pytest.mark.parametrize("kind", READERS)
def test_rules(values, kind):
    rule, read = READERS[kind]
    inputs = [text for k, text, _ in CASES if k == kind]
    assert values(lambda c: rule(c, read(c)), inputs) == [wanted for k, _, wanted in CASES if k == kind]


def test_impossible_times_are_no_dates(values):
    texts = ["2024-03-01 99:99", "2024-03-01 25:00:00", "2024-03-01 10:60", "2024-03-01T23:59:59", "2024-03-01 9:05", "0002024-03", "+202-03-01"]
    found = values(lambda c: parse_date(c, False).cast("string"), texts)
    assert found == [None, None, None, "2024-03-01", "2024-03-01", None, None]


@pytest.mark.parametrize("text", ["2024-03-01 99:99", "2024-03-01 25:00:00"])
def test_impossible_times_stop_a_strict_reader(values, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(parse_date, [text])


def test_sound_rows_have_no_list(spark, sf_dir):
    cleaned = clean_orders(staging(spark, sf_dir).orders, strict=False)
    assert cleaned.where("rejeitos is not null").isEmpty()


@pytest.mark.parametrize("by_place", [True, False])
def test_a_lenient_load_writes_fact_and_rejects(spark, sf_dir, by_place):
    sound = staging(spark, sf_dir)
    path = f"{new_folder(spark, 'bad')}/orders"
    derived.with_faults(sound.orders).write.parquet(path)
    bad = sound.territories.withColumn("percentual_publico", F.when(F.col("cod_loja") == "LJ-001", "muito").otherwise(F.col("percentual_publico")))
    faulty = dataclasses.replace(sound, orders=spark.read.parquet(path), territories=bad)
    folder = new_folder(spark, "star")
    star = load_star(spark, faulty, folder, strict=False, by_place=by_place)
    assert star.fato_pedido.schema.names == STAR["fato_pedido"].names
    assert read_star(spark, folder).fato_pedido.count() == sound.orders.count()
    found = read_rejects(spark, folder)
    # Every column has its faults, and each is a missing value in the fact.
    assert {row.coluna for row in found.select("coluna").distinct().collect()} == {c for c, _, _ in derived.FAULTS}
    lost = found.where("coluna = 'valor_liquido_pedido'").select("numero_pedido")
    assert star.fato_pedido.join(lost, "numero_pedido").where("vl_liquido is not null").isEmpty()
    homes = read_rejects(spark, folder, "rejeito_praca").collect()
    assert {(row.cod_loja, row.coluna, row.texto, row.regra) for row in homes} == {("LJ-001", "percentual_publico", "muito", r.NO_DECIMAL)}


def test_rejects_read_no_order_again(spark, sf_dir):
    folder = new_folder(spark, "star")
    load_star(spark, staging(spark, sf_dir), folder, strict=False, by_place=True)
    plan = spark.read.parquet(f"{folder}/fato_pedido").where("rejeitos is not null").select("numero_pedido", F.inline("rejeitos"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(rejeitos)" in text and "vl_liquido" not in text
    assert read_rejects(spark, folder).isEmpty()
