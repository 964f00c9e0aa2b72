import dataclasses
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.plans import checks
from starloom.plans.load import Staging
from starloom.schema import ORDER_HEADERS
from tests.small import category, order, star, store

D = Decimal
TEXT = ", ".join(f"{name} string" for name in ORDER_HEADERS.values())


def staged(number, **given):
    row = dict.fromkeys(ORDER_HEADERS.values(), "")
    row |= {"numero_pedido": f"P{number}", "dt_hora_pedido": "01/01/2024 10:00 AM", "loja_nome": "x"} | given
    return tuple(row[name] for name in ORDER_HEADERS.values())


def sound(spark):
    """Staging and star that agree with each other."""
    stores = [store(1, "Grande"), store(2, "Media")]
    categories = [category(1, "Racao", "RACAO"), category(2, "Medicamento", "Racao Medicamentosa")]
    territories = [{"sk_praca": 1, "cod_praca": "A", "nome_praca": "A", "domicilios_com_pet": 10}]
    bridge = [
        {"cod_loja": "LJ-1", "sk_praca": 1, "fator_publico": D("1.0000")},
        {"cod_loja": "LJ-2", "sk_praca": 1, "fator_publico": D("1.0000")},
    ]
    orders = [
        order(1, 1, 1, "10.00", 1, (1, 1, 1, 1, 4), channel="WhatsApp"),
        order(2, 2, 2, "20.00", 1),
        order(3, -1, -1, "5.00", 1),
    ]
    rows = [
        staged(1, dt_separacao_estoque="2024-01-01", categoria_produto="RACAO"),
        staged(2, dt_separacao_estoque="  ", categoria_produto="Racao Medicamentosa", loja_nome=""),
        staged(3, categoria_produto="RACAO", cod_loja="LJ-1"),
    ]
    loaded = star(spark, orders, stores, categories, territories, bridge)
    fact = loaded.fato_pedido.withColumn("dt_pedido", F.expr("timestamp_ntz'2024-01-01 10:00:00'"))
    loaded = dataclasses.replace(loaded, fato_pedido=fact)
    staging = Staging(spark.createDataFrame(rows, TEXT), bridge_frame(spark, 2), known_stores(loaded))
    return staging, loaded


def bridge_frame(spark, n):
    return spark.range(n).selectExpr("cast(id as string) cod_loja")


def known_stores(loaded):
    return loaded.dim_loja.where("sk_loja <> -1")


def failed(df):
    return {r["teste"] for r in df.collect() if r["ok"] is False}


def test_sound_data_passes(spark):
    staging, loaded = sound(spark)
    found = checks.run(staging, loaded, {"stg_pedido": 3, "fato_pedido": 3, "grafias de categoria": 2})
    rows = {r["teste"]: r["valor"] for r in found.collect()}
    assert failed(found) == set()
    assert set(checks.ALWAYS_EXPECTED) <= set(rows)
    assert set(checks.CASE_EXPECTED) <= set(rows)
    assert rows["pedidos sem nome de loja"] == 1
    assert rows["pedidos sem codigo de loja"] == 2
    assert rows["dt_separacao_estoque"] == 1  # blanks only are no empty text
    assert rows["pedidos sem loja"] == 1
    assert rows["mascara americana"] == 3
    assert rows["primeiro pedido"] == rows["ultimo pedido"] == 20240101


def replaced(loaded, name, change):
    return dataclasses.replace(loaded, **{name: change(getattr(loaded, name))})


def set_where(condition, column, value):
    return lambda df: df.withColumn(
        column, F.when(F.expr(condition), F.expr(value).cast(df.schema[column].dataType)).otherwise(F.col(column))
    )


# Each fault and the checks it must trip, and no others.
FAULTS = {
    "orphan store": (
        "fato_pedido",
        set_where("sk_pedido = 1", "sk_loja", "99"),
        {"FK orfa (loja)", "rateio sem fechar"},
    ),
    "orphan category": (
        "fato_pedido",
        set_where("sk_pedido = 1", "sk_categoria", "99"),
        {"FK orfa (categoria)", "total perdido na juncao de categoria"},
    ),
    "order day outside the calendar": (
        "fato_pedido",
        set_where("sk_pedido = 1", "sk_tempo_pedido", "20300101"),
        {"FK orfa (tempo do pedido)"},
    ),
    "delivery day outside the calendar": (
        "fato_pedido",
        set_where("sk_pedido = 1", "sk_tempo_entrega", "20300101"),
        {"FK orfa (tempo da entrega)"},
    ),
    "negative lag": ("fato_pedido", set_where("sk_pedido = 1", "dias_separacao_nota", "-1"), {"dias negativos"}),
    "repeated order": (
        "fato_pedido",
        lambda df: df.union(df.where("sk_pedido = 1")),
        {
            "pedidos perdidos ou repetidos",
            "chave repetida em fato_pedido",
            "chave repetida em numero_pedido",
        },
    ),
    "lost order": ("fato_pedido", lambda df: df.where("sk_pedido <> 3"), {"pedidos perdidos ou repetidos"}),
    "unclassified spelling": (
        "dim_categoria",
        set_where("sk_categoria = 1", "nome_categoria", "'Nao Informado'"),
        {"grafias sem categoria"},
    ),
    "rules in the wrong order": (
        "dim_categoria",
        set_where("sk_categoria = 2", "nome_categoria", "'Racao'"),
        {"ordem das regras"},
    ),
    "no unknown territory": ("dim_praca", lambda df: df.where("sk_praca <> -1"), {"linha -1 de dim_praca"}),
    "weights short of one": (
        "bridge_loja_praca",
        set_where("cod_loja = 'LJ-1'", "fator_publico", "0.9"),
        {"lojas com fator diferente de 1", "rateio sem fechar"},
    ),
    "repeated bridge row": (
        "bridge_loja_praca",
        lambda df: df.union(df.where("cod_loja = 'LJ-2'")),
        {"chave repetida em bridge_loja_praca", "lojas com fator diferente de 1", "rateio sem fechar"},
    ),
    "order number too long": (
        "fato_pedido",
        set_where("sk_pedido = 1", "numero_pedido", "repeat('9', 21)"),
        {"texto longo em fato_pedido"},
    ),
    "spelling too long": (
        "dim_categoria",
        set_where("sk_categoria = 1", "categoria_origem", "repeat('ç', 51)"),
        {"texto longo em dim_categoria"},
    ),
    "repeated territory": (
        "dim_praca",
        lambda df: df.union(df.where("sk_praca = 1")),
        {"chave repetida em dim_praca", "chave natural repetida em dim_praca"},
    ),
    "repeated store name": (
        "loja_chave",
        lambda df: df.union(df.where("sk_loja = 1")),
        {"chave natural repetida em loja_chave"},
    ),
    "channel lost": (
        "fato_pedido",
        set_where("sk_pedido = 1", "canal_pedido", "'App'"),
        {"canal WhatsApp ausente"},
    ),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_each_fault_trips_its_checks(spark, fault):
    table, change, wanted = FAULTS[fault]
    staging, loaded = sound(spark)
    broken = replaced(loaded, table, change)
    assert failed(checks.run(staging, broken)) == wanted


def test_null_reference(spark):
    staging, loaded = sound(spark)
    broken = replaced(loaded, "fato_pedido", set_where("sk_pedido = 1", "sk_loja", "null"))
    rows = {r["teste"]: r["valor"] for r in checks.fk_integrity(broken).collect()}
    assert rows["FK nula"] == 1
    assert rows["FK orfa (loja)"] == 1


def test_must_be_empty_checks_give_the_rows(spark):
    _, loaded = sound(spark)
    assert checks.unclassified(loaded).isEmpty()
    assert checks.bridge_weights(loaded).isEmpty()
    broken = replaced(loaded, "dim_categoria", set_where("sk_categoria = 1", "nome_categoria", "'Nao Informado'"))
    assert [tuple(r) for r in checks.unclassified(broken).collect()] == [("RACAO", "Nao Informado")]
    broken = replaced(loaded, "bridge_loja_praca", set_where("cod_loja = 'LJ-1'", "fator_publico", "0.9"))
    assert [tuple(r) for r in checks.bridge_weights(broken).collect()] == [("LJ-1", D("0.9000"))]


def test_single_checks(spark):
    staging, loaded = sound(spark)
    assert [tuple(r) for r in checks.channel_present(loaded).collect()] == [("WhatsApp", 1)]
    assert [tuple(r) for r in checks.fact_grain(staging, loaded).collect()] == [("fato_pedido", 3, 3, True)]
    assert [float(v) for v in checks.allocation(loaded).first()] == [35.0, 30.0, 5.0, 0.0]
    assert [float(v) for v in checks.join_preserves_total(loaded).first()] == [35.0, 35.0]
    loose = checks.blank_milestones(staging, strict=False).collect()
    assert {r["teste"]: r["valor"] for r in loose}["dt_separacao_estoque"] == 2


def test_date_mask_expects_every_row(spark):
    rows = [staged(1), staged(2, dt_hora_pedido="25/12/2023 10:00 AM")]
    staging = Staging(spark.createDataFrame(rows, TEXT), None, None)
    assert [tuple(r) for r in checks.date_mask(staging).collect()] == [("mascara americana", 1, 2, False)]


def test_empty_targets(spark):
    """Before a load every target must be empty."""
    empty = {name: spark.createDataFrame([], "x int") for name in ["dim_categoria", "fato_pedido"]}
    found = checks.row_counts(empty, dict.fromkeys(empty, 0))
    assert [r["ok"] for r in found.collect()] == [True, True]


def test_money_audit(spark):
    rows = [staged(i, valor_liquido_pedido=v) for i, v in enumerate(["1,850.00", "-5", "abc", "R$ 1.850,00", "-", ""])]
    staging = Staging(spark.createDataFrame(rows, TEXT), None, None)
    assert [r["valor"] for r in checks.money_audit(staging).collect()] == [1, 1, 1]
