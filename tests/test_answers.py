from decimal import Decimal

import pytest

from starloom.plans import answers
from tests.small import category, order, star, store

D = Decimal


def rows(df):
    return [tuple(None if v is None else float(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()]


@pytest.fixture(scope="module")
def shop(spark):
    stores = [store(1, "Grande", "Ouro", 1000), store(2, "Media", "Prata", 0), store(3, "Grande", "Ouro", 4000)]
    categories = [category(1, "Racao"), category(2, "Racao", "racao"), category(3, "Higiene")]
    orders = [
        order(1, 1, 1, "100.00", 2, (2, 1, 4, 2, 9)),
        order(2, 1, 2, "50.01", 1, (3, 0, 5, None, None), "Nao"),
        order(3, 3, 3, "150.01", None, (None, None, None, None, None), "Nao", "Site"),
        order(4, 2, 3, None, 4, (1, 1, 1, 1, 4), "Sim", "Site"),
        order(5, 2, 1, "10.00", 4, (2, 2, 2, 2, 8), "Nao Informado", "Site"),
        order(6, -1, -1, "39.98", 1, (2,), "Nao", "App"),
    ]
    territories = [
        {"sk_praca": 1, "cod_praca": "A", "nome_praca": "A", "domicilios_com_pet": 100},
        {"sk_praca": 2, "cod_praca": "B", "nome_praca": "B", "domicilios_com_pet": 0},
    ]
    bridge = [
        {"cod_loja": "LJ-1", "sk_praca": 1, "fator_publico": D("0.8500")},
        {"cod_loja": "LJ-1", "sk_praca": 2, "fator_publico": D("0.1500")},
        {"cod_loja": "LJ-2", "sk_praca": 1, "fator_publico": D("1.0000")},
        {"cod_loja": "LJ-3", "sk_praca": 2, "fator_publico": D("1.0000")},
    ]
    return star(spark, orders, stores, categories, territories, bridge)


def test_lags_overall(shop):
    # Every mean over the orders that have both ends; the total is no sum of the steps.
    assert rows(answers.lags_overall(shop)) == [(2.0, 1.0, 3.0, 1.67, 7.0)]


def test_step_ranking(shop):
    assert rows(answers.step_ranking(shop)) == [
        ("Nota -> Despacho", 3.0),
        ("Integracao -> Separacao", 2.0),
        ("Despacho -> Entrega", 1.67),
        ("Separacao -> Nota", 1.0),
    ]


def test_lags_by_size(shop):
    assert rows(answers.lags_by_size(shop)) == [
        ("Grande", 3, 2.5, 0.5, 4.5, 2.0, 9.0),
        ("Media", 2, 1.5, 1.5, 1.5, 1.5, 6.0),
    ]
    assert rows(answers.steps_by_size(shop)) == [("Grande", 2.5, 0.5, 4.5, 2.0), ("Media", 1.5, 1.5, 1.5, 1.5)]
    assert rows(answers.bottleneck_by_size(shop)) == [
        ("Grande", "nota_despacho", 4.5),
        ("Media", "integracao_separacao", 1.5),
    ]


def test_category_revenue_counts_unknown_stores(shop):
    assert rows(answers.revenue_by_category(shop)) == [
        ("Racao", 160.01, 45.72),
        ("Higiene", 150.01, 42.86),
        ("Nao Informado", 39.98, 11.42),
    ]


def test_category_by_size_leaves_unknown_stores_out(shop):
    found = rows(answers.category_by_size(shop))
    assert sorted(found[:2]) == [("Grande", "Higiene", 150.01, 50.0), ("Grande", "Racao", 150.01, 50.0)]
    # A category without any value comes first.
    assert found[2:] == [("Media", "Higiene", None, None), ("Media", "Racao", 10.0, 100.0)]


def test_champions_keep_ties_and_no_missing_value_wins(shop):
    assert sorted(rows(answers.champion_by_size(shop))) == [
        ("Grande", "Higiene", 150.01),
        ("Grande", "Racao", 150.01),
        ("Media", "Racao", 10.0),
    ]


def test_total_covers_orders_without_a_category_row(spark):
    lost = star(
        spark,
        [order(1, 1, 1, "60.00"), order(2, 1, 99, "40.00")],
        [store(1, "Grande")],
        [category(1, "Racao")],
    )
    assert rows(answers.revenue_by_category(lost)) == [("Racao", 60.0, 60.0)]
    assert rows(answers.category_by_size(lost)) == [("Grande", "Racao", 60.0, 60.0)]


def test_tickets(shop):
    assert rows(answers.ticket_by_channel(shop)) == [("App", 100.0, 45.0, 1, 2), ("Site", None, 150.01, 1, 1)]
    assert rows(answers.ticket_gap(shop)) == [
        ("App", 100.0, 45.0, 55.01, 122.25),  # 44.995 is shown as 45.00, the gap is 55.005
        ("Site", None, 150.01, None, None),
    ]


def test_gap_is_rounded_once(spark):
    # Means 0.125 and 0.005 round to 0.13 and 0.01; their difference of 0.12 does not show as such.
    orders = [order(i, 1, 1, "0.12") for i in (1, 2, 3)] + [order(4, 1, 1, "0.14")]
    orders += [order(5, 1, 1, "0.00", discount="Nao"), order(6, 1, 1, "0.01", discount="Nao")]
    shop = star(spark, orders, [store(1, "Grande")], [category(1, "Racao")])
    assert rows(answers.ticket_gap(shop)) == [("App", 0.13, 0.01, 0.12, 2400.0)]


def test_change_against_a_zero_mean_is_missing(spark):
    orders = [order(1, 1, 1, "5.00"), order(2, 1, 1, "0.00", discount="Nao")]
    shop = star(spark, orders, [store(1, "Grande")], [category(1, "Racao")])
    assert rows(answers.ticket_gap(shop)) == [("App", 5.0, 0.0, 5.0, None)]


def test_channel_share(shop):
    assert rows(answers.channel_share(shop)) == [("App", 3, 189.99, 54.28), ("Site", 3, 160.01, 45.72)]
    assert rows(answers.channel_summary(shop)) == [
        ("App", 3, 100.0, 45.0, 55.01, 189.99, 54.28),
        ("Site", 3, None, 150.01, None, 160.01, 45.72),
    ]


def test_stores_and_territories(shop):
    found = rows(answers.store_revenue(shop))
    assert sorted(found) == [("Loja 1", 150.01), ("Loja 2", 10.0), ("Loja 3", 150.01)]
    assert rows(answers.allocated_revenue(shop)) == [("B", 172.51), ("A", 137.51)]
    assert rows(answers.revenue_per_household(shop)) == [("B", 0, 172.51, None), ("A", 100, 137.51, 1.38)]


def test_reconciliation_adds_up(shop):
    assert rows(answers.reconciliation(shop)) == [(350.0, 310.02, 39.98, 0.0)]


def test_reconciliation_without_unknown_stores(spark):
    shop = star(
        spark,
        [order(1, 1, 1, "60.00")],
        [store(1, "Grande")],
        [category(1, "Racao")],
        [{"sk_praca": 1, "nome_praca": "A"}],
        [{"cod_loja": "LJ-1", "sk_praca": 1, "fator_publico": D("1.0000")}],
    )
    assert rows(answers.reconciliation(shop)) == [(60.0, 60.0, None, 0.0)]


def test_items(shop):
    found = rows(answers.items_per_thousand(shop))
    # No inhabitants and no items both give no figure, which sorts first.
    assert sorted(found[:2]) == [
        ("Loja 2", "Cidade 2", "Media", 0, 8, None, 6.0),
        ("Loja 3", "Cidade 3", "Grande", 4000, None, None, None),
    ]
    assert found[2:] == [("Loja 1", "Cidade 1", "Grande", 1000, 3, 3.0, 9.0)]
    assert [r[0] for r in rows(answers.top_items_per_thousand(shop, 2))] == ["Loja 1"]


def test_tier_share_is_of_all_revenue(shop):
    assert rows(answers.tier_share(shop)) == [("Ouro", 3, 300.02, 85.72), ("Prata", 2, 10.0, 2.86)]


def test_quality(shop):
    assert rows(answers.quality_impact(shop)) == [(6, 1, 3, 1, 1)]
    assert sorted(rows(answers.quality_percentages(shop))) == [
        ("entregas_nao_concluidas", 3, 50.0),
        ("pedidos_com_itens_em_branco", 1, 16.67),
        ("pedidos_com_valor_em_branco", 1, 16.67),
        ("pedidos_sem_loja", 1, 16.67),
    ]


def test_drill_down_by_other_attributes(shop):
    assert rows(answers.lags_by_size(shop, by="faixa_franquia"))[0][:2] == ("Ouro", 3)
    assert {r[0] for r in rows(answers.category_by_size(shop, within="cidade"))} == {
        "Cidade 1",
        "Cidade 2",
        "Cidade 3",
    }


def test_answers_on_an_empty_fact(spark):
    empty = star(spark, [], [store(1, "Grande")], [category(1, "Racao")])
    assert rows(answers.lags_overall(empty)) == [(None,) * 5]
    assert rows(answers.quality_impact(empty)) == [(0, None, None, None, None)]
    assert rows(answers.revenue_by_category(empty)) == []
