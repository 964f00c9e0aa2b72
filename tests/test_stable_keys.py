"""Keys that later loads keep."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.keys import stable_keys
from starloom.plans.load import Staging, load_star
from starloom.schema import ORDER_HEADERS, TERRITORY_HEADERS
from starloom.sources.warehouse import new_folder
from tests.test_load import ORDERS, TERRITORIES, stores, text_table

SCHEMA = T.StructType([T.StructField("sk", T.IntegerType()), T.StructField("n", T.StringType()), T.StructField("a", T.IntegerType())])


def loads(spark, *members):
    """The dimension after each load of (natural key, attribute) rows."""
    registry, found = new_folder(spark, "registry"), []
    for rows in members:
        df = spark.createDataFrame(rows, "n string, a int")
        found.append({r.n: (r.sk, r.a) for r in stable_keys(df, "n", SCHEMA, registry, "dim").collect()})
    return found


def test_keys_stay_and_new_ones_follow_without_gap(spark):
    one, two, three = loads(spark, [("b", 1), ("d", 2), (None, 3)], [(c, 9) for c in "abcde"], [("z", 0), ("d", 5)])
    assert sorted(sk for sk, _ in one.values()) == [1, 2, 3]
    assert all(two[c][0] == one[c][0] for c in one) and sorted(sk for sk, _ in two.values()) == [1, 2, 3, 4, 5, 6]
    # Attributes are the latest; a member not delivered has those it came with.
    assert two["b"][1] == 9 and two[None] == one[None]
    assert three["z"][0] == 7 and three["d"] == (one["d"][0], 5) and three["b"] == one["b"] and len(three) == 7


def test_nothing_new_appends_nothing(spark):
    one, two = loads(spark, [("a", 1), ("b", 1)], [("b", 1), ("a", 1)])
    assert one == two


def test_empty_loads(spark):
    one, two = loads(spark, [], [("a", 1)])
    assert (one, two) == ({}, {"a": (1, 1)})


def test_repeated_members_are_refused_before_they_are_kept(spark):
    registry = new_folder(spark, "registry")
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "n string, a int")
    with pytest.raises(ValueError, match="dim.n is not unique: 'a'"):
        stable_keys(twice, "n", SCHEMA, registry, "dim")
    once = twice.where("a = 1")
    assert [tuple(r) for r in stable_keys(once, "n", SCHEMA, registry, "dim").collect()] == [(1, "a", 1)]


def test_an_older_fact_still_finds_its_members(spark):
    orders = text_table(spark, ORDERS, ORDER_HEADERS).toDF(*ORDER_HEADERS.values())
    territories = text_table(spark, TERRITORIES, TERRITORY_HEADERS).toDF(*TERRITORY_HEADERS.values())
    registry = new_folder(spark, "registry")
    first = load_star(spark, Staging(orders.where("numero_pedido in ('P2', 'P4')"), territories.limit(1), stores(spark)), registry=registry)
    second = load_star(spark, Staging(orders.where("numero_pedido <> 'P4'"), territories, stores(spark)), registry=registry)
    spelled = lambda fact: {
        r.numero_pedido: r.categoria_origem for r in fact.join(second.dim_categoria, "sk_categoria").collect()
    }
    assert spelled(first.fato_pedido) == {"P2": "Ração Medicamentosa", "P4": "???"}
    assert spelled(second.fato_pedido)["P2"] == "Ração Medicamentosa"
    assert sorted(r[0] for r in second.dim_categoria.select("sk_categoria").collect()) == [-1, 1, 2, 3, 4]
    same = first.dim_praca.join(second.dim_praca, "cod_praca").where(first.dim_praca.sk_praca != second.dim_praca.sk_praca)
    assert same.isEmpty() and second.dim_praca.agg(F.max("sk_praca")).first()[0] == 2
