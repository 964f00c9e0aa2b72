import csv
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.plans.load import Staging, load_star, read_star
from starloom.schema import LAGS, ORDER_HEADERS, STAR, TERRITORY_HEADERS
from starloom.sources.staging import read_orders, read_territories
from starloom.sources.warehouse import new_folder

# number, ordered, integrated, picked, invoiced, dispatched, delivered, store, code, category,
# discount, channel, items, value
ORDERS = [
    ("P1", "09/01/2023 10:07 AM", "09/02/2023 01:00 PM", "2023-09-04", "2023-09-05", "2023-09-08",
     "2023-09-10", "Loja Centro/SC", "LJ-1", "Ração", "S", "WhatsApp", "3", "R$ 1.850,00"),
    ("P2", "09/30/2023 11:59 PM", "09/30/2023 11:59 PM", "2023-10-01", "", "", "", "LOJA  CENTRO", "",
     "Ração Medicamentosa", "Não", "app", "-", "1.200"),
    ("P3", "12/31/2023 12:00 AM", "", "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-05",
     "Loja Centr", "", "Nao Informado", "N", "", "", ""),
    ("P4", "01/15/2024 01:30 PM", "01/16/2024 01:30 PM", "", "", "", "", "", "", "???", "", "Site", " 7 ", "769"),
]
TERRITORIES = [
    ("LJ-1", "PR-1", "Vale", "Norte", "148.000", "0,85"),
    ("LJ-1", "PR-2", "Serra", "Sul", "74.000", "0,15"),
]


def stores(spark):
    row = (1, "LJ-1", "LOJA CENTRO", "Loja Centro", "Cidade", "SC", "Vale", 1000, 200, "Media", "Ouro", "Padrao")
    return spark.createDataFrame([row], STAR["dim_loja"])


def aliases(spark):
    return spark.createDataFrame([("LOJA CENTR", "LOJA CENTRO")], "apelido string, chave_loja string")


def text_table(spark, rows, headers):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers))


@pytest.fixture(scope="module")
def loaded(spark):
    folder = new_folder(spark, "small")
    text_table(spark, ORDERS, ORDER_HEADERS).coalesce(1).write.parquet(f"{folder}/orders")
    text_table(spark, TERRITORIES, TERRITORY_HEADERS).write.parquet(f"{folder}/territories")
    staging = Staging(
        read_orders(spark, f"{folder}/orders"),
        read_territories(spark, f"{folder}/territories"),
        stores(spark),
        aliases(spark),
    )
    return load_star(spark, staging, f"{folder}/star", by_place=True), f"{folder}/star"


def test_types(loaded):
    star, _ = loaded
    for name, schema in STAR.items():
        assert [(f.name, f.dataType) for f in getattr(star, name).schema] == [(f.name, f.dataType) for f in schema]


def test_fact(loaded):
    star, _ = loaded
    rows = {r["numero_pedido"]: r.asDict() for r in star.fato_pedido.collect()}
    names = {r["sk_categoria"]: r["nome_categoria"] for r in star.dim_categoria.collect()}
    assert sorted(r["sk_pedido"] for r in rows.values()) == [1, 2, 3, 4]

    first = rows["P1"]
    assert [first[lag] for lag in LAGS] == [2, 1, 3, 2, 8]
    assert (first["sk_tempo_pedido"], first["sk_tempo_entrega"]) == (20230901, 20230910)
    assert first["dt_pedido"] == dt.datetime(2023, 9, 1, 10, 7)
    assert (first["sk_loja"], names[first["sk_categoria"]]) == (1, "Racao")
    assert (first["houve_desconto"], first["canal_pedido"]) == ("Sim", "WhatsApp")
    assert (first["qt_itens"], first["vl_liquido"]) == (3, Decimal("1850.00"))

    second = rows["P2"]
    assert [second[lag] for lag in LAGS] == [1, None, None, None, None]
    assert (second["sk_tempo_entrega"], second["sk_loja"]) == (-1, 1)
    assert names[second["sk_categoria"]] == "Medicamento"
    assert second["houve_desconto"] == "Nao Informado"
    assert (second["qt_itens"], second["vl_liquido"]) == (None, Decimal("1200.00"))

    third = rows["P3"]
    # No integration time: the first lag and the total are missing, the others stand.
    assert [third[lag] for lag in LAGS] == [None, 0, 1, 2, None]
    assert third["sk_loja"] == 1  # through the alias
    assert third["sk_categoria"] != -1 and names[third["sk_categoria"]] == "Nao Informado"
    assert third["canal_pedido"] == "Nao Informado"
    assert third["vl_liquido"] is None

    fourth = rows["P4"]
    assert fourth["sk_loja"] == -1
    assert (fourth["qt_itens"], fourth["vl_liquido"]) == (7, Decimal("769.00"))


def test_dimensions(loaded):
    star, _ = loaded
    days = star.dim_tempo.agg(F.count("*"), F.min("data"), F.max("data")).first()
    assert tuple(days) == (138, dt.date(2023, 9, 1), dt.date(2024, 1, 15))
    assert star.bridge_loja_praca.agg(F.sum("fator_publico")).first()[0] == Decimal("1.0000")
    assert star.dim_praca.count() == 3


def test_reload_overwrites_and_reads_back(spark, loaded):
    star, folder = loaded
    again = read_star(spark, folder)
    for name in STAR:
        assert getattr(again, name).exceptAll(getattr(star, name)).isEmpty()


def test_views(spark, loaded):
    star, _ = loaded
    star.register()
    rows = spark.sql(
        "SELECT l.porte, count(*) AS n FROM fato_pedido f JOIN dim_loja l ON l.sk_loja = f.sk_loja"
        " WHERE f.sk_loja <> -1 GROUP BY l.porte"
    ).collect()
    assert [tuple(r) for r in rows] == [("Media", 3)]


def test_csv_staging_without_keys_is_numbered_as_written(spark, tmp_path):
    path = tmp_path / "orders.csv"
    with path.open("w", newline="", encoding="utf-8") as file:
        csv.writer(file).writerows([list(ORDER_HEADERS), *ORDERS])
    orders = read_orders(spark, str(path), "csv")
    assert sorted(map(tuple, orders.collect())) == sorted(ORDERS)
    territories = text_table(spark, TERRITORIES, TERRITORY_HEADERS).toDF(*TERRITORY_HEADERS.values())
    star = load_star(spark, Staging(orders, territories, stores(spark)))
    keys = {r["numero_pedido"]: (r["sk_pedido"], r["sk_loja"]) for r in star.fato_pedido.collect()}
    assert sorted(k for k, _ in keys.values()) == [1, 2, 3, 4]
    assert keys["P3"][1] == -1  # no aliases given


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "turned.csv"
    headers = list(ORDER_HEADERS)
    with path.open("w", newline="", encoding="utf-8") as file:
        csv.writer(file).writerows([["extra", *headers[::-1]], *[["x", *row[::-1]] for row in ORDERS]])
    orders = read_orders(spark, str(path), "csv")
    assert sorted(map(tuple, orders.collect())) == sorted(ORDERS)


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_missing_columns_are_named(spark, tmp_path, kind):
    text_table(spark, ORDERS, ORDER_HEADERS).toDF(*ORDER_HEADERS).drop("DtNotaFiscal").write.option(
        "header", True
    ).format(kind).save(str(tmp_path / kind))
    with pytest.raises(ValueError, match="DtNotaFiscal"):
        read_orders(spark, str(tmp_path / kind), kind)


def test_repeated_lookup_keys_stop_a_load(spark):
    orders = text_table(spark, ORDERS, ORDER_HEADERS).toDF(*ORDER_HEADERS.values())
    territories = text_table(spark, TERRITORIES, TERRITORY_HEADERS).toDF(*TERRITORY_HEADERS.values())
    twice = stores(spark).union(stores(spark))
    with pytest.raises(ValueError, match="loja_chave.chave_loja"):
        load_star(spark, Staging(orders, territories, twice, aliases(spark)))
    other = territories.union(territories.limit(1).withColumn("nome_praca", F.lit("Outra")))
    with pytest.raises(ValueError, match="dim_praca.cod_praca"):
        load_star(spark, Staging(orders, other, stores(spark), aliases(spark)))
    doubled = aliases(spark).union(aliases(spark))
    assert load_star(spark, Staging(orders, territories, stores(spark), doubled)).fato_pedido.count() == len(ORDERS)


def test_given_calendar_and_lenient_territories(spark):
    orders = text_table(spark, ORDERS, ORDER_HEADERS).toDF(*ORDER_HEADERS.values())
    territories = text_table(spark, TERRITORIES, TERRITORY_HEADERS).toDF(*TERRITORY_HEADERS.values())
    bad = territories.withColumn("percentual_publico", F.lit("muito"))
    staging = Staging(orders, bad, stores(spark), aliases(spark))
    days = (dt.date(2023, 9, 1), dt.date(2023, 9, 30))
    star = load_star(spark, staging, strict=False, days=days)
    assert star.dim_tempo.count() == 31
    assert star.bridge_loja_praca.where("fator_publico is not null").isEmpty()


def test_unreadable_text_stops_a_strict_load_only(spark):
    bad = list(ORDERS[0])
    bad[1], bad[3], bad[12], bad[13] = "25/12/2023 10:00 AM", "soon", "some", "much"
    names = list(ORDER_HEADERS.values())
    orders = text_table(spark, [ORDERS[1], tuple(bad)], ORDER_HEADERS).toDF(*names)
    territories = text_table(spark, TERRITORIES, TERRITORY_HEADERS).toDF(*TERRITORY_HEADERS.values())
    staging = Staging(orders, territories, stores(spark), aliases(spark))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|parse|CAST_INVALID_INPUT"):
        load_star(spark, staging)
    star = load_star(spark, staging, strict=False)
    row = star.fato_pedido.where("numero_pedido = 'P1'").first()
    assert (row["dt_pedido"], row["sk_tempo_pedido"], row["qt_itens"], row["vl_liquido"]) == (None, -1, None, None)
    assert [row[lag] for lag in LAGS] == [None, None, 3, 2, 8]
    assert star.fato_pedido.count() == 2


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from starloom.sources import warehouse

    class Context:
        master = "spark://somewhere:7077"
        applicationId = "app"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        warehouse.shared_folder(Session())
