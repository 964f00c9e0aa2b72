"""Facts numbered as they are read, and facts in month folders."""

import dataclasses
import datetime as dt
import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry.queries import monthly_star, staging, star, stg_orders_csv
from starloom.operators import keys
from starloom.plans import checks
from starloom.plans.load import load_star, read_star
from starloom.plans.months import month_of, on_days, read_months, reload_months, write_months
from starloom.schema import STAR
from starloom.sources.warehouse import new_folder, shared_folder


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def csv_folder(spark, sf_dir):
    folder = new_folder(spark, "csv_star")
    before = set(os.listdir(shared_folder(spark)))
    texts = dataclasses.replace(staging(spark, sf_dir), orders=stg_orders_csv(spark, sf_dir).repartition(7, "numero_pedido"))
    before |= {name for name in os.listdir(shared_folder(spark)) if name.startswith("staging")}
    load_star(spark, texts, folder)
    return folder, set(os.listdir(shared_folder(spark))) - before


def test_a_fact_not_numbered_by_place_is_written_once(spark, sf_dir, csv_folder):
    folder, made = csv_folder
    assert not any(name.startswith("fato_pedido") for name in made)
    loaded, plain = read_star(spark, folder), star(spark, sf_dir).fato_pedido
    n = plain.count()
    assert sorted(r[0] for r in loaded.fato_pedido.select("sk_pedido").collect()) == list(range(1, n + 1))
    others = [c for c in plain.columns if c not in ("sk_pedido", "sk_categoria")]
    assert loaded.fato_pedido.select(*others).exceptAll(plain.select(*others)).isEmpty()
    assert [(f.name, f.dataType) for f in loaded.fato_pedido.schema] == [(f.name, f.dataType) for f in STAR["fato_pedido"]]
    assert loaded.fato_pedido.exceptAll(read_star(spark, folder).fato_pedido).isEmpty()


def test_keys_formed_on_reading_move_nothing_and_are_read_only_if_asked_for(spark, csv_folder):
    fact = read_star(spark, csv_folder[0]).fato_pedido
    assert not re.search("Exchange|Join", plan_of(fact))
    schema = re.search(r"ReadSchema: \S+", plan_of(fact.select("numero_pedido", "sk_loja")))[0]
    assert "lugar" not in schema and "numero_pedido" in schema
    runs = keys.key_runs(fact, "sk_pedido")
    assert keys.has_places(fact) and not keys.runs_overlap(runs)
    assert checks.unique_keys(read_star(spark, csv_folder[0])).where("not ok").isEmpty()


def test_keys_of_more_tasks_than_are_listed_are_joined(spark, csv_folder, monkeypatch):
    listed = read_star(spark, csv_folder[0]).fato_pedido
    monkeypatch.setattr(keys, "LISTED_TASKS", 1)
    joined = read_star(spark, csv_folder[0]).fato_pedido
    assert "Join" in plan_of(joined) and joined.columns == listed.columns
    assert joined.exceptAll(listed).isEmpty() and joined.count() == listed.count()


def test_offsets_of_gaps_and_many_buckets(spark):
    rows = [(task << keys.ROW_BITS) + row for task, n in [(0, 2), (3, 1), (700, 4), (70000, 2)] for row in range(n)]
    written = spark.createDataFrame([(r,) for r in rows], "lugar long")
    offsets = keys.task_offsets(written, "lugar", buckets=4)
    found = keys.keys_from_places(written, offsets, "lugar", "sk").collect()
    assert sorted(r["sk"] for r in found) == list(range(1, 10))
    empty = keys.keys_from_places(written.limit(0), offsets.limit(0), "lugar", "sk")
    assert empty.columns == ["sk"] and empty.isEmpty()


def test_reload_in_the_other_way(spark, sf_dir):
    folder, texts = new_folder(spark, "star"), staging(spark, sf_dir)
    for by_place in (False, True, False):
        fact = load_star(spark, texts, folder, by_place=by_place).fato_pedido
        n, low, high, distinct = fact.agg(F.count("*"), F.min("sk_pedido"), F.max("sk_pedido"), F.count_distinct("sk_pedido")).first()
        assert (low, high, distinct) == (1, n, n)


def test_no_orders(spark, sf_dir):
    texts = staging(spark, sf_dir)
    loaded = load_star(
        spark, dataclasses.replace(texts, orders=texts.orders.limit(0)), new_folder(spark, "none"),
        days=(dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
    )
    assert loaded.fato_pedido.isEmpty() and loaded.fato_pedido.columns == STAR["fato_pedido"].names


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def months_in(files):
    return {name.split("/")[0].removeprefix("ano_mes=") for name in files}


def test_months_of_keys(values):
    assert values(month_of, [20240315, -1, None, 19991201], "int") == ["2024-03", "N/I", None, "1999-12"]


def test_a_reload_touches_its_months_only(spark, sf_dir):
    loaded, path = star(spark, sf_dir), new_folder(spark, "months")
    fact = loaded.fato_pedido
    monthly = write_months(fact, path)
    assert monthly.drop("ano_mes").exceptAll(fact).isEmpty() and monthly.count() == fact.count()
    before, old, largest = files_of(path), monthly.toPandas(), fact.count()
    orders = staging(spark, sf_dir).orders
    # January loses half of its orders, February all.
    left = orders.where("not (dt_hora_pedido like '02/%/1995 %' or dt_hora_pedido like '01/%/1995 %AM')")
    new = reload_months(left, loaded, path, "1995-01", "1995-02").toPandas()
    after = files_of(path)
    assert before != after
    same = lambda files: {n: t for n, t in files.items() if not n.startswith(("ano_mes=1995-01", "ano_mes=1995-02"))}
    assert same(before) == same(after) and months_in(before) == months_in(after)
    wanted = old[(old.ano_mes == "1995-01") & (old.dt_pedido.dt.hour >= 12)]
    got = new[new.ano_mes == "1995-01"]
    assert sorted(got.numero_pedido) == sorted(wanted.numero_pedido) and len(got) > 0
    assert sorted(got.sk_pedido) == list(range(largest + 1, largest + 1 + len(got)))
    assert not (new.ano_mes == "1995-02").any()
    assert len(new) == len(old) - old.ano_mes.isin(["1995-01", "1995-02"]).sum() + len(got)
    # Again, with all orders: both months are back.
    again = reload_months(orders, loaded, path, "1995-01", "1995-02").toPandas()
    assert sorted(again.numero_pedido) == sorted(old.numero_pedido) and again.sk_pedido.is_unique


def test_reload_of_months_without_orders_and_of_bad_months(spark, sf_dir):
    loaded, path = star(spark, sf_dir), new_folder(spark, "months")
    n = write_months(loaded.fato_pedido, path).count()
    assert reload_months(staging(spark, sf_dir).orders, loaded, path, "2050-01", "2050-12").count() == n
    for first, last in [("1995-1", "1995-02"), ("1995-02", "1995-01"), ("1995-01-01", "1995-02")]:
        with pytest.raises(ValueError):
            reload_months(staging(spark, sf_dir).orders, loaded, path, first, last)


def test_orders_without_a_day_are_a_month(spark, sf_dir):
    path = new_folder(spark, "months")
    fact = star(spark, sf_dir).fato_pedido.withColumn("sk_tempo_pedido", F.when(F.col("sk_pedido") < 4, -1).otherwise(F.col("sk_tempo_pedido")))
    assert write_months(fact, path).where("ano_mes = 'N/I'").count() == 3
    days = star(spark, sf_dir).dim_tempo.where("sk_tempo = -1")
    assert on_days(read_months(spark, path), days).count() == 3


def test_days_picked_by_any_attribute_skip_months(spark, sf_dir):
    monthly, loaded = monthly_star(spark, sf_dir)
    days = loaded.dim_tempo.where("ano = 1995 and trimestre = 2")
    found = on_days(monthly, days)
    plan = plan_of(found)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan), plan
    keys_of = {r[0] for r in days.select("sk_tempo").collect()}
    wanted = loaded.fato_pedido.where(F.col("sk_tempo_pedido").isin(list(keys_of)))
    assert sorted(r[0] for r in found.select("numero_pedido").collect()) == sorted(r[0] for r in wanted.select("numero_pedido").collect())
