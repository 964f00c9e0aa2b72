"""References, key uniqueness and spellings without moving order rows."""

import re

import pytest
from pyspark.sql import functions as F

from registry.queries import staging, star
from starloom.operators.keys import has_places, key_runs, positional_keys, repeated_keys, runs_overlap
from starloom.plans import checks
from starloom.sources.warehouse import new_folder
from tests.test_plans import executed


def test_references_take_one_scan_and_move_sums_only(spark, sf_dir):
    plan = checks.fk_integrity(star(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    (scan,) = [found.start() for found in re.finditer(r"FileScan parquet .*fato_pedido", plan)]
    assert "partial_count" in plan[plan.rfind("Exchange", 0, scan) : scan]


def test_spellings_are_counted_without_expand(spark, sf_dir):
    raw, loaded = staging(spark, sf_dir), star(spark, sf_dir)
    for check in (checks.spellings(raw), checks.run(raw, loaded)):
        plan = check._jdf.queryExecution().executedPlan().toString()
        scans = [found.start() for found in re.finditer(r"FileScan parquet .*(stg_pedido|fato_pedido)", plan)]
        assert scans
        for scan in scans:
            assert "Expand" not in plan[plan.rfind("Exchange", 0, scan) : scan]


def test_spelling_cells_hold_the_category_dimension(spark, sf_dir):
    found = checks.spelling_cells(staging(spark, sf_dir).orders).where("coluna = 'categoria_produto'").select("texto")
    wanted = star(spark, sf_dir).dim_categoria.where("sk_categoria <> -1").select("categoria_origem")
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def written(spark, *parts):
    """Key lists, a file each."""
    folder = new_folder(spark, "keys")
    for keys in parts:
        spark.createDataFrame([(k,) for k in keys], "sk long").coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize(
    ("parts", "runs", "clash"),
    [
        ([[1, 2, 3], [4, 5]], 2, False),
        ([[4, 5, 1, 2, 3]], 2, False),
        ([[1, 2, 3], [3, 4]], 2, True),
        ([[1, 2, 3, 4, 5], [2, 3]], 2, True),
        ([[7, 7]], 2, True),
        ([[2, 1]], 2, False),
        ([[1, None]], 2, True),
        ([[5_000_000 + i for i in range(10)], [1, 2]], 2, False),
        ([[(1 << 22) - 1, 1 << 22], [1 << 22]], 2, True),
        ([[]], 0, False),
    ],
)
def test_runs_of_keys(spark, parts, runs, clash):
    df = written(spark, *parts)
    found = key_runs(df, "sk")
    assert found.count() == runs and runs_overlap(found) == clash
    assert clash == (not repeated_keys(df.where("sk is not null"), ["sk"]).isEmpty() or None in sum(parts, []))


def test_places_are_known_of_scans_only(spark):
    df = written(spark, [1, 2])
    assert has_places(df) and has_places(df.where("sk > 0").select("sk"))
    assert not has_places(spark.createDataFrame([(1,)], "sk long")) and not has_places(df.union(df))


def test_numbered_keys_are_few_runs(spark, sf_dir):
    fact = star(spark, sf_dir).fato_pedido
    assert key_runs(fact, "sk_pedido").count() <= 2 * fact.inputFiles().__len__()
    plan = executed(key_runs(fact, "sk_pedido"))
    scan = plan.index("fato_pedido")
    assert plan.count("Exchange") == 1 and "partial_count" in plan[plan.index("Exchange") : scan]
    numbered = positional_keys(written(spark, [5, 5], [5]), "nk")
    assert sorted(r.nk for r in numbered.collect()) == [1, 2, 3]


def test_overlapping_keys_are_counted(spark, sf_dir):
    import dataclasses

    loaded = star(spark, sf_dir)
    folder = new_folder(spark, "twice")
    loaded.fato_pedido.write.parquet(folder)
    loaded.fato_pedido.where(F.col("sk_pedido") % 100 == 0).write.mode("append").parquet(folder)
    broken = dataclasses.replace(loaded, fato_pedido=spark.read.parquet(folder))
    counts = {r.teste: r.valor for r in checks.unique_keys(broken).collect()}
    wanted = loaded.fato_pedido.where(F.col("sk_pedido") % 100 == 0).count()
    assert counts["chave repetida em fato_pedido"] == counts["chave repetida em numero_pedido"] == wanted > 0


def test_targets_are_empty_before_a_load_only(spark, sf_dir, tmp_path):
    found = checks.targets_empty(spark, str(tmp_path / "none"))
    assert [(r.valor, r.ok) for r in found.collect()] == [(0, True)] * 4
