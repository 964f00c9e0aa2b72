"""Measures kept by file."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry.queries import EXPECTED, staging, star
from starloom.plans import checks
from starloom.plans.profiles import Measure, files_of, kept_profiles, merged
from starloom.sources.warehouse import new_folder

def measures():
    return {
        "linhas": Measure(F.count("*")),
        "pares": Measure(F.count_if(F.col("v") % 2 == 0)),
        "menor": Measure(F.min("v"), "min"),
        "maior": Measure(F.max("v"), "max"),
    }


def write(spark, path, values):
    spark.createDataFrame([(v, "x" * 3000) for v in values], "v long, pad string").coalesce(1).write.mode("append").parquet(path)


def measured(spark, path, folder):
    return tuple(merged(kept_profiles(spark.read.parquet(path), folder, measures()), measures()).first())


def damage(path):
    """Make the rows of all files there unreadable, with size, time and footer as before."""
    for file in Path(path).glob("*.parquet"):
        stat = file.stat()
        with open(file, "r+b") as f:
            f.seek(4)
            f.write(b"\xff" * 200)
        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))


def test_only_files_without_a_profile_are_read(spark):
    path, folder = new_folder(spark, "t"), new_folder(spark, "p")
    write(spark, path, range(500))
    assert measured(spark, path, folder) == (500, 250, 0, 499)
    damage(path)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(path).agg(F.sum("v")).collect()
    write(spark, path, [-7, None, 1000])
    assert measured(spark, path, folder) == (503, 251, -7, 1000)
    assert measured(spark, path, folder) == (503, 251, -7, 1000)
    assert spark.read.parquet(folder).count() == 2


def test_a_file_that_was_replaced_is_read_again_and_one_that_is_gone_does_not_count(spark):
    path, folder = new_folder(spark, "t"), new_folder(spark, "p")
    write(spark, path, [1, 2])
    write(spark, path, [3])
    assert measured(spark, path, folder) == (3, 1, 1, 3)
    spark.createDataFrame([(8, "y")], "v long, pad string").coalesce(1).write.mode("overwrite").parquet(path)
    assert measured(spark, path, folder) == (1, 1, 8, 8)
    assert spark.read.parquet(folder).count() == 3


def test_many_new_files_and_profiles_kept_twice(spark, monkeypatch):
    path, folder = new_folder(spark, "t"), new_folder(spark, "p")
    write(spark, path, [1, 2])
    first = kept_profiles(spark.read.parquet(path), folder, measures())
    first.write.mode("append").parquet(folder)
    monkeypatch.setattr("starloom.plans.profiles.NAMED_FILES", 1)
    for v in (3, 4, 5):
        write(spark, path, [v])
    assert measured(spark, path, folder) == (5, 2, 1, 5)
    assert files_of(spark.read.parquet(path)).count() == 4


def test_empty_tables_and_other_measures(spark):
    path, folder = new_folder(spark, "t"), new_folder(spark, "p")
    write(spark, path, [])
    assert measured(spark, path, folder) == (0, 0, None, None)
    write(spark, path, [4])
    assert measured(spark, path, folder) == (1, 1, 4, 4)
    with pytest.raises(ValueError):
        kept_profiles(spark.read.parquet(path), folder, {**measures(), "mais": Measure(F.count("v"))})


def test_checks_from_profiles_are_those_from_the_tables(spark, sf_dir):
    raw, loaded, folder = staging(spark, sf_dir), star(spark, sf_dir), new_folder(spark, "p")
    rows = lambda df: sorted(map(str, df.collect()))
    wanted = rows(checks.run(raw, loaded, EXPECTED))
    assert rows(checks.run(raw, loaded, EXPECTED, profiles=folder)) == wanted
    kept = {name: spark.read.parquet(f"{folder}/{name}") for name in ("stg_pedido", "fato_pedido")}
    assert kept["fato_pedido"].agg(F.sum("fato_pedido")).first()[0] == loaded.fato_pedido.count()
    n = {name: df.count() for name, df in kept.items()}
    assert rows(checks.run(raw, loaded, EXPECTED, profiles=folder)) == wanted
    assert {name: spark.read.parquet(f"{folder}/{name}").count() for name in kept} == n
