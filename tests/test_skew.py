"""All queries on tables where one order's copies and one customer each hold a third of the rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from registry.oracles import oracles
from registry.queries import registered
from tests.test_registry import sorted_rows


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in ["nation", "region", "supplier"]:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    half = orders.count() // 2
    kept = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    ).withColumn("o_totalprice", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")))
    copies = orders.where("o_orderkey = 600").join(spark.range(half))
    parts = kept.unionByName(copies.select(*orders.columns))
    # Several files of very different sizes, so that keys by place have offsets to get right.
    parts.repartition(5, "o_custkey").write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(skewed):
    connection = duckdb.connect()
    for table in ["nation", "region", "supplier", "orders"]:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet/*.parquet'")
    return connection


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, duck, skewed, name):
    df = registered()[name](spark, skewed)
    wanted = duck.sql(oracles()[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(wanted.columns, wanted.fetchall())
