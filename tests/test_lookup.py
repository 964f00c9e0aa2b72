import pytest
from pyspark.sql import functions as F

from starloom.operators.lookup import lookup_fk, store_lookup

DIM = "sk_categoria int, categoria_origem string"


def test_unknown_label_as_a_spelling_does_not_fan_out(spark):
    dim = spark.createDataFrame([(-1, "Nao Informado"), (1, "Nao Informado"), (2, "Racao")], DIM)
    orders = spark.createDataFrame([("Nao Informado",), ("Racao",), (None,), ("racao",)], "c string")
    found = lookup_fk(orders, "c", dim, "categoria_origem", "sk_categoria").collect()
    assert sorted((str(r["c"]), r["sk_categoria"]) for r in found) == [
        ("Nao Informado", 1),
        ("None", -1),
        ("Racao", 2),
        ("racao", -1),  # byte-wise
    ]


def test_aliases(spark):
    stores = spark.createDataFrame([(-1, "NAO INFORMADO"), (1, "A"), (2, "B")], "sk_loja int, chave_loja string")
    aliases = spark.createDataFrame([("AA", "A"), ("B", "A"), ("X", "GONE")], "apelido string, chave_loja string")
    found = {r["chave_loja"]: r["sk_loja"] for r in store_lookup(stores, aliases).collect()}
    # An alias goes before the store of that name; one of no store stays unresolved.
    assert found == {"NAO INFORMADO": -1, "A": 1, "AA": 1, "B": 1}
    assert store_lookup(stores).count() == 3


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_hot_and_missing_keys_survive_either_join(spark, threshold):
    """A third of all rows under one key, a third without a key; with and without a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        dim = spark.range(1, 200).selectExpr("cast(id as int) sk_categoria", "concat('n', id) categoria_origem")
        orders = spark.range(0, 30000, 1, 6).selectExpr(
            "id", "case id % 3 when 0 then 'n7' when 1 then null else concat('n', id % 400) end as c"
        )
        found = lookup_fk(orders, "c", dim, "categoria_origem", "sk_categoria")
        groups = found.groupBy((F.col("id") % 3).alias("g")).agg(
            F.count("*").alias("n"),
            F.count_if(F.col("sk_categoria") == 7).alias("hot"),
            F.count_if(F.col("sk_categoria") == -1).alias("lost"),
        )
        rows = {r["g"]: (r["n"], r["hot"], r["lost"]) for r in groups.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows[0] == (10000, 10000, 0)
    assert rows[1] == (10000, 0, 10000)
    thirds = [i % 400 for i in range(30000) if i % 3 == 2]
    assert rows[2] == (10000, thirds.count(7), sum(1 for t in thirds if not 1 <= t < 200))
