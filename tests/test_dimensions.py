import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.bridge import allocate, build_bridge
from starloom.operators.dimensions import calendar, category_dim, territory_dim, with_unknown
from starloom.operators.keys import dense_keys, positional_keys, repeated_keys
from starloom.schema import STAR, TERRITORY_HEADERS
from starloom.sources.warehouse import literal_table, new_folder

MONTHS = "Janeiro Fevereiro Marco Abril Maio Junho Julho Agosto Setembro Outubro Novembro Dezembro".split()
DAYS = "Segunda Terca Quarta Quinta Sexta Sabado Domingo".split()


def bounds(spark, first, last):
    return spark.createDataFrame([(first, last)], "inicio date, fim date")


def test_calendar_against_datetime(spark):
    first, last = dt.date(2023, 9, 1), dt.date(2024, 4, 22)
    rows = calendar(bounds(spark, first, last)).orderBy("data").collect()
    assert len(rows) == 235
    for place, row in enumerate(rows):
        day = first + dt.timedelta(days=place)
        assert tuple(row) == (
            int(day.strftime("%Y%m%d")),
            day,
            day.year,
            day.month,
            day.day,
            day.strftime("%Y-%m"),
            MONTHS[day.month - 1],
            (day.month + 2) // 3,
            DAYS[day.weekday()],
            "Sim" if day.weekday() >= 5 else "Nao",
        )


def test_calendar_fixed_rows(spark):
    # Three days of the retail case.
    rows = calendar(bounds(spark, dt.date(2023, 9, 1), dt.date(2024, 4, 22)))
    found = {r["sk_tempo"]: (r["nome_mes"], r["trimestre"], r["dia_semana"], r["fim_de_semana"]) for r in rows.collect()}
    assert found[20230901] == ("Setembro", 3, "Sexta", "Nao")
    assert found[20240413] == ("Abril", 2, "Sabado", "Sim")
    assert found[20240422] == ("Abril", 2, "Segunda", "Nao")


def test_unknown_members(spark):
    for name in ["dim_tempo", "dim_loja", "dim_categoria", "dim_praca"]:
        dim = with_unknown(spark.createDataFrame([], STAR[name]), name)
        assert dim.schema.names == STAR[name].names
        assert [f.dataType for f in dim.schema] == [f.dataType for f in STAR[name]]
        row = dim.first()
        assert row[0] == -1
    assert row["domicilios_com_pet"] == 0
    assert row["cod_praca"] == "N/I"


def test_literal_table(spark):
    rows = [(1, "PR-1", "Norte", "Regional", 10)]
    table = literal_table(spark, rows, STAR["dim_praca"])
    assert [tuple(r) for r in with_unknown(table, "dim_praca").orderBy("sk_praca").collect()] == [
        (-1, "N/I", "Nao Informado", "Nao Informado", 0),
        *rows,
    ]


def test_dense_keys_do_not_depend_on_the_layout(spark):
    names = [f"name {i}" for i in range(1000)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    first = {r["n"]: r["sk"] for r in dense_keys(df.repartition(7), "n", "sk").collect()}
    second = {r["n"]: r["sk"] for r in dense_keys(df.orderBy(F.desc("n")).coalesce(1), "n", "sk").collect()}
    assert sorted(first.values()) == list(range(1, 1001))
    assert first == second


def test_positional_keys(spark):
    path = new_folder(spark, "positional")
    spark.range(0, 1000, 1, 7).selectExpr("id", "id % 3 = 0 as hot").write.parquet(path)
    scan = spark.read.parquet(path)
    rows = positional_keys(scan, "sk").collect()
    assert sorted(r["sk"] for r in rows) == list(range(1, 1001))
    # Small splits cut the files into other tasks; the keys stay.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        again = positional_keys(spark.read.parquet(path), "sk").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["id"]: r["sk"] for r in rows} == {r["id"]: r["sk"] for r in again}


def test_positional_keys_of_a_filtered_scan_are_unique(spark, tmp_path):
    path = str(tmp_path / "filtered")
    spark.range(5000).repartition(5).write.parquet(path)
    scan = spark.read.parquet(path).where("xxhash64(id) % 3 = 0")
    rows = positional_keys(scan, "sk").collect()
    assert len({r["sk"] for r in rows}) == len(rows) == scan.count()


def test_unknown_member_is_not_doubled(spark):
    dim = with_unknown(spark.createDataFrame([], STAR["dim_praca"]), "dim_praca")
    assert with_unknown(dim, "dim_praca").count() == 1


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "x int, y string")
    assert [tuple(r) for r in repeated_keys(df, ["x", "y"]).collect()] == [(1, "a", 2)]


def test_category_dim(spark):
    df = spark.createDataFrame([("Ração",), ("RACAO",), ("RACAO",), ("",), (None,)], "categoria_produto string")
    rows = category_dim(df).collect()
    found = {r["categoria_origem"]: r["nome_categoria"] for r in rows}
    # Byte-wise distinct; empty text is a spelling, a missing one is not.
    assert found == {"Ração": "Racao", "RACAO": "Racao", "": "Nao Informado"}
    assert sorted(r["sk_categoria"] for r in rows) == [1, 2, 3]


TERRITORY = ", ".join(f"{name} string" for name in TERRITORY_HEADERS.values())


def test_territories_and_bridge(spark):
    staged = spark.createDataFrame(
        [
            ("LJ-1", "PR-1", "Norte", "R", "148.000", "0,85"),
            ("LJ-1", "PR-2", "Sul", "R", "74.000", "0,15"),
            ("LJ-2", "PR-1", "Norte", "R", "148.000", "1,00"),
        ],
        TERRITORY,
    )
    dim = territory_dim(staged)
    assert {r["cod_praca"]: r["domicilios_com_pet"] for r in dim.collect()} == {"PR-1": 148000, "PR-2": 74000}
    without_second = dim.where("cod_praca <> 'PR-2'")
    assert build_bridge(staged, without_second).count() == 2  # unknown codes drop out
    bridge = build_bridge(staged, dim)
    totals = spark.createDataFrame([("LJ-1", 100), ("LJ-2", 10), ("LJ-3", 7)], "cod_loja string, v int")
    spread = allocate(totals.selectExpr("cod_loja", "cast(v as decimal(15,2)) v"), bridge, "v", "s")
    found = {r["cod_praca"]: float(r["s"]) for r in spread.join(dim, "sk_praca").collect()}
    assert found == {"PR-1": 95.0, "PR-2": 15.0}  # LJ-3 has no territory
