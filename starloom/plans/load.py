"""Staging to star."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.dates import date_key, parse_date, parse_us_timestamp
from starloom.functions.numbers import parse_factor, parse_int, parse_money_br, parse_thousands_int
from starloom.functions.rejects import (
    date_rule,
    factor_rule,
    integer_rule,
    money_rule,
    rejects,
    thousands_rule,
    timestamp_rule,
)
from starloom.functions.text import (
    CHANNEL_RULES,
    DISCOUNT_VALUES,
    classify,
    map_values,
    name_key,
    upper_trimmed,
)
from starloom.operators.bridge import build_bridge
from starloom.operators.dimensions import calendar, category_rows, territory_rows, with_unknown
from starloom.operators.keys import dense_keys, keys_from_places, positional_keys, stable_keys, task_offsets, written_place
from starloom.operators.lags import milestone_lags
from starloom.operators.lookup import lookup_fk, refuse_repeated, store_lookup
from starloom.schema import PLACE, REJECT_LIST, REJECTS, STAR, TASKS, UNKNOWN_LABEL
from starloom.session import split_methods
from starloom.sources.warehouse import new_folder, read_table, write_table


@dataclass(frozen=True)
class Staging:
    """What a load starts from; text tables are already renamed."""

    orders: DataFrame
    territories: DataFrame
    stores: DataFrame
    aliases: DataFrame | None = None


@dataclass(frozen=True)
class Star:
    """The six tables of the model, and the store names and aliases that orders are matched by."""

    dim_tempo: DataFrame
    dim_loja: DataFrame
    dim_categoria: DataFrame
    dim_praca: DataFrame
    bridge_loja_praca: DataFrame
    fato_pedido: DataFrame
    loja_chave: DataFrame

    def register(self) -> None:
        """Make every table a temporary view of its own name, for SQL users."""
        for field in fields(self):
            getattr(self, field.name).createOrReplaceTempView(field.name)


def order_profile(orders: DataFrame, strict: bool = True) -> DataFrame:
    """One row per category spelling with its first order day and last delivery day.

    The one pass over the orders that all dimensions built from them share.
    """
    days = orders.select(
        "categoria_produto",
        F.to_date(parse_us_timestamp(F.col("dt_hora_pedido"), strict)).alias("__pedido"),
        parse_date(F.col("dt_entrega_cliente"), strict).alias("__entrega"),
    )
    return days.groupBy("categoria_produto").agg(
        F.min("__pedido").alias("inicio"),
        F.greatest(F.max("__pedido"), F.max("__entrega")).alias("fim"),
    )


def calendar_of(profile: DataFrame) -> DataFrame:
    """Every day any order or delivery can point to."""
    return calendar(profile.agg(F.min("inicio").alias("inicio"), F.max("fim").alias("fim")))


def calendar_between(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Every day from ``first`` to ``last``."""
    return calendar(spark.range(1).select(F.lit(first).alias("inicio"), F.lit(last).alias("fim")))


# Staging text, the name of what is read from it, and the rule it may break.
_READ = {
    "dt_hora_pedido": ("dt_pedido", timestamp_rule),
    "dt_hora_integracao_erp": ("__integrado", timestamp_rule),
    "dt_separacao_estoque": ("__separado", date_rule),
    "dt_nota_fiscal": ("__faturado", date_rule),
    "dt_despacho_transportadora": ("__despachado", date_rule),
    "dt_entrega_cliente": ("__entregue", date_rule),
    "qtd_itens": ("qt_itens", integer_rule),
    "valor_liquido_pedido": ("vl_liquido", money_rule),
}


def clean_orders(orders: DataFrame, strict: bool = True) -> DataFrame:
    """Typed and standardised order columns, row by row.

    ``strict`` fails the load on a text that cannot be read; otherwise its value is NULL, and the column
    ``rejeitos`` lists column, text and broken rule of all such texts of the row (NULL if there is none).
    Shared sub-results (trimmed forms, parsed dates) get a projection of their own, so
    that each is computed once per row.
    """
    typed = orders.select(
        *[F.col(c) for c in orders.columns if c == "sk_pedido"],
        "numero_pedido",
        "categoria_produto",
        parse_us_timestamp(F.col("dt_hora_pedido"), strict).alias("dt_pedido"),
        F.to_date(parse_us_timestamp(F.col("dt_hora_integracao_erp"), strict)).alias("__integrado"),
        parse_date(F.col("dt_separacao_estoque"), strict).alias("__separado"),
        parse_date(F.col("dt_nota_fiscal"), strict).alias("__faturado"),
        parse_date(F.col("dt_despacho_transportadora"), strict).alias("__despachado"),
        parse_date(F.col("dt_entrega_cliente"), strict).alias("__entregue"),
        upper_trimmed(F.col("houve_desconto")).alias("__desconto"),
        upper_trimmed(F.col("canal_pedido")).alias("__canal"),
        name_key(F.col("loja_nome")).alias("__loja"),
        parse_int(F.col("qtd_itens"), strict=strict).alias("qt_itens"),
        parse_money_br(F.col("valor_liquido_pedido"), strict).alias("vl_liquido"),
        *([] if strict else [F.col(text).alias(f"__{text}") for text in _READ]),
    )
    steps = ["__integrado", "__separado", "__faturado", "__despachado", "__entregue"]
    lags = milestone_lags([F.col(step) for step in steps])
    rules = {text: (F.col(f"__{text}"), rule(F.col(f"__{text}"), F.col(value))) for text, (value, rule) in _READ.items()}
    return typed.select(
        *[F.col(c) for c in orders.columns if c == "sk_pedido"],
        "numero_pedido",
        date_key(F.to_date("dt_pedido")).alias("sk_tempo_pedido"),
        date_key(F.col("__entregue")).alias("sk_tempo_entrega"),
        "__loja",
        "categoria_produto",
        map_values(F.col("__desconto"), DISCOUNT_VALUES, UNKNOWN_LABEL).alias("houve_desconto"),
        classify(F.col("__canal"), CHANNEL_RULES, UNKNOWN_LABEL).alias("canal_pedido"),
        "dt_pedido",
        "qt_itens",
        "vl_liquido",
        *[lag.alias(name) for name, lag in lags.items()],
        *([] if strict else [rejects(rules).alias(REJECT_LIST.name)]),
    )


def territory_rejects(territories: DataFrame) -> DataFrame:
    """The texts of the store-by-territory staging that cannot be read, one row each."""
    homes, share = F.col("domicilios_com_pet"), F.col("percentual_publico")
    found = rejects(
        {
            "domicilios_com_pet": (homes, thousands_rule(homes, parse_thousands_int(homes, False))),
            "percentual_publico": (share, factor_rule(share, parse_factor(share, False))),
        }
    )
    return territories.select("cod_loja", "cod_praca", F.inline(found))


def build_fact(
    orders: DataFrame, dim_categoria: DataFrame, loja_chave: DataFrame, strict: bool = True
) -> DataFrame:
    """One fact row per order row: cleaned columns plus the keys found by lookup, and without ``strict`` the rejects."""
    with_store = lookup_fk(clean_orders(orders, strict), "__loja", loja_chave, "chave_loja", "sk_loja")
    found = lookup_fk(with_store, "categoria_produto", dim_categoria, "categoria_origem", "sk_categoria")
    return found.select(*[name for name in [*STAR["fato_pedido"].names, REJECT_LIST.name] if name in found.columns])


def load_star(
    spark: SparkSession,
    staging: Staging,
    folder: str | None = None,
    strict: bool = True,
    by_place: bool = False,
    days: tuple[dt.date, dt.date] | None = None,
    registry: str | None = None,
) -> Star:
    """Write the tables below ``folder`` and give them back as read from there.

    Dimensions go first. Read back, they have a known size, by which the planner
    chooses between a broadcast and a shuffle when the fact looks its keys up. The
    orders are read twice: once for the profile, once for the fact. ``strict`` is as for
    ``clean_orders``; a lenient load also writes the texts it could not read (see ``read_rejects``), those of the
    orders from lists that the fact's files hold beside its columns, so the orders are not read again for them. ``by_place`` says that the orders are a plain Parquet scan, whose rows
    can be numbered by their place; else (CSV, or any other query) each row of the fact is written with its task and row number,
    from which its key is formed on reading, so that the fact is written once as well. ``days`` are the
    first and last day of a given calendar; without it, the calendar reaches as far as the orders do. ``registry`` is a
    folder, shared by loads that follow one another, in which categories and territories keep their keys (see
    ``stable_keys``); without it every load numbers them anew.

    Names and codes that rows are matched by must be unique, else the load stops with the repeated
    ones before the fact is built.
    """
    folder = folder or new_folder(spark, "star")

    def write(df: DataFrame, name: str) -> DataFrame:
        return write_table(df, folder, name, STAR.get(name, df.schema))

    def numbered(rows: DataFrame, natural_key: str, name: str) -> DataFrame:
        if registry is None:
            return dense_keys(rows, natural_key, STAR[name][0].name)
        return stable_keys(rows, natural_key, STAR[name], registry, name)

    # Small tables that do not need each other are written side by side.
    with ThreadPoolExecutor() as pool:
        orders_job = pool.submit(positional_keys, staging.orders, "sk_pedido") if by_place else None
        profile_job = pool.submit(write, order_profile(staging.orders, strict), "perfil_pedido")
        store_job = pool.submit(write, with_unknown(staging.stores, "dim_loja"), "dim_loja")
        praca_job = pool.submit(
            lambda: write(with_unknown(numbered(territory_rows(staging.territories, strict), "cod_praca", "dim_praca"), "dim_praca"), "dim_praca")
        )
        dim_loja = store_job.result()
        key_job = pool.submit(write, store_lookup(dim_loja, staging.aliases), "loja_chave")
        dim_praca = praca_job.result()
        refusals = [pool.submit(refuse_repeated, dim_praca, "cod_praca", "sk_praca", "dim_praca")]
        bridge = build_bridge(staging.territories, dim_praca, strict)
        bridge_job = pool.submit(write, bridge, "bridge_loja_praca")
        profile = profile_job.result()
        tempo = calendar_between(spark, *days) if days else calendar_of(profile)
        tempo_job = pool.submit(write, with_unknown(tempo, "dim_tempo"), "dim_tempo")
        categories = numbered(category_rows(profile), "categoria_origem", "dim_categoria")
        dim_categoria = write(with_unknown(categories, "dim_categoria"), "dim_categoria")
        refusals.append(pool.submit(refuse_repeated, dim_categoria, "categoria_origem", "sk_categoria", "dim_categoria"))
        loja_chave = key_job.result()
        refusals.append(pool.submit(refuse_repeated, loja_chave, "chave_loja", "sk_loja", "loja_chave"))
        dim_tempo, bridge = tempo_job.result(), bridge_job.result()
        orders = orders_job.result() if orders_job else staging.orders
        for refusal in refusals:
            refusal.result()
    fact = build_fact(orders, dim_categoria, loja_chave, strict)
    numbered_already = "sk_pedido" in fact.columns
    files = [*STAR["fato_pedido"]] if numbered_already else [f for f in STAR["fato_pedido"] if f.name != "sk_pedido"] + [PLACE]
    files = T.StructType(files if strict else [*files, REJECT_LIST])
    if not numbered_already:
        fact = fact.withColumn(PLACE.name, written_place())
    with split_methods(spark):
        written = write_table(fact, folder, "fato_pedido", files)
    # Without rows where the files hold the keys themselves.
    offsets = spark.createDataFrame([], TASKS) if numbered_already else task_offsets(written, PLACE.name)
    write_table(offsets, folder, "fato_pedido_tarefas", TASKS)
    fact = read_fact(spark, folder)
    if not strict:
        listed = read_table(spark, folder, "fato_pedido", T.StructType([STAR["fato_pedido"]["numero_pedido"], REJECT_LIST]))
        found = listed.where(F.col(REJECT_LIST.name).isNotNull()).select("numero_pedido", F.inline(REJECT_LIST.name))
        write_table(found, folder, "rejeito_pedido", REJECTS["rejeito_pedido"])
        write_table(territory_rejects(staging.territories), folder, "rejeito_praca", REJECTS["rejeito_praca"])
    return Star(dim_tempo, dim_loja, dim_categoria, dim_praca, bridge, fact, loja_chave)


def read_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact below ``folder``, with keys from its files, or formed from the places that its files hold."""
    schema = STAR["fato_pedido"]
    offsets = read_table(spark, folder, "fato_pedido_tarefas", TASKS)
    if offsets.isEmpty():
        return read_table(spark, folder, "fato_pedido", schema)
    files = T.StructType([PLACE, *[f for f in schema if f.name != "sk_pedido"]])
    return keys_from_places(read_table(spark, folder, "fato_pedido", files), offsets, PLACE.name, "sk_pedido").select(*schema.names)


def read_star(spark: SparkSession, folder: str) -> Star:
    """The star that a load wrote below ``folder``."""
    others = {name: read_table(spark, folder, name, schema) for name, schema in STAR.items() if name != "fato_pedido"}
    return Star(**others, fato_pedido=read_fact(spark, folder))


def read_rejects(spark: SparkSession, folder: str, name: str = "rejeito_pedido") -> DataFrame:
    """What a lenient load could not read: ``coluna``, ``texto``, ``regra`` by order (or, in ``rejeito_praca``, by store and territory)."""
    return read_table(spark, folder, name, REJECTS[name])
