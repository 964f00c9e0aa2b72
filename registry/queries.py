"""Every operator, answer and check as a query over the given tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import derived
from starloom.functions.dates import date_key, parse_date, parse_us_timestamp
from starloom.functions.numbers import parse_int, parse_money_br, size_band
from starloom.functions.text import (
    CHANNEL_RULES,
    DISCOUNT_VALUES,
    category_group,
    category_key,
    classify,
    map_values,
    name_key,
    standard_category,
    upper_trimmed,
)
from starloom.operators.bridge import build_bridge
from starloom.operators.dimensions import category_dim, category_rows, territory_dim, territory_rows, with_unknown
from starloom.operators.keys import stable_keys
from starloom.operators.lags import milestone_lags
from starloom.operators.lookup import lookup_fk
from starloom.operators.metrics import known
from starloom.plans import answers, checks
from starloom.plans.load import (
    Staging,
    Star,
    calendar_between,
    calendar_of,
    load_star,
    order_profile,
    read_rejects,
    read_star,
)
from starloom.plans.months import on_days, reload_months, write_months
from starloom.plans.profiles import kept_profiles
from starloom.schema import LAGS, STAR, UNKNOWN_LABEL
from starloom.sources.staging import read_orders
from starloom.sources.warehouse import new_folder, settle

Query = Callable[[SparkSession, str], DataFrame]

_made: dict[tuple, object] = {}
_making = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], object]):
    """What ``make`` gave at its first call for this application, folder and session."""
    place = (spark.sparkContext.applicationId, sf_dir, label)
    with _making:
        owner, value = _made.get(place, (None, None))
        if owner is not spark:
            value = make()
            _made[place] = (spark, value)
        return value


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    """The text tables made from ``sf_dir``, written once and then read as any staging."""

    def make() -> Staging:
        folder = new_folder(spark, "staging")
        derived.write_staging(spark, sf_dir, folder)
        return derived.read_staging(spark, sf_dir, folder)

    return _once(spark, sf_dir, "staging", make)


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star over ``sf_dir``, loaded once and then read."""
    return _once(spark, sf_dir, "star", lambda: read_star(spark, star_folder(spark, sf_dir)))


def star_folder(spark: SparkSession, sf_dir: str) -> str:
    """Where the star over ``sf_dir`` was loaded to."""

    def make() -> str:
        folder = new_folder(spark, "star")
        load_star(spark, staging(spark, sf_dir), folder, by_place=True)
        return folder

    return _once(spark, sf_dir, "star_folder", make)


def cell_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star with its answer cells, settled once."""
    return _once(spark, sf_dir, "cells", lambda: answers.on_cells(star(spark, sf_dir)))


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the comparison with another engine."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
            for f in df.schema
        ]
    )


def _order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(spark, sf_dir).orders


def _per_spelling(column: str, name: str, label: Callable) -> Query:
    """Standard label per raw spelling with its orders; the rules run once per spelling."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spelled = _order_text(spark, sf_dir).groupBy(column).agg(F.count("*").alias("pedidos"))
        return spelled.select(column, label(F.col(column)).alias(name), "pedidos")

    return query


def _per_order(**columns: Callable[[], Column]) -> Query:
    """Cleaned columns per order; built on call, as column expressions need a session."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = _order_text(spark, sf_dir)
        return texts.select("numero_pedido", *[column().alias(name) for name, column in columns.items()])

    return query


def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_unknown(calendar_of(order_profile(_order_text(spark, sf_dir))), "dim_tempo")


def dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_unknown(category_dim(_order_text(spark, sf_dir)), "dim_categoria").drop("sk_categoria")


def dim_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_unknown(territory_dim(staging(spark, sf_dir).territories), "dim_praca").drop("sk_praca")


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_unknown(derived.stores(spark, sf_dir), "dim_loja")


def bridge_store_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    territories = staging(spark, sf_dir).territories
    dim = territory_dim(territories)
    codes = dim.select("sk_praca", "cod_praca")
    return build_bridge(territories, dim).join(codes, "sk_praca").drop("sk_praca")


def size_band_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of sales areas, one per supplier, that cover both bounds."""
    areas = derived.table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "cast(if(s_suppkey % 25 = 2, 150, 100 + 20 * (s_suppkey % 25)) as int) as area_venda_m2"
    )
    return areas.withColumn("porte", size_band(F.col("area_venda_m2")))


def dim_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = star(spark, sf_dir)
    dims = [
        (loaded.dim_tempo, "dim_tempo", "sk_tempo", "nome_mes"),
        (loaded.dim_loja, "dim_loja", "sk_loja", "nome_loja"),
        (loaded.dim_categoria, "dim_categoria", "sk_categoria", "nome_categoria"),
        (loaded.dim_praca, "dim_praca", "sk_praca", "nome_praca"),
    ]
    parts = [
        dim.where(F.col(sk) == -1).select(
            F.lit(name).alias("dimensao"), F.col(sk).alias("chave"), F.col(label).alias("nome")
        )
        for dim, name, sk, label in dims
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, smallest, largest and distinct keys of the tables numbered by the load."""
    return _numbered(star(spark, sf_dir))


def surrogate_keys_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a star loaded from CSV files, whose rows have no places to be numbered by."""

    def make() -> Star:
        texts = dataclasses.replace(staging(spark, sf_dir), orders=stg_orders_csv(spark, sf_dir))
        return load_star(spark, texts, new_folder(spark, "star_csv"))

    return _numbered(_once(spark, sf_dir, "star_csv", make))


def _numbered(loaded: Star) -> DataFrame:
    tables = [
        ("dim_categoria", known(loaded.dim_categoria, "sk_categoria"), "sk_categoria"),
        ("dim_praca", known(loaded.dim_praca, "sk_praca"), "sk_praca"),
        ("fato_pedido", loaded.fato_pedido, "sk_pedido"),
    ]
    parts = [
        df.agg(
            F.lit(name).alias("tabela"),
            F.count("*").alias("linhas"),
            F.min(sk).cast("bigint").alias("menor"),
            F.max(sk).cast("bigint").alias("maior"),
            F.count_distinct(sk).alias("distintas"),
        )
        for name, df, sk in tables
    ]
    return parts[0].union(parts[1]).union(parts[2])


def answer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that all answers are added up from, with the spelling for the category's arbitrary key."""
    loaded = star(spark, sf_dir)
    spellings = loaded.dim_categoria.select("sk_categoria", "categoria_origem")
    return answers.answer_cells(loaded).join(spellings, "sk_categoria").drop("sk_categoria")


def stable_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that share a key registry: the first lacks spellings and territories that the second has.

    Per dimension: members of each load, members that kept their key, and the smallest and largest new key.
    """
    registry, raw = new_folder(spark, "registro"), staging(spark, sf_dir)
    place = F.expr("cast(substring(numero_pedido, 5) as bigint) % 37")
    parts = []
    for table, key, first, second in [
        ("dim_categoria", "categoria_origem", category_rows(raw.orders.where(place < 20)), category_rows(raw.orders)),
        ("dim_praca", "cod_praca", territory_rows(raw.territories.where("regional = 'Norte'")), territory_rows(raw.territories)),
    ]:
        sk = STAR[table][0].name
        before = stable_keys(first, key, STAR[table], registry, table).select(key, F.col(sk).alias("antes"))
        # What the second load adds to the registry must not show in what the first one gave.
        before = settle(before, "antes")
        after = settle(stable_keys(second, key, STAR[table], registry, table), "depois")
        both = after.join(before, key, "left")
        new = F.when(F.col("antes").isNull(), F.col(sk)).cast("bigint")
        parts.append(
            both.agg(
                F.lit(table).alias("dimensao"),
                F.count("antes").alias("antes"),
                F.count("*").alias("depois"),
                F.count_if(F.col("antes") == F.col(sk)).alias("iguais"),
                F.min(new).alias("menor_nova"),
                F.max(new).alias("maior_nova"),
                F.count_distinct(sk).alias("distintas"),
            )
        )
    return parts[0].union(parts[1])


def known_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known(star(spark, sf_dir).fato_pedido, "sk_loja").select("numero_pedido", "sk_loja")


def store_name_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_text(spark, sf_dir).select(
        "numero_pedido", name_key(F.col("loja_nome")).alias("chave_loja")
    )


def _found_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = star(spark, sf_dir)
    named = store_name_key(spark, sf_dir).withColumnRenamed("chave_loja", "__loja")
    return lookup_fk(named, "__loja", loaded.loja_chave, "chave_loja", "sk_loja")


def lookup_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found_store(spark, sf_dir).select("numero_pedido", "sk_loja")


def store_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of the store an order's name stands for, aliases replaced."""
    names = star(spark, sf_dir).dim_loja.select("sk_loja", "chave_loja")
    return _found_store(spark, sf_dir).join(names, "sk_loja").select("numero_pedido", "chave_loja")


def lookup_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = star(spark, sf_dir).dim_categoria
    texts = _order_text(spark, sf_dir).select("numero_pedido", "categoria_produto")
    found = lookup_fk(texts, "categoria_produto", dim, "categoria_origem", "sk_categoria")
    return found.join(dim, "sk_categoria").select("numero_pedido", "categoria_origem", "nome_categoria")


def date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _order_text(spark, sf_dir).select(
        "numero_pedido",
        F.to_date(parse_us_timestamp(F.col("dt_hora_pedido"))).alias("pedido"),
        parse_date(F.col("dt_entrega_cliente")).alias("entrega"),
    )
    return days.select(
        "numero_pedido",
        date_key(F.col("pedido")).alias("sk_tempo_pedido"),
        date_key(F.col("entrega")).alias("sk_tempo_entrega"),
    )


def milestone_lags_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _order_text(spark, sf_dir)
    dates = texts.select(
        "numero_pedido",
        F.to_date(parse_us_timestamp(F.col("dt_hora_integracao_erp"))).alias("m0"),
        *[parse_date(F.col(c)).alias(f"m{i}") for i, c in enumerate(checks.MILESTONES, 1)],
    )
    lags = milestone_lags([F.col(f"m{i}") for i in range(5)])
    return dates.select("numero_pedido", *[lag.alias(name) for name, lag in lags.items()])


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded fact; the category's arbitrary key is shown as the spelling it stands for."""
    loaded = star(spark, sf_dir)
    spellings = loaded.dim_categoria.select("sk_categoria", "categoria_origem")
    return loaded.fato_pedido.join(spellings, "sk_categoria").select(
        "numero_pedido",
        "sk_tempo_pedido",
        "sk_tempo_entrega",
        "sk_loja",
        "categoria_origem",
        "houve_desconto",
        "canal_pedido",
        "dt_pedido",
        "qt_itens",
        "vl_liquido",
        *LAGS,
    )


def stg_orders_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order staging by way of CSV files with the columns in another order, and one more."""

    def make() -> DataFrame:
        path = f"{new_folder(spark, 'staging')}/stg_pedido_csv"
        texts = derived.orders(spark, sf_dir)
        turned = texts.select(F.lit("x").alias("Obs"), *[F.col(f"`{c}`") for c in reversed(texts.columns)])
        kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        turned.write.option("header", True).options(**kept).csv(path)
        return read_orders(spark, path, "csv")

    return _once(spark, sf_dir, "staging_csv", make)


def monthly_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Star]:
    """The fact in month folders, and the star that it is of."""
    loaded = star(spark, sf_dir)
    return _once(spark, sf_dir, "months", lambda: write_months(loaded.fato_pedido, new_folder(spark, "meses"))), loaded


def fact_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and revenue of the weekends of every second quarter, a month a row; other months are not read."""
    monthly, loaded = monthly_star(spark, sf_dir)
    found = on_days(monthly, loaded.dim_tempo.where("trimestre = 2 and fim_de_semana = 'Sim'"))
    return found.groupBy("ano_mes").agg(F.count("*").alias("pedidos"), F.sum("vl_liquido").cast("decimal(20,2)").alias("vl_liquido"))


def fact_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months of a fact of which 1995-01 to 1995-03 were loaded again after corrections.

    In these months, orders of odd number were withdrawn, and all of February. ``novas`` counts rows with keys beyond those first given.
    """
    loaded, path = star(spark, sf_dir), new_folder(spark, "meses")
    before = loaded.fato_pedido.count()
    write_months(loaded.fato_pedido, path)
    texts = staging(spark, sf_dir).orders
    odd = F.expr("cast(substring(numero_pedido, 5) as bigint) % 2 = 1")
    left = texts.where(~(odd | F.col("dt_hora_pedido").like("02/%")))
    monthly = reload_months(left, loaded, path, "1995-01", "1995-03")
    return monthly.groupBy("ano_mes").agg(
        F.count("*").alias("pedidos"),
        F.count_if(F.col("sk_pedido") > before).alias("novas"),
        F.count_distinct("sk_pedido").alias("distintas"),
        F.sum("vl_liquido").cast("decimal(20,2)").alias("vl_liquido"),
    )


def _lenient_folder(spark: SparkSession, sf_dir: str) -> str:
    """Where the staging with planted faults was loaded to, without ``strict``."""

    def make() -> str:
        sound, folder = staging(spark, sf_dir), new_folder(spark, "lenient")
        path = f"{new_folder(spark, 'staging')}/stg_pedido_ruim"
        derived.with_faults(sound.orders).write.parquet(path)
        faulty = dataclasses.replace(sound, orders=spark.read.parquet(path))
        load_star(spark, faulty, folder, strict=False, by_place=True)
        return folder

    return _once(spark, sf_dir, "lenient", make)


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text that a lenient load could not read."""
    return read_rejects(spark, _lenient_folder(spark, sf_dir))


def fact_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact beside the rejects: unreadable texts have become missing values, all else stands."""
    fact = read_star(spark, _lenient_folder(spark, sf_dir)).fato_pedido
    return fact.select("numero_pedido", "sk_tempo_pedido", "sk_tempo_entrega", "dt_pedido", "qt_itens", "vl_liquido", *LAGS)


def parse_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery days from texts of which some are parts of dates, or more than dates."""
    texts = _order_text(spark, sf_dir).selectExpr(
        "numero_pedido", "dt_entrega_cliente as d", "cast(substring(numero_pedido, 5) as bigint) % 9 as way"
    )
    changed = F.expr(
        "case when d = '' then d when way = 1 then substring(d, 1, 4) when way = 2 then substring(d, 1, 7)"
        " when way = 3 then concat(d, ' garbage') when way = 4 then concat(d, 'Tzz')"
        " when way = 5 then concat(d, ' 10:07:00') when way = 6 then concat(d, ' 99:99')"
        " when way = 7 then concat(d, ' 25:00:00') else d end"
    )
    return texts.select("numero_pedido", parse_date(changed, strict=False).alias("entrega"))


def check_date_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key checks against a given calendar that ends before the last orders do."""
    days = calendar_between(spark, dt.date(1990, 1, 1), dt.date(1997, 12, 31))
    given = with_unknown(days, "dim_tempo")
    return checks.fk_integrity(dataclasses.replace(star(spark, sf_dir), dim_tempo=given))


# Expected by the way the staging is derived, at any scale.
EXPECTED = {
    "stg_loja": 25,
    "stg_loja_praca": 38,
    "dim_loja": 26,
    "dim_categoria": 38,
    "dim_praca": 6,
    "bridge_loja_praca": 38,
    "grafias de categoria": 37,
    "grafias de desconto": 17,
    "grafias de canal": 20,
    "categorias padronizadas": 8,
    "lojas na ponte": 25,
    "pracas na ponte": 5,
}


def check_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = star(spark, sf_dir)
    raw = staging(spark, sf_dir)
    return checks.row_counts(
        {
            "stg_pedido": raw.orders,
            "stg_loja": raw.stores,
            "stg_loja_praca": raw.territories,
            "dim_tempo": loaded.dim_tempo,
            "dim_loja": loaded.dim_loja,
            "dim_categoria": loaded.dim_categoria,
            "dim_praca": loaded.dim_praca,
            "bridge_loja_praca": loaded.bridge_loja_praca,
            "fato_pedido": loaded.fato_pedido,
        },
        EXPECTED,
    )


def checks_from_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks from profiles, of which those of the first orders were kept before the others were there."""
    loaded, raw, folder = star(spark, sf_dir), staging(spark, sf_dir), new_folder(spark, "perfis")
    path = f"{new_folder(spark, 'staging')}/stg_pedido_em_partes"
    early = F.expr("cast(substring(numero_pedido, 5) as bigint) % 3 = 0")
    measures = checks.staging_profile()
    raw.orders.where(early).write.parquet(path)
    kept_profiles(spark.read.parquet(path), f"{folder}/stg_pedido", measures).count()
    raw.orders.where(~early).write.mode("append").parquet(path)
    return checks.run(dataclasses.replace(raw, orders=spark.read.parquet(path)), loaded, EXPECTED, profiles=folder)


def check_targets_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets before a load, and after it, when the check must fail."""
    before = checks.targets_empty(spark, new_folder(spark, "vazio")).withColumn("momento", F.lit("antes da carga"))
    return before.union(checks.targets_empty(spark, star_folder(spark, sf_dir)).withColumn("momento", F.lit("depois da carga")))


def _on_star(function: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: function(star(spark, sf_dir), *args)


def _on_cells(function: Callable[..., DataFrame]) -> Query:
    """An answer from the cells, which one pass over the fact gives to all answers."""
    return lambda spark, sf_dir: function(cell_star(spark, sf_dir))


def _on_staging(function: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: function(staging(spark, sf_dir), *args)


def _cleaners() -> dict[str, Query]:
    return {
        "std_category": _per_spelling(
            "categoria_produto", "nome_categoria", lambda c: standard_category(category_key(c), UNKNOWN_LABEL)
        ),
        "std_category_group": _per_spelling(
            "categoria_produto", "grupo_categoria", lambda c: category_group(category_key(c), UNKNOWN_LABEL)
        ),
        "std_channel": _per_spelling(
            "canal_pedido", "canal", lambda c: classify(upper_trimmed(c), CHANNEL_RULES, UNKNOWN_LABEL)
        ),
        "std_discount": _per_spelling(
            "houve_desconto", "desconto", lambda c: map_values(upper_trimmed(c), DISCOUNT_VALUES, UNKNOWN_LABEL)
        ),
        "parse_money": _per_order(vl_liquido=lambda: parse_money_br(F.col("valor_liquido_pedido"))),
        "parse_quantity": _per_order(qt_itens=lambda: parse_int(F.col("qtd_itens"))),
        "parse_timestamp": _per_order(dt_pedido=lambda: parse_us_timestamp(F.col("dt_hora_pedido"))),
    }


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {
        "stg_orders_scan": _order_text,
        "stg_orders_csv": stg_orders_csv,
        "parse_date": parse_date_query,
        "stg_territories_scan": lambda spark, sf_dir: staging(spark, sf_dir).territories,
        **_cleaners(),
        "date_keys": date_keys,
        "milestone_lags": milestone_lags_query,
        "store_name_key": store_name_key,
        "store_alias": store_alias,
        "size_band": size_band_query,
        "dim_calendar": dim_calendar,
        "dim_store": dim_store,
        "dim_category": dim_category,
        "dim_territory": dim_territory,
        "dim_unknown_member": dim_unknown_member,
        "bridge_store_territory": bridge_store_territory,
        "surrogate_keys": surrogate_keys,
        "surrogate_keys_csv": surrogate_keys_csv,
        "stable_keys": stable_keys_query,
        "lookup_category": lookup_category,
        "lookup_store": lookup_store,
        "known_members": known_members,
        "fact_orders": fact_orders,
        "fact_days": fact_days,
        "fact_reload": fact_reload,
        "load_rejects": load_rejects,
        "fact_lenient": fact_lenient,
        "answer_cells": answer_cells,
        "p1_lags_overall": _on_cells(answers.lags_overall),
        "p1_bottleneck": _on_cells(answers.step_ranking),
        "p1_lags_by_size": _on_cells(answers.lags_by_size),
        "p1_steps_by_size": _on_cells(answers.steps_by_size),
        "p1_bottleneck_by_size": _on_cells(answers.bottleneck_by_size),
        "p2_category_revenue": _on_cells(answers.revenue_by_category),
        "p2_category_by_size": _on_cells(answers.category_by_size),
        "p2_champion": _on_cells(answers.champion_by_size),
        "p3_ticket_by_channel": _on_cells(answers.ticket_by_channel),
        "p3_ticket_gap": _on_cells(answers.ticket_gap),
        "p3_channel_share": _on_cells(answers.channel_share),
        "p3_summary": _on_cells(answers.channel_summary),
        "p4_store_revenue": _on_cells(answers.store_revenue),
        "p4_allocated": _on_cells(answers.allocated_revenue),
        "p4_reconcile": _on_cells(answers.reconciliation),
        "p4_per_household": _on_cells(answers.revenue_per_household),
        "p5_items_per_1000": _on_cells(answers.items_per_thousand),
        "p5_top10": _on_cells(answers.top_items_per_thousand),
        "p5_tier_share": _on_cells(answers.tier_share),
        "p5_quality_impact": _on_cells(answers.quality_impact),
        "p5_quality_pct": _on_cells(answers.quality_percentages),
        "check_row_counts": check_row_counts,
        "check_targets_empty": check_targets_empty,
        "check_spellings": _on_staging(checks.spellings, EXPECTED),
        "check_blank_milestones": _on_staging(checks.blank_milestones),
        "check_date_mask": _on_staging(checks.date_mask),
        "check_money_audit": _on_staging(checks.money_audit),
        "check_date_orphans": check_date_orphans,
        "check_category_domain": _on_star(checks.category_domain, EXPECTED),
        "check_unclassified": _on_star(checks.unclassified),
        "check_rule_order": _on_star(checks.rule_order),
        "check_bridge_weights": _on_star(checks.bridge_weights),
        "check_bridge_coverage": _on_star(checks.bridge_coverage, EXPECTED),
        "check_unknown_rows": _on_star(checks.unknown_rows),
        "check_unique_keys": _on_star(checks.unique_keys),
        "check_text_lengths": _on_star(checks.text_lengths),
        "check_fact_grain": lambda spark, sf_dir: checks.fact_grain(
            staging(spark, sf_dir), star(spark, sf_dir)
        ),
        "check_fk_integrity": _on_star(checks.fk_integrity),
        "check_unresolved": _on_star(checks.unresolved),
        "check_channel_present": _on_star(checks.channel_present),
        "check_date_range": _on_star(checks.date_range),
        "check_negative_lags": _on_star(checks.negative_lags),
        "check_join_preserves_total": _on_star(checks.join_preserves_total),
        "check_allocation": _on_star(checks.allocation),
        "checks_from_profiles": checks_from_profiles,
        "checks_all": lambda spark, sf_dir: checks.run(staging(spark, sf_dir), star(spark, sf_dir), EXPECTED),
    }
    return {name: _plain(query) for name, query in found.items()}


def _plain(query: Query) -> Query:
    return lambda spark, sf_dir: plain_types(query(spark, sf_dir))
