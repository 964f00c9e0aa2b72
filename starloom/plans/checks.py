"""Data-quality checks and reconciliations.

Most checks give rows of ``teste``, ``valor``, ``esperado``, ``ok``; those that must come
back empty give the offending rows. Measures of one table are taken in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, is_us_timestamp
from starloom.functions.numbers import money_text, parse_money_br
from starloom.functions.text import CATEGORY_RULES, is_blank
from starloom.operators.keys import has_places, key_runs, repeated_keys, runs_overlap
from starloom.operators.metrics import cells, count_if, roll_up
from starloom.plans.load import Staging, Star
from starloom.plans.profiles import Measure, kept_profiles, merged
from starloom.schema import LAGS, LENGTHS, STAR, UNKNOWN_KEY, UNKNOWN_LABEL
from starloom.sources.warehouse import read_table, settle

Expected = Mapping[str, int]

# What the checks must give on the retail case this model was made for.
CASE_EXPECTED = {
    "stg_pedido": 4044,
    "stg_loja": 32,
    "stg_loja_praca": 48,
    "dim_tempo": 236,
    "dim_loja": 33,
    "dim_categoria": 38,
    "dim_praca": 13,
    "bridge_loja_praca": 48,
    "fato_pedido": 4044,
    "grafias de categoria": 37,
    "pedidos sem codigo de loja": 1575,
    "pedidos sem nome de loja": 3,
    "dt_separacao_estoque": 1077,
    "dt_nota_fiscal": 1338,
    "dt_despacho_transportadora": 1665,
    "dt_entrega_cliente": 1953,
    "mascara americana": 4044,
    "categorias padronizadas": 8,
    "lojas na ponte": 32,
    "pracas na ponte": 12,
    "pedidos sem loja": 3,
    "entregas nao feitas": 1953,
    "primeiro pedido": 20230901,
    "ultimo pedido": 20240331,
}

# Checks whose expected value is the same on any data, under the labels of the model.
ALWAYS_EXPECTED = {
    "FK nula": 0,
    "FK orfa (loja)": 0,
    "FK orfa (categoria)": 0,
    "FK orfa (tempo do pedido)": 0,
    "FK orfa (tempo da entrega)": 0,
    "dias negativos": 0,
    "grafias sem categoria": 0,
    "ordem das regras": 0,
    "lojas com fator diferente de 1": 0,
    "linha -1 de dim_tempo": 1,
    "linha -1 de dim_loja": 1,
    "linha -1 de dim_categoria": 1,
    "linha -1 de dim_praca": 1,
    "pedidos perdidos ou repetidos": 0,
    "total perdido na juncao de categoria": 0,
    "rateio sem fechar": 0,
    **{f"chave repetida em {table}": 0 for table in STAR if table != "loja_chave"},
    "chave repetida em numero_pedido": 0,
    "chave natural repetida em loja_chave": 0,
    "chave natural repetida em dim_categoria": 0,
    "chave natural repetida em dim_praca": 0,
    "horas fora da mascara": 0,
    "valores ilegiveis": 0,
    "canal WhatsApp ausente": 0,
    **{f"texto longo em {table}": 0 for table in LENGTHS},
}

MILESTONES = [
    "dt_separacao_estoque",
    "dt_nota_fiscal",
    "dt_despacho_transportadora",
    "dt_entrega_cliente",
]
SPELLINGS = {
    "grafias de categoria": "categoria_produto",
    "grafias de nome de loja": "loja_nome",
    "grafias de desconto": "houve_desconto",
    "grafias de canal": "canal_pedido",
}
KEYS = {
    "dim_tempo": ["sk_tempo"],
    "dim_loja": ["sk_loja"],
    "dim_categoria": ["sk_categoria"],
    "dim_praca": ["sk_praca"],
    "bridge_loja_praca": ["cod_loja", "sk_praca"],
    "fato_pedido": ["sk_pedido"],
}
# What rows are matched by, and the surrogate key beside it.
NATURAL_KEYS = {
    "loja_chave": ("chave_loja", "sk_loja"),
    "dim_categoria": ("categoria_origem", "sk_categoria"),
    "dim_praca": ("cod_praca", "sk_praca"),
}
DIMENSIONS = [table for table in KEYS if table.startswith("dim_")]
# The category due to a spelling that several rules fit: the first rule's.
DUE_CATEGORY = CATEGORY_RULES[0][1]
FOREIGN_KEYS = {
    "FK orfa (loja)": ("sk_loja", "dim_loja", "sk_loja"),
    "FK orfa (categoria)": ("sk_categoria", "dim_categoria", "sk_categoria"),
    "FK orfa (tempo do pedido)": ("sk_tempo_pedido", "dim_tempo", "sk_tempo"),
    "FK orfa (tempo da entrega)": ("sk_tempo_entrega", "dim_tempo", "sk_tempo"),
}


def expect(measured: DataFrame, expected: Expected | None = None) -> DataFrame:
    """Set ``teste, valor`` beside what was expected; no expectation gives a NULL verdict."""
    wanted = {**ALWAYS_EXPECTED, **(expected or {})}
    table = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    value = F.col("valor").cast("bigint")
    wanted_value = table[F.col("teste")].cast("bigint")
    return measured.select("teste", value.alias("valor"), wanted_value.alias("esperado")).withColumn(
        "ok", F.col("valor") == F.col("esperado")
    )


def _long(wide: DataFrame) -> DataFrame:
    """One row of measures as ``teste, valor`` rows."""
    same = wide.select(*[F.col(f"`{c}`").cast("bigint").alias(c) for c in wide.columns])
    return same.unpivot([], [F.col(f"`{c}`") for c in same.columns], "teste", "valor")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _one(df: DataFrame, name: str) -> DataFrame:
    return _long(df.agg(F.count("*").alias(name)))


# Staging


def _blank_counts(strict: bool) -> dict[str, Column]:
    blank = (lambda c: F.col(c) == "") if strict else (lambda c: is_blank(F.col(c)))
    return {column: count_if(blank(column)) for column in MILESTONES}


def spelling_cells(orders: DataFrame) -> DataFrame:
    """Orders per column and text, for the columns whose spellings are counted and the store code.

    Tasks add their rows up first, so what is moved is one row a text and task. A text stands once, so distinct
    counts are plain counts, and the category spellings are those of the dimension.
    """
    columns = [*SPELLINGS.values(), "cod_loja"]
    pairs = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("texto")) for c in columns])
    return cells(orders.select(F.inline(pairs)), ["coluna", "texto"], {"linhas": F.count("*")})


def _spelling_counts() -> dict[str, Column]:
    """Measures over ``spelling_cells``."""
    of = lambda column: F.col("coluna") == column
    blank = lambda column: F.sum(F.when(of(column) & (F.col("texto") == ""), F.col("linhas")).otherwise(0))
    return {
        **{name: F.count_if(of(column) & F.col("texto").isNotNull()) for name, column in SPELLINGS.items()},
        "pedidos sem codigo de loja": blank("cod_loja"),
        "pedidos sem nome de loja": blank("loja_nome"),
    }


def _mask_count() -> dict[str, Column]:
    return {"mascara americana": F.count_if(is_us_timestamp(F.col("dt_hora_pedido")))}


def row_counts(tables: Mapping[str, DataFrame], expected: Expected | None = None) -> DataFrame:
    """Q1, Q5, Q6, Q7: rows per table."""
    return expect(_union([_one(df, name) for name, df in tables.items()]), expected)


TARGETS = ["dim_categoria", "dim_praca", "bridge_loja_praca", "fato_pedido"]


def targets_empty(spark: SparkSession, folder: str) -> DataFrame:
    """Q6: rows in the four tables that a load fills, at the place it will write to; there must be none before it.

    A table that is not there has no rows.
    """
    rows = []
    for name in TARGETS:
        try:
            rows.append(_one(read_table(spark, folder, name, STAR[name]), name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows.append(spark.range(1).select(F.lit(name).alias("teste"), F.lit(0).cast("bigint").alias("valor")))
    return expect(_union(rows), dict.fromkeys(TARGETS, 0))


def spellings(staging: Staging, expected: Expected | None = None) -> DataFrame:
    """Q2: distinct spellings of four columns (empty text counts, NULL does not), blank store columns."""
    return expect(_long(cells(spelling_cells(staging.orders), [], _spelling_counts())), expected)


def blank_milestones(staging: Staging, expected: Expected | None = None, strict: bool = True) -> DataFrame:
    """Q3: orders whose milestone is empty text, or with ``strict`` off also NULL or all blanks."""
    return expect(_long(cells(staging.orders, [], _blank_counts(strict))), expected)


def _off_mask() -> dict[str, Column]:
    return {"horas fora da mascara": F.count_if(~is_us_timestamp(F.col("dt_hora_pedido")))}


def date_mask(staging: Staging) -> DataFrame:
    """Q4: order times that fit the month-first mask; all rows of the staging should."""
    found = cells(staging.orders, [], {**_mask_count(), "linhas": F.count("*")})
    rows = found.select(
        F.lit("mascara americana").alias("teste"),
        F.col("mascara americana").cast("bigint").alias("valor"),
        F.col("linhas").cast("bigint").alias("esperado"),
    )
    return rows.withColumn("ok", F.col("valor") == F.col("esperado"))


def _money_counts() -> dict[str, Column]:
    text = F.col("valor_liquido_pedido")
    value = parse_money_br(text, strict=False)
    comma_then_dot = text.rlike(r",[0-9]*\.") & ~text.rlike(r",[0-9]*\..*,")
    return {
        "valores com ponto depois de virgula": count_if(comma_then_dot),
        "valores negativos": count_if(value < 0),
        "valores ilegiveis": count_if(value.isNull() & money_text(text).isNotNull()),
    }


def money_audit(staging: Staging) -> DataFrame:
    """Value texts that parse, but may not mean what the parser takes them for, and those that fail."""
    return expect(_long(cells(staging.orders, [], _money_counts())))


# Dimensions and bridge


def _domain() -> dict[str, Column]:
    return {"categorias padronizadas": F.count_distinct("nome_categoria")}


def _is_unclassified() -> Column:
    return (F.col("nome_categoria") == UNKNOWN_LABEL) & (F.col("sk_categoria") != UNKNOWN_KEY)


def _fits_two_rules() -> Column:
    return F.upper("categoria_origem").contains("MEDICAMENTOSA")


def category_domain(star: Star, expected: Expected | None = None) -> DataFrame:
    """Q8: distinct standard categories, the unknown one included."""
    return expect(_long(cells(star.dim_categoria, [], _domain())), expected)


def unclassified(star: Star) -> DataFrame:
    """Q9: spellings that no rule classified. Must be empty."""
    return star.dim_categoria.where(_is_unclassified()).select("categoria_origem", "nome_categoria")


def rule_order(star: Star) -> DataFrame:
    """Q10: spellings that two rules fit, with the category found and the one due."""
    return star.dim_categoria.where(_fits_two_rules()).select(
        "categoria_origem", "nome_categoria", F.lit(DUE_CATEGORY).alias("esperado")
    )


def bridge_weights(star: Star) -> DataFrame:
    """Q11: store codes whose factors do not add up to one. Must be empty."""
    total = F.round(F.sum("fator_publico"), 4)
    sums = star.bridge_loja_praca.groupBy("cod_loja").agg(total.alias("soma_dos_fatores"))
    return sums.where(F.col("soma_dos_fatores") != 1)


def _coverage() -> dict[str, Column]:
    return {
        "lojas na ponte": F.count_distinct("cod_loja"),
        "pracas na ponte": F.count_distinct("sk_praca"),
    }


def bridge_coverage(star: Star, expected: Expected | None = None) -> DataFrame:
    """Q12: stores and territories the bridge reaches."""
    return expect(_long(cells(star.bridge_loja_praca, [], _coverage())), expected)


def _unknown(dim: str) -> dict[str, Column]:
    return {f"linha -1 de {dim}": F.count_if(F.col(KEYS[dim][0]) == UNKNOWN_KEY)}


def unknown_rows(star: Star) -> DataFrame:
    """Q13: unknown members per dimension; each must have one."""
    return expect(_union([_long(cells(getattr(star, dim), [], _unknown(dim))) for dim in DIMENSIONS]))


def _too_long(table: str) -> dict[str, Column]:
    over = [F.char_length(F.col(column)) > limit for column, limit in LENGTHS[table].items()]
    return {f"texto longo em {table}": F.count_if(reduce(Column.__or__, over))}


def text_lengths(star: Star) -> DataFrame:
    """Rows with a text longer than its column is declared to hold, per table."""
    return expect(_union([_long(cells(getattr(star, table), [], _too_long(table))) for table in LENGTHS]))


def unique_keys(star: Star) -> DataFrame:
    """Primary-key values found more than once, per table, and repeated order numbers, names and codes.

    The fact's surrogate keys are not moved if they go up by place: their runs are looked at, one row each, and only if
    some overlap the keys themselves are counted.
    """
    fact = star.fato_pedido
    sound = has_places(fact) and not runs_overlap(settle(key_runs(fact, "sk_pedido"), "key_runs"))
    parts = [
        _one(repeated_keys(getattr(star, name), key), f"chave repetida em {name}")
        for name, key in KEYS.items()
        if not (sound and name == "fato_pedido")
    ]
    if sound:
        none = fact.sparkSession.range(1).select(F.lit("chave repetida em fato_pedido").alias("teste"), F.lit(0).cast("bigint").alias("valor"))
        parts.append(none)
    parts.append(_one(repeated_keys(star.fato_pedido, ["numero_pedido"]), "chave repetida em numero_pedido"))
    for name, (key, sk) in NATURAL_KEYS.items():
        named = getattr(star, name).where((F.col(sk) != UNKNOWN_KEY) & F.col(key).isNotNull())
        parts.append(_one(repeated_keys(named, [key]), f"chave natural repetida em {name}"))
    return expect(_union(parts))


# Fact


def fact_grain(staging: Staging, star: Star) -> DataFrame:
    """Q14: fact rows against staging rows."""
    rows = star.fato_pedido.agg(F.count("*").alias("valor"))
    wanted = staging.orders.agg(F.count("*")).scalar()
    return rows.select(F.lit("fato_pedido").alias("teste"), "valor", wanted.alias("esperado")).withColumn(
        "ok", F.col("valor") == F.col("esperado")
    )


_FK_COLUMNS = [fk for fk, _, _ in FOREIGN_KEYS.values()]


def _unresolved() -> dict[str, Column]:
    return {
        "pedidos sem loja": F.count_if(F.col("sk_loja") == UNKNOWN_KEY),
        "entregas nao feitas": F.count_if(F.col("sk_tempo_entrega") == UNKNOWN_KEY),
    }


def _negative_lags() -> dict[str, Column]:
    return {"dias negativos": F.count_if(reduce(Column.__or__, [F.col(lag) < 0 for lag in LAGS]))}


def _date_range() -> dict[str, Column]:
    return {"primeiro pedido": F.min(F.to_date("dt_pedido")), "ultimo pedido": F.max(F.to_date("dt_pedido"))}


def _key_cells(star: Star, keys: list[str]) -> DataFrame:
    """Orders and revenue per combination of foreign keys."""
    return cells(star.fato_pedido, keys, {"linhas": F.count("*"), "valor": F.sum("vl_liquido")})


_NULL_FK = "FK nula"


def reference_counts(star: Star) -> DataFrame:
    """Orders per foreign key and value, and under ``FK nula`` those that lack any, from one scan of the fact.

    Tasks add their rows up first: what is moved is one row a value and task. Hash sums of values are cheaper here than
    presence bitmaps, whose aggregate sorts its rows, and give the orders of orphans at once.
    """
    missing = reduce(Column.__or__, [F.col(fk).isNull() for fk in _FK_COLUMNS])
    pairs = [F.struct(F.lit(name).alias("teste"), F.col(fk).alias("sk")) for name, (fk, _, _) in FOREIGN_KEYS.items()]
    pairs.append(F.struct(F.lit(_NULL_FK).alias("teste"), F.when(missing, F.lit(0)).alias("sk")))
    used = star.fato_pedido.select(F.inline(F.array(*pairs))).where((F.col("teste") != _NULL_FK) | F.col("sk").isNotNull())
    return cells(used, ["teste", "sk"], {"linhas": F.count("*")})


def _broken_references(star: Star) -> DataFrame:
    keys = _union(
        [
            getattr(star, dim).select(F.lit(name).alias("teste"), F.col(sk).alias("sk"), F.lit(True).alias("__known"))
            for name, (_, dim, sk) in FOREIGN_KEYS.items()
        ]
    )
    # Not an anti-join, which the optimiser would move below the sums, to every order.
    lost = reference_counts(star).join(keys, ["teste", "sk"], "left").where(F.col("__known").isNull())
    count = lambda name: F.coalesce(F.sum(F.when(F.col("teste") == name, F.col("linhas"))), F.lit(0))
    return _long(lost.agg(*[count(name).alias(name) for name in [_NULL_FK, *FOREIGN_KEYS]]))


def fk_integrity(star: Star) -> DataFrame:
    """Q15: orders with a missing reference, and with one that points nowhere. Order dates included."""
    return expect(_broken_references(star))


def unresolved(star: Star, expected: Expected | None = None) -> DataFrame:
    """Q16: orders of unknown stores and orders not delivered."""
    return expect(_long(cells(star.fato_pedido, [], _unresolved())), expected)


def channel_present(star: Star, channel: str = "WhatsApp") -> DataFrame:
    """Q17: orders of one channel; empty if the rules were tried in the wrong order."""
    return cells(
        star.fato_pedido.where(F.col("canal_pedido") == channel), ["canal_pedido"], {"pedidos": F.count("*")}
    )


def _channel_missing(channel: str = "WhatsApp") -> dict[str, Column]:
    missing = F.coalesce(F.max((F.col("canal_pedido") == channel).cast("int")), F.lit(0)) == 0
    return {f"canal {channel} ausente": missing.cast("bigint")}


def date_range(star: Star) -> DataFrame:
    """Q18: first and last order day."""
    return cells(star.fato_pedido, [], _date_range()).toDF("primeiro_pedido", "ultimo_pedido")


def negative_lags(star: Star) -> DataFrame:
    """Q19: orders with a negative lag."""
    return expect(_long(cells(star.fato_pedido, [], _negative_lags())))


def join_preserves_total(star: Star, parts: DataFrame | None = None) -> DataFrame:
    """Q20: revenue in the fact, and as reached through the category join; in whole units."""
    per_key = parts if parts is not None else _key_cells(star, ["sk_categoria"])
    keys = star.dim_categoria.select("sk_categoria", F.lit(True).alias("__found"))
    return per_key.join(keys, "sk_categoria", "left").agg(
        F.round(F.sum("valor")).alias("total_na_fato"),
        F.round(F.sum(F.when(F.col("__found"), F.col("valor")))).alias("total_pela_p2"),
    )


def allocation(star: Star, parts: DataFrame | None = None) -> DataFrame:
    """Q21: total, allocated and unknown-store revenue in whole units; their difference rounded once.

    Here each pair of store and territory is weighted by itself, where P4.3 uses a store's
    summed weights. A store's whole revenue is carried by the first of its pairs only, so one
    pass gives both sums.
    """
    per_store = roll_up(parts if parts is not None else _key_cells(star, ["sk_loja"]), ["sk_loja"], ["valor"])
    codes = star.dim_loja.select("sk_loja", "cod_loja")
    first = F.row_number().over(Window.partitionBy("cod_loja").orderBy("sk_praca")) == 1
    bridge = star.bridge_loja_praca.withColumn("__first", first)
    pairs = per_store.join(codes, "sk_loja", "left").join(bridge, "cod_loja", "left")
    once = F.when(F.coalesce("__first", F.lit(True)), F.col("valor"))
    sums = pairs.agg(
        F.sum(once).alias("total"),
        F.sum(F.col("valor") * F.col("fator_publico")).alias("rateado"),
        F.sum(F.when(F.col("sk_loja") == UNKNOWN_KEY, once)).alias("sem_loja"),
    )
    return sums.select(
        F.round("total").alias("total_da_rede"),
        F.round("rateado").alias("soma_rateada"),
        F.round("sem_loja").alias("sem_loja"),
        F.expr("round(total - coalesce(rateado, 0) - coalesce(sem_loja, 0))").alias("diferenca"),
    )


# All together


def _small_table_measures(table: str) -> dict[str, Column]:
    measures = {table: F.count("*"), **_too_long(table)}
    if table in DIMENSIONS:
        measures |= _unknown(table)
    if table == "dim_categoria":
        misplaced = _fits_two_rules() & (F.col("nome_categoria") != DUE_CATEGORY)
        measures |= {
            **_domain(),
            "grafias sem categoria": F.count_if(_is_unclassified()),
            "ordem das regras": F.count_if(misplaced),
        }
    if table == "bridge_loja_praca":
        measures |= _coverage()
    return measures


def _staging_measures() -> dict[str, Column]:
    return {"stg_pedido": F.count("*"), **_blank_counts(True), **_mask_count(), **_off_mask(), **_money_counts()}


def _fact_sums() -> dict[str, Column]:
    return {"fato_pedido": F.count("*"), **_unresolved(), **_negative_lags(), **_too_long("fato_pedido")}


#: Orders of the channel that must be there, as a profile holds them.
_CHANNEL = "pedidos WhatsApp"


def staging_profile() -> dict[str, Measure]:
    """What is kept of a file of the order staging."""
    return {name: Measure(value) for name, value in _staging_measures().items()}


def fact_profile() -> dict[str, Measure]:
    """What is kept of a file of the fact."""
    bounds = {name: Measure(F.when(day.isNotNull(), date_key(day)), merge) for (name, day), merge in zip(_date_range().items(), ("min", "max"), strict=True)}
    channel = {_CHANNEL: Measure(F.count_if(F.col("canal_pedido") == "WhatsApp"))}
    return {**{name: Measure(value) for name, value in _fact_sums().items()}, **channel, **bounds}


def _from_profiles(staging: Staging, star: Star, folder: str) -> list[DataFrame]:
    """The measures of staging and fact that add up over files, and the fact's grain, from profiles kept below ``folder``."""
    texts, rows = staging_profile(), fact_profile()
    of_texts = settle(merged(kept_profiles(staging.orders, f"{folder}/stg_pedido", texts), texts), "staging_profile")
    of_rows = settle(merged(kept_profiles(star.fato_pedido, f"{folder}/fato_pedido", rows), rows), "fact_profile")
    missing = (F.col(f"`{_CHANNEL}`") == 0).cast("bigint").alias("canal WhatsApp ausente")
    # A table without days has the unknown member's key, as when it is read.
    bounds = [F.coalesce(F.col(f"`{name}`"), F.lit(UNKNOWN_KEY)).alias(name) for name in _date_range()]
    plain = [F.col(f"`{name}`") for name in _fact_sums()]
    wanted = of_texts.agg(F.sum("stg_pedido")).scalar()
    grain = of_rows.select((F.col("fato_pedido") - wanted).alias("pedidos perdidos ou repetidos"))
    return [_long(of_texts), _long(of_rows.select(*plain, missing, *bounds)), _long(grain)]


def _from_tables(staging: Staging, star: Star) -> list[DataFrame]:
    """The same from the tables themselves."""
    days = {name: date_key(day) for name, day in _date_range().items()}
    lost_orders = F.col("valor") - F.col("esperado")
    grain = fact_grain(staging, star).select(F.lit("pedidos perdidos ou repetidos").alias("teste"), lost_orders.alias("valor"))
    return [
        _long(cells(staging.orders, [], _staging_measures())),
        _long(cells(star.fato_pedido, [], {**_fact_sums(), **_channel_missing(), **days})),
        grain,
    ]


def run(staging: Staging, star: Star, expected: Expected | None = None, profiles: str | None = None) -> DataFrame:
    """Every check that comes down to a number, with the must-be-empty ones counted.

    Dimensions and bridge are read once each, the staging once for its measures and once for its spellings. The
    fact is read once for its profile, its references, its settled cells and each uniqueness check. ``profiles`` is a
    folder in which the measures of staging and fact are kept, one row a file: there, files that an earlier
    call has seen are not read again for them. Staging and fact must then be plain scans.
    """
    with ThreadPoolExecutor() as pool:
        unique_job = pool.submit(unique_keys, star)
        places = settle(_key_cells(star, ["sk_loja", "sk_categoria"]), "place_cells")
        unique = unique_job.result()

    total = join_preserves_total(star, places)
    lost_total = F.col("total_na_fato") - F.col("total_pela_p2")
    parts = [
        *(_from_profiles(staging, star, profiles) if profiles else _from_tables(staging, star)),
        _long(cells(spelling_cells(staging.orders), [], _spelling_counts())),
        _one(staging.stores, "stg_loja"),
        _one(staging.territories, "stg_loja_praca"),
        *[
            _long(cells(getattr(star, table), [], _small_table_measures(table)))
            for table in KEYS
            if table != "fato_pedido"
        ],
        _one(bridge_weights(star), "lojas com fator diferente de 1"),
        _broken_references(star),
        _long(total.select(lost_total.alias("total perdido na juncao de categoria"))),
        _long(allocation(star, places).select(F.col("diferenca").alias("rateio sem fechar"))),
        unique.select("teste", "valor"),
    ]
    return expect(_union(parts), expected)
