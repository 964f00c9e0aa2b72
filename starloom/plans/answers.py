"""The business questions, P1 to P5, on a star.

Means and shares are rounded once, from exact decimals. Descending orders put
missing values first. Which answers count orders of unknown stores differs from
question to question; each says so.

Every answer can be had from the fact, in one pass each, or all of them from ``answer_cells``,
which takes one pass for all: ``on_cells`` puts these in the place of the fact.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numbers import rounded_ratio
from starloom.operators.bridge import allocate
from starloom.operators.metrics import (
    Additive,
    cells,
    champions,
    count_if,
    known,
    lag_mean,
    lag_measures,
    per_unit,
    roll_up,
    share,
    total,
    under_label,
)
from starloom.plans.load import Star
from starloom.schema import LAGS, STEP_LAGS, TOTAL_LAG, UNKNOWN_KEY
from starloom.sources.warehouse import settle

# Labels of the process steps, in process order.
STEP_LABELS = [
    "Integracao -> Separacao",
    "Separacao -> Nota",
    "Nota -> Despacho",
    "Despacho -> Entrega",
]
# Column names of the means.
MEAN_NAMES = {lag: lag.replace("dias_", "media_", 1) for lag in LAGS}

# Allocated money carries the places of money and of the factor together.
ALLOCATED_SCALE = 6


# What every answer groups by, before it goes on to dimensions.
CELL_KEYS = ["sk_loja", "sk_categoria", "canal_pedido", "houve_desconto"]


def _orders() -> Additive:
    return Additive("n_pedidos", F.count("*"))


def _revenue() -> Additive:
    return Additive("sum_vl_liquido", F.sum("vl_liquido"))


def _valued() -> Additive:
    return Additive("n_vl_liquido", F.count("vl_liquido"))


def _items() -> Additive:
    return Additive("sum_qt_itens", F.sum("qt_itens"))


def answer_cells(star: Star) -> DataFrame:
    """Orders, sums, counts of known values and counts of problems per store, category, channel and discount flag.

    The one pass over the fact from which all answers follow. As many rows as there are such combinations in
    the fact, so their number depends on the dimensions and not on the orders.
    """
    measures = [_orders(), _revenue(), _valued(), _items(), *lag_measures().values(), *_problems().values()]
    return cells(star.fato_pedido, CELL_KEYS, {measure.ready: measure for measure in measures})


def on_cells(star: Star) -> Star:
    """The star with the cells, written once, in the place of its fact; the answers are the same."""
    return dataclasses.replace(star, fato_pedido=settle(answer_cells(star), "answer_cells"))


def _money(name: str) -> Column:
    return F.round(name, 2)


# P1: where is the bottleneck?


def lags_overall(star: Star) -> DataFrame:
    """P1.1: the five mean lags over all orders, unknown stores included."""
    total = cells(star.fato_pedido, [], lag_measures())
    return total.select(*[lag_mean(lag).alias(MEAN_NAMES[lag]) for lag in LAGS])


def step_ranking(star: Star) -> DataFrame:
    """P1.2: the four steps by mean lag, longest first. One pass for all four."""
    total = cells(star.fato_pedido, [], lag_measures(STEP_LAGS))
    wide = total.select(
        *[lag_mean(lag).alias(label) for lag, label in zip(STEP_LAGS, STEP_LABELS, strict=True)]
    )
    return wide.unpivot([], STEP_LABELS, "etapa", "media_dias").orderBy(F.desc_nulls_first("media_dias"))


def _lags_by_store_attribute(star: Star, lags: list[str], by: str) -> DataFrame:
    measures = {"qtd_pedidos": _orders(), **lag_measures(lags)}
    per_store = cells(known(star.fato_pedido, "sk_loja"), ["sk_loja"], measures)
    return roll_up(per_store.join(star.dim_loja, "sk_loja"), [by], list(measures))


def lags_by_size(star: Star, by: str = "porte") -> DataFrame:
    """P1.3: orders and the five mean lags per size band of known stores."""
    groups = _lags_by_store_attribute(star, LAGS, by)
    means = [lag_mean(lag).alias(MEAN_NAMES[lag]) for lag in LAGS]
    return groups.select(by, "qtd_pedidos", *means).orderBy(by)


def steps_by_size(star: Star, by: str = "porte") -> DataFrame:
    """P1.4: the four step means per size band of known stores."""
    groups = _lags_by_store_attribute(star, STEP_LAGS, by)
    means = [lag_mean(lag).alias(lag.removeprefix("dias_")) for lag in STEP_LAGS]
    return groups.select(by, *means).orderBy(by)


def bottleneck_by_size(star: Star, by: str = "porte") -> DataFrame:
    """The longest step of each size band by its exact mean; of equals, the earlier step."""
    groups = _lags_by_store_attribute(star, STEP_LAGS, by)
    exact = lambda lag: F.expr(f"cast(sum_{lag} as decimal(18,0)) / nullif(cast(n_{lag} as decimal(18,0)), 0)")
    steps = [
        F.struct(
            exact(lag).alias("media"),
            F.lit(-place).alias("ordem"),
            F.lit(lag.removeprefix("dias_")).alias("etapa"),
            lag_mean(lag).alias("media_dias"),
        )
        for place, lag in enumerate(STEP_LAGS)
    ]
    worst = groups.select(by, F.array_max(F.array(*steps)).alias("pior"))
    return worst.select(by, "pior.etapa", "pior.media_dias").orderBy(by)


# P2: which category holds the revenue?


def revenue_by_category(star: Star, by: str = "nome_categoria") -> DataFrame:
    """P2.1: revenue per standard category and its share of all revenue, unknown stores included."""
    measure = "faturamento_categoria"
    per_key = cells(star.fato_pedido, ["sk_categoria"], {measure: _revenue()})
    groups = under_label(per_key, star.dim_categoria, "sk_categoria", by, [measure], unknown=True)
    return (
        groups.withColumn("__total", total(measure))
        .where("__listed")
        .select(
            by,
            _money(measure).alias(measure),
            share(measure, "__total").alias("percentual_faturamento"),
        )
        .orderBy(F.desc_nulls_first(measure))
    )


def _category_within_store_attribute(star: Star, by: str, within: str) -> DataFrame:
    """Revenue per band and category of known stores, with the band's total.

    The total also covers cells without a category, which get no row of their own.
    """
    measure = "faturamento_categoria"
    per_key = cells(known(star.fato_pedido, "sk_loja"), ["sk_loja", "sk_categoria"], {measure: _revenue()})
    banded = per_key.join(star.dim_loja.select("sk_loja", within), "sk_loja")
    groups = under_label(
        banded, star.dim_categoria, "sk_categoria", by, [measure], unknown=True, keep=[within]
    )
    return groups.withColumn("__total", total(measure, [within])).where("__listed")


def category_by_size(star: Star, by: str = "nome_categoria", within: str = "porte") -> DataFrame:
    """P2.2: revenue per category and its share within each size band of known stores."""
    groups = _category_within_store_attribute(star, by, within)
    return groups.select(
        within,
        by,
        _money("faturamento_categoria").alias("faturamento_categoria"),
        share("faturamento_categoria", "__total").alias(f"percentual_no_{within}"),
    ).orderBy(within, F.desc_nulls_first("faturamento_categoria"))


def champion_by_size(star: Star, by: str = "nome_categoria", within: str = "porte") -> DataFrame:
    """P2.3: the category or categories with the largest revenue in each size band of known stores."""
    groups = _category_within_store_attribute(star, by, within)
    best = champions(groups, [within], "faturamento_categoria")
    return best.select(
        within,
        F.col(by).alias("categoria_campea"),
        _money("faturamento_categoria").alias("faturamento"),
    ).orderBy(within)


# P3: does a discount work alike in every channel?


def _ticket_cells(star: Star, by: str) -> DataFrame:
    """Orders, revenue and valued orders per ``by``, in all and by discount flag.

    The fact is added up by ``by`` and flag; the conditions then look at those few cells.
    """
    measures = {"pedidos": _orders(), "receita": _revenue(), "valores": _valued()}
    flagged = cells(star.fato_pedido, [by, "houve_desconto"], measures)

    def where(flag: str, name: str) -> Column:
        return F.when(F.col("houve_desconto") == flag, F.col(name))

    return flagged.groupBy(by).agg(
        F.sum("pedidos").alias("qtd_pedidos"),
        F.sum("receita").alias("faturamento_canal"),
        F.sum(where("Sim", "receita")).alias("sum_com"),
        F.sum(where("Sim", "valores")).alias("n_com"),
        F.sum(where("Sim", "pedidos").otherwise(0)).alias("pedidos_com_desconto"),
        F.sum(where("Nao", "receita")).alias("sum_sem"),
        F.sum(where("Nao", "valores")).alias("n_sem"),
        F.sum(where("Nao", "pedidos").otherwise(0)).alias("pedidos_sem_desconto"),
    )


def _mean_ticket(kind: str) -> Column:
    return rounded_ratio(f"sum_{kind}", f"n_{kind}")


# The two means brought to one denominator, in cents: each sum times the other count.
_CROSS_WITH = "cast(sum_com * 100 as decimal(38,0)) * n_sem"
_CROSS_WITHOUT = "cast(sum_sem * 100 as decimal(38,0)) * n_com"


def _ticket_gap() -> Column:
    """Mean with minus mean without discount, rounded once and not mean by mean."""
    cents = "cast(n_com as decimal(38,0)) * n_sem * 100"
    return rounded_ratio(f"{_CROSS_WITH} - {_CROSS_WITHOUT}", cents, scale=0)


def _ticket_change() -> Column:
    """The gap as a percentage of the mean without discount; NULL where that mean is zero."""
    return rounded_ratio(f"{_CROSS_WITH} - {_CROSS_WITHOUT}", _CROSS_WITHOUT, scale=0, times=100)


def ticket_by_channel(star: Star, by: str = "canal_pedido") -> DataFrame:
    """P3.1: mean ticket and number of orders with and without discount per channel, all orders."""
    return (
        _ticket_cells(star, by)
        .select(
            by,
            _mean_ticket("com").alias("ticket_medio_com_desconto"),
            _mean_ticket("sem").alias("ticket_medio_sem_desconto"),
            "pedidos_com_desconto",
            "pedidos_sem_desconto",
        )
        .orderBy(by)
    )


def ticket_gap(star: Star, by: str = "canal_pedido") -> DataFrame:
    """P3.2: the two mean tickets, their difference and its percentage per channel, all orders."""
    return (
        _ticket_cells(star, by)
        .select(
            by,
            _mean_ticket("com").alias("ticket_com_desconto"),
            _mean_ticket("sem").alias("ticket_sem_desconto"),
            _ticket_gap().alias("diferenca_ticket"),
            _ticket_change().alias("variacao_percentual"),
        )
        .orderBy(by)
    )


def channel_share(star: Star, by: str = "canal_pedido") -> DataFrame:
    """P3.3: orders, revenue and share of all revenue per channel, all orders."""
    groups = cells(star.fato_pedido, [by], {"qtd_pedidos": _orders(), "faturamento_canal": _revenue()})
    return groups.withColumn("__total", total("faturamento_canal")).select(
        by,
        "qtd_pedidos",
        _money("faturamento_canal").alias("faturamento_canal"),
        share("faturamento_canal", "__total").alias("percentual_faturamento"),
    ).orderBy(F.desc_nulls_first("faturamento_canal"))


def channel_summary(star: Star, by: str = "canal_pedido") -> DataFrame:
    """P3.4: tickets, gap, orders, revenue and share per channel in one pass, all orders."""
    groups = _ticket_cells(star, by).withColumn("__total", total("faturamento_canal"))
    return groups.select(
        by,
        "qtd_pedidos",
        _mean_ticket("com").alias("ticket_com_desconto"),
        _mean_ticket("sem").alias("ticket_sem_desconto"),
        _ticket_gap().alias("diferenca_ticket"),
        _money("faturamento_canal").alias("faturamento_canal"),
        share("faturamento_canal", "__total").alias("percentual_faturamento"),
    ).orderBy(F.desc_nulls_first("faturamento_canal"))


# P4: which territory holds the revenue?


def _revenue_per_store_code(star: Star) -> DataFrame:
    per_store = cells(known(star.fato_pedido, "sk_loja"), ["sk_loja"], {"faturamento_loja": _revenue()})
    codes = star.dim_loja.select("sk_loja", "cod_loja")
    return roll_up(per_store.join(codes, "sk_loja"), ["cod_loja"], ["faturamento_loja"])


def _allocated(star: Star) -> DataFrame:
    spread = allocate(
        _revenue_per_store_code(star), star.bridge_loja_praca, "faturamento_loja", "faturamento_rateado"
    )
    return spread.join(star.dim_praca, "sk_praca")


def store_revenue(star: Star) -> DataFrame:
    """P4.1: revenue per known store."""
    per_store = cells(known(star.fato_pedido, "sk_loja"), ["sk_loja"], {"faturamento_loja": _revenue()})
    return (
        per_store.join(star.dim_loja, "sk_loja")
        .select("nome_loja", _money("faturamento_loja").alias("faturamento_loja"))
        .orderBy(F.desc_nulls_first("faturamento_loja"))
    )


def allocated_revenue(star: Star) -> DataFrame:
    """P4.2: revenue of known stores spread over territories by the bridge."""
    return (
        _allocated(star)
        .select("nome_praca", _money("faturamento_rateado").alias("faturamento_rateado"))
        .orderBy(F.desc_nulls_first("faturamento_rateado"))
    )


def reconciliation(star: Star) -> DataFrame:
    """P4.3: allocated plus unknown-store minus total revenue, the difference rounded once.

    One pass: each store's revenue times the sum of its factors is what its territories
    get. A part without any order is shown as missing and counts as nothing in the difference.
    """
    per_store = cells(star.fato_pedido, ["sk_loja"], {"faturamento": _revenue()})
    weights = star.bridge_loja_praca.groupBy("cod_loja").agg(F.sum("fator_publico").alias("peso"))
    store_weights = star.dim_loja.join(weights, "cod_loja").select("sk_loja", "peso")
    spread = F.when(F.col("sk_loja") != UNKNOWN_KEY, F.col("faturamento") * F.col("peso"))
    sums = per_store.join(store_weights, "sk_loja", "left").agg(
        F.sum("faturamento").alias("total"),
        F.sum(spread.cast("decimal(38,6)")).alias("rateado"),
        F.sum(F.when(F.col("sk_loja") == UNKNOWN_KEY, F.col("faturamento"))).alias("sem_loja"),
    )
    return sums.select(
        _money("total").alias("faturamento_total_rede"),
        _money("rateado").alias("faturamento_rateado_pracas"),
        _money("sem_loja").alias("faturamento_sem_loja"),
        F.expr("round(coalesce(rateado, 0) + coalesce(sem_loja, 0) - total, 2)").alias("diferenca"),
    )


def revenue_per_household(star: Star) -> DataFrame:
    """P4.4: allocated revenue per household with pets. Not a market share."""
    return (
        _allocated(star)
        .select(
            "nome_praca",
            "domicilios_com_pet",
            _money("faturamento_rateado").alias("faturamento_rateado"),
            per_unit("faturamento_rateado", "domicilios_com_pet", ALLOCATED_SCALE).alias(
                "faturamento_por_domicilio_com_pet"
            ),
        )
        .orderBy(F.desc_nulls_first("faturamento_rateado"))
    )


# P5: where to open the next store?


def items_per_thousand(star: Star) -> DataFrame:
    """P5.1: items sold, items per thousand inhabitants and mean total lag per known store."""
    measures = {"total_itens_vendidos": _items(), **lag_measures([TOTAL_LAG])}
    per_store = cells(known(star.fato_pedido, "sk_loja"), ["sk_loja"], measures)
    return (
        per_store.join(star.dim_loja, "sk_loja")
        .select(
            "nome_loja",
            "cidade",
            "porte",
            "populacao_cidade",
            "total_itens_vendidos",
            per_unit("total_itens_vendidos", "populacao_cidade", 0, times=1000).alias(
                "itens_por_mil_habitantes"
            ),
            lag_mean(TOTAL_LAG).alias("tempo_medio_entrega"),
        )
        .orderBy(F.desc_nulls_first("itens_por_mil_habitantes"))
    )


def top_items_per_thousand(star: Star, n: int = 10) -> DataFrame:
    """The first ``n`` stores of P5.1 that have a figure; of equals, by name."""
    figures = items_per_thousand(star).where(F.col("itens_por_mil_habitantes").isNotNull())
    return figures.orderBy(F.desc("itens_por_mil_habitantes"), "nome_loja").limit(n)


def tier_share(star: Star, by: str = "faixa_franquia") -> DataFrame:
    """P5.2: orders, revenue and share per current franchise tier of known stores.

    The share is of all revenue, so the shares add up to less than 100. A store carries
    only its present tier; the figures say nothing on the tier at the time of the order.
    """
    measures = {"qtd_pedidos": _orders(), "faturamento": _revenue()}
    per_store = cells(star.fato_pedido, ["sk_loja"], measures)
    groups = under_label(per_store, star.dim_loja, "sk_loja", by, list(measures), unknown=False)
    return (
        groups.withColumn("__total", total("faturamento"))
        .where("__listed")
        .select(
            by,
            "qtd_pedidos",
            _money("faturamento").alias("faturamento"),
            share("faturamento", "__total").alias("percentual_faturamento"),
        )
        .orderBy(F.desc_nulls_first("faturamento"))
    )


def _problems() -> dict[str, Additive]:
    conditions = {
        "pedidos_sem_loja": F.col("sk_loja") == UNKNOWN_KEY,
        "entregas_nao_concluidas": F.col("sk_tempo_entrega") == UNKNOWN_KEY,
        "pedidos_com_itens_em_branco": F.col("qt_itens").isNull(),
        "pedidos_com_valor_em_branco": F.col("vl_liquido").isNull(),
    }
    return {name: Additive(name, count_if(condition)) for name, condition in conditions.items()}


def quality_impact(star: Star) -> DataFrame:
    """P5.3: orders, and how many of them lack a store, a delivery, a quantity or a value."""
    return cells(star.fato_pedido, [], {"total_pedidos": _orders(), **_problems()})


def quality_percentages(star: Star) -> DataFrame:
    """The counts of P5.3 as percentages of all orders, one row per problem."""
    counts = quality_impact(star)
    long = counts.unpivot(["total_pedidos"], list(_problems()), "problema", "quantidade")
    return long.select(
        "problema",
        "quantidade",
        rounded_ratio("quantidade", "total_pedidos", scale=0, times=100).alias("percentual"),
    )
