"""Dirty order staging derived from the given tables.

The given tables are clean, so text as it would come from a shop system is made from
them by fixed rules, row by row and over all rows: ``k`` is the order key and picks
format, spelling and gaps. The store is the nation numbered ``o_custkey % 25``, so that
an order row carries its store, as a shop's export does, and no join of orders with
customers stands before the work to be measured. Comparison queries work from the clean
columns instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.numbers import size_band
from starloom.plans.load import Staging
from starloom.schema import ORDER_HEADERS
from starloom.session import split_methods
from starloom.sources.staging import read_orders, read_territories

# Invented spellings, by position; the labels they stand for are in registry/oracles.py.
CATEGORIES = (
    "Ração|Racao|RAÇÃO|RACAO|racao|ração|Ração Seca|RACAO UMIDA"
    "|Medicamento|MEDICAMENTO|Medicamentos|Ração Medicamentosa|RACAO MEDICAMENTOSA|med."
    "|Petisco|PETISCO|Petiscos|petisco|Petisco Ração"
    "|Higiene|HIGIENE|higiene|Hig.|Higiene e Limpeza"
    "|Brinquedo|BRINQUEDO|Brinquedos|brinq|Brinq."
    "|Acessório|Acessorio|ACESSÓRIO|acessorios"
    "|Serviço|Servico|SERVIÇO|servicos"
).split("|")
CHANNELS = (
    "App|APP|app| App |Aplicativo App|Site|SITE|site|Site |web site"
    "|Loja Física|LOJA FISICA|loja|Loja|Telefone|TEL|tel.|WhatsApp|WHATSAPP|"
).split("|")
DISCOUNTS = "S|s|Sim|SIM|sim|1|X|x|True|N|n|Nao|NAO|0|False|Não|".split("|")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spelling(names: list[str], position: str) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), F.expr(f"cast({position} as int) + 1"))


# Text of a moment as 09/01/2023 10:07 AM, from its fields and so free of time zones.
_US_TEXT = (
    "concat(lpad(month({t}), 2, '0'), '/', lpad(day({t}), 2, '0'), '/', year({t}), ' ',"
    " lpad((hour({t}) + 11) % 12 + 1, 2, '0'), ':', lpad(minute({t}), 2, '0'),"
    " if(hour({t}) < 12, ' AM', ' PM'))"
)
_MONEY_TEXT = "translate(format_number(a, 2), ',.', '.,')"


def _order_moments(orders: DataFrame) -> DataFrame:
    moments = orders.selectExpr(
        "o_orderkey as k",
        "o_custkey",
        "cast(o_totalprice as decimal(15,2)) as a",
        "cast(o_orderdate as timestamp_ntz) + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int)) as t",
    )
    moments = moments.selectExpr("*", "t + make_dt_interval(cast(k % 3 as int)) as e")
    moments = moments.selectExpr("*", "date_add(cast(e as date), cast(k % 5 as int)) as d1")
    moments = moments.selectExpr("*", "date_add(d1, cast((k div 5) % 3 as int)) as d2")
    moments = moments.selectExpr("*", "date_add(d2, cast((k div 15) % 9 as int)) as d3")
    return moments.selectExpr("*", "date_add(d3, cast((k div 135) % 4 as int)) as d4")


_ORDER_TEXT = {
    "NumeroPedido": "concat('PED-', lpad(k, 15, '0'))",
    "DtHoraPedido": _US_TEXT.format(t="t"),
    "DtHoraIntegracaoERP": _US_TEXT.format(t="e"),
    "Dt Separacao Estoque": "if(k % 10 < 2, '', cast(d1 as string))",
    "DtNotaFiscal": "if(k % 10 < 3, '', cast(d2 as string))",
    "Dt_Despacho_Transportadora": "if(k % 10 < 4, '', cast(d3 as string))",
    "DtEntregaCliente": "if(k % 10 < 5, '', cast(d4 as string))",
    "QTD.Itens": "case k % 16 when 3 then '' when 11 then '-' else concat(' ', 1 + k % 9) end",
    "ValorLiquidoPedido(R$)": (
        f"case k % 6 when 0 then concat('R$ ', {_MONEY_TEXT})"
        " when 1 then cast(a as string)"
        " when 2 then translate(format_number(floor(a), 0), ',', '.')"
        " when 3 then translate(cast(a as string), '.', ',')"
        " when 4 then cast(floor(a) as string)"
        " else if(k % 12 = 5, '', '-') end"
    ),
    "Loja-Nome": (
        "case when k % 1000 = 7 then '' else case k % 7"
        " when 0 then base when 1 then lower(base) when 2 then concat(base, '/SC')"
        " when 3 then replace(base, ' ', '  ') when 4 then translate(base, 'AO', 'ÁÕ')"
        " when 5 then concat('  ', base, ' ') else replace(base, 'NATION', 'NATIUM') end end"
    ),
    "Cod Loja": "if(k % 5 < 2, '', concat('LJ-', lpad(n_nationkey + 1, 3, '0')))",
}
_SPELLED = {
    "CategoriaProduto": (CATEGORIES, "k % 37"),
    "HouveDesconto": (DISCOUNTS, "(k div 7) % 17"),
    "CanalPedido": (CHANNELS, "(k div 37) % 20"),
}


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order staging: text under the shop system's own headers."""
    moments = _order_moments(table(spark, sf_dir, "orders"))
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "concat('LOJA ', n_name) as base")
    placed = moments.join(nations, F.expr("o_custkey % 25") == nations["n_nationkey"], "left")
    texts = {name: F.expr(text) for name, text in _ORDER_TEXT.items()}
    texts |= {name: _spelling(*choice) for name, choice in _SPELLED.items()}
    return placed.select(*[texts[header].alias(header) for header in ORDER_HEADERS])


# Unreadable texts by order number, in place of what stands there: column, which orders, text.
FAULTS = [
    ("dt_hora_pedido", "k % 101 = 3", "'31/12/1995 10:00 AM'"),
    ("dt_hora_integracao_erp", "k % 103 = 4", "'1995-12-31 10:00'"),
    ("dt_separacao_estoque", "k % 107 = 5", "'1995-02-30'"),
    ("dt_nota_fiscal", "k % 109 = 6", "'31/12/1995'"),
    ("dt_despacho_transportadora", "k % 113 = 7", "'1995-03-01 99:99'"),
    ("dt_entrega_cliente", "k % 127 = 8", "'1995-03-01 25:00:00'"),
    ("qtd_itens", "k % 131 = 9", "concat(k % 9, ' cx')"),
    ("qtd_itens", "k % 131 = 10", "'99999999999'"),
    ("valor_liquido_pedido", "k % 137 = 11", "concat('US$ ', k)"),
    ("valor_liquido_pedido", "k % 137 = 12", "'1,000.000.000,00'"),
    ("valor_liquido_pedido", "k % 137 = 13", "'12345678901234567'"),
]


def with_faults(orders: DataFrame) -> DataFrame:
    """The order staging with ``FAULTS`` planted."""
    rows = orders.selectExpr("*", "cast(substring(numero_pedido, 5) as bigint) as k")
    texts = {}
    for column, which, text in FAULTS:
        texts[column] = F.when(F.expr(which), F.expr(text)).otherwise(texts.get(column, F.col(column)))
    return rows.withColumns(texts).drop("k")


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw store-by-territory staging: stores with an even key serve two regions, others one."""
    regions = table(spark, sf_dir, "region")
    shares = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey",
        "inline(if(n_nationkey % 2 = 0,"
        " array(struct(n_regionkey as r, '0,85' as p), struct((n_regionkey + 1) % 5 as r, '0,15' as p)),"
        " array(struct(n_regionkey as r, '1,00' as p))))",
    )
    return shares.join(regions, shares["r"] == regions["r_regionkey"]).selectExpr(
        "concat('LJ-', lpad(n_nationkey + 1, 3, '0')) as CodLoja",
        "concat('PR-', r) as CodPraca",
        "concat('Praca ', r_name) as NomePraca",
        "if(r < 3, 'Norte', 'Sul') as Regional",
        "translate(format_number((r + 1) * 37000, 0), ',', '.') as DomiciliosComPet",
        "p as PercentualPublico",
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given store dimension, without its unknown member."""
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation")
    facts = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).selectExpr(
        "n_nationkey + 1 as sk_loja",
        "concat('LJ-', lpad(n_nationkey + 1, 3, '0')) as cod_loja",
        "concat('LOJA ', upper(n_name)) as chave_loja",
        "concat('Loja ', n_name) as nome_loja",
        "n_name as cidade",
        "'SC' as uf",
        "r_name as mesorregiao",
        "if(n_nationkey = 24, 0, (n_nationkey + 1) * 10000) as populacao_cidade",
        "if(n_nationkey = 2, 150, 100 + 20 * n_nationkey) as area_venda_m2",
        "element_at(array('Ouro', 'Prata', 'Bronze', 'Diamante'), n_nationkey % 4 + 1) as faixa_franquia",
        "element_at(array('Padrao', 'Completa', 'Megastore'), n_nationkey % 3 + 1) as formato_loja",
    )
    return facts.withColumn("porte", size_band(F.col("area_venda_m2")))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known misspelt store keys and the key each stands for."""
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('LOJA ', replace(upper(n_name), 'NATION', 'NATIUM')) as apelido",
        "concat('LOJA ', upper(n_name)) as chave_loja",
    )


def write_staging(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the two text tables."""
    with split_methods(spark):
        orders(spark, sf_dir).write.mode("overwrite").parquet(f"{folder}/stg_pedido")
    territories(spark, sf_dir).write.mode("overwrite").parquet(f"{folder}/stg_loja_praca")


def read_staging(spark: SparkSession, sf_dir: str, folder: str) -> Staging:
    """All that a load needs."""
    return Staging(
        read_orders(spark, f"{folder}/stg_pedido"),
        read_territories(spark, f"{folder}/stg_loja_praca"),
        stores(spark, sf_dir),
        aliases(spark, sf_dir),
    )
