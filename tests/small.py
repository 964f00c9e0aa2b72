"""A star small enough to add up by hand."""

from decimal import Decimal

from starloom.plans.load import Star
from starloom.schema import LAGS, STAR, UNKNOWN_MEMBERS

NI = "Nao Informado"


def money(text):
    return None if text is None else Decimal(text)


def table(spark, name, rows):
    """Rows given as dicts; what is left out is NULL."""
    schema = STAR[name]
    return spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in rows], schema)


def store(sk, porte, tier="Ouro", population=1000, code=None):
    return {
        "sk_loja": sk,
        "cod_loja": code or f"LJ-{sk}",
        "chave_loja": f"LOJA {sk}",
        "nome_loja": f"Loja {sk}",
        "cidade": f"Cidade {sk}",
        "porte": porte,
        "faixa_franquia": tier,
        "populacao_cidade": population,
    }


def category(sk, name, spelling=None):
    return {"sk_categoria": sk, "categoria_origem": spelling or name, "nome_categoria": name}


def order(number, store_key=1, category_key=1, value=None, items=None, lags=(), discount="Sim", channel="App"):
    row = {
        "sk_pedido": number,
        "numero_pedido": f"P{number}",
        "sk_tempo_pedido": 20240101,
        "sk_tempo_entrega": 20240102 if len(lags) == 5 and lags[4] is not None else -1,
        "sk_loja": store_key,
        "sk_categoria": category_key,
        "houve_desconto": discount,
        "canal_pedido": channel,
        "qt_itens": items,
        "vl_liquido": money(value),
    }
    return row | dict(zip(LAGS, lags, strict=False))


UNKNOWN_STORE = {**store(-1, NI, NI, None, "N/I"), "nome_loja": NI, "chave_loja": "NAO INFORMADO"}
UNKNOWN_CATEGORY = category(-1, NI)


def star(spark, orders, stores, categories, territories=(), bridge=()):
    days = [{"sk_tempo": sk} for sk in (-1, 20240101, 20240102)]
    unknown_territory = {"sk_praca": -1, "nome_praca": NI, **UNKNOWN_MEMBERS["dim_praca"]}
    known_stores = [UNKNOWN_STORE, *stores]
    return Star(
        table(spark, "dim_tempo", days),
        table(spark, "dim_loja", known_stores),
        table(spark, "dim_categoria", [UNKNOWN_CATEGORY, *categories]),
        table(spark, "dim_praca", [unknown_territory, *territories]),
        table(spark, "bridge_loja_praca", bridge),
        table(spark, "fato_pedido", orders),
        table(spark, "loja_chave", known_stores),
    )
