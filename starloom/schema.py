"""Column names and types of the staging tables and of the star.

Fixed values: every name and label in this file is part of the data model that
users' own queries rely on, so it is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Nao Informado"
UNKNOWN_CODE = "N/I"

# Staging header -> column name used inside the library.
ORDER_HEADERS = {
    "NumeroPedido": "numero_pedido",
    "DtHoraPedido": "dt_hora_pedido",
    "DtHoraIntegracaoERP": "dt_hora_integracao_erp",
    "Dt Separacao Estoque": "dt_separacao_estoque",
    "DtNotaFiscal": "dt_nota_fiscal",
    "Dt_Despacho_Transportadora": "dt_despacho_transportadora",
    "DtEntregaCliente": "dt_entrega_cliente",
    "Loja-Nome": "loja_nome",
    "Cod Loja": "cod_loja",
    "CategoriaProduto": "categoria_produto",
    "HouveDesconto": "houve_desconto",
    "CanalPedido": "canal_pedido",
    "QTD.Itens": "qtd_itens",
    "ValorLiquidoPedido(R$)": "valor_liquido_pedido",
}
TERRITORY_HEADERS = {
    "CodLoja": "cod_loja",
    "CodPraca": "cod_praca",
    "NomePraca": "nome_praca",
    "Regional": "regional",
    "DomiciliosComPet": "domicilios_com_pet",
    "PercentualPublico": "percentual_publico",
}

MONEY = T.DecimalType(15, 2)
FACTOR = T.DecimalType(6, 4)

# The five stored lags, in process order, the last one being the total.
STEP_LAGS = [
    "dias_integracao_separacao",
    "dias_separacao_nota",
    "dias_nota_despacho",
    "dias_despacho_entrega",
]
TOTAL_LAG = "dias_total_ate_entrega"
LAGS = [*STEP_LAGS, TOTAL_LAG]


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_int, _text = T.IntegerType(), T.StringType()

DIM_TEMPO = _table(
    sk_tempo=_int,
    data=T.DateType(),
    ano=_int,
    mes=_int,
    dia=_int,
    ano_mes=_text,
    nome_mes=_text,
    trimestre=_int,
    dia_semana=_text,
    fim_de_semana=_text,
)
DIM_LOJA = _table(
    sk_loja=_int,
    cod_loja=_text,
    chave_loja=_text,
    nome_loja=_text,
    cidade=_text,
    uf=_text,
    mesorregiao=_text,
    populacao_cidade=_int,
    area_venda_m2=_int,
    porte=_text,
    faixa_franquia=_text,
    formato_loja=_text,
)
DIM_CATEGORIA = _table(
    sk_categoria=_int, categoria_origem=_text, nome_categoria=_text, grupo_categoria=_text
)
DIM_PRACA = _table(
    sk_praca=_int, cod_praca=_text, nome_praca=_text, regional=_text, domicilios_com_pet=_int
)
BRIDGE_LOJA_PRACA = _table(cod_loja=_text, sk_praca=_int, fator_publico=FACTOR)
FATO_PEDIDO = _table(
    sk_pedido=T.LongType(),
    numero_pedido=_text,
    sk_tempo_pedido=_int,
    sk_tempo_entrega=_int,
    sk_loja=_int,
    sk_categoria=_int,
    houve_desconto=_text,
    canal_pedido=_text,
    dt_pedido=T.TimestampNTZType(),
    qt_itens=_int,
    vl_liquido=MONEY,
    **{lag: _int for lag in LAGS},
)

LOJA_CHAVE = _table(chave_loja=_text, sk_loja=_int)

STAR = {
    "dim_tempo": DIM_TEMPO,
    "dim_loja": DIM_LOJA,
    "dim_categoria": DIM_CATEGORIA,
    "dim_praca": DIM_PRACA,
    "bridge_loja_praca": BRIDGE_LOJA_PRACA,
    "fato_pedido": FATO_PEDIDO,
    "loja_chave": LOJA_CHAVE,
}

# A fact numbered as it is read: its files hold a row's place in the write, and a table beside them the rows before each task.
PLACE = T.StructField("lugar", T.LongType())
TASKS = _table(tarefa=T.LongType(), antes=T.LongType())
# The month of a fact row, by which the monthly fact's folders are named.
MONTH = T.StructField("ano_mes", _text)

# Texts that a lenient load could not read, and the rule each breaks. A row of the fact's files also holds its own, as a list.
REJECT = _table(coluna=_text, texto=_text, regra=_text)
REJECTS = {
    "rejeito_pedido": T.StructType([T.StructField("numero_pedido", _text), *REJECT]),
    "rejeito_praca": T.StructType([T.StructField("cod_loja", _text), T.StructField("cod_praca", _text), *REJECT]),
}
REJECT_LIST = T.StructField("rejeitos", T.ArrayType(REJECT))

# The longest text each column is declared to hold.
LENGTHS = {
    "dim_tempo": {"ano_mes": 7, "nome_mes": 15, "dia_semana": 15, "fim_de_semana": 3},
    "dim_loja": {
        "cod_loja": 10,
        "chave_loja": 80,
        "nome_loja": 80,
        "cidade": 60,
        "uf": 3,
        "mesorregiao": 40,
        "porte": 20,
        "faixa_franquia": 15,
        "formato_loja": 20,
    },
    "dim_categoria": {"categoria_origem": 50, "nome_categoria": 30, "grupo_categoria": 20},
    "dim_praca": {"cod_praca": 10, "nome_praca": 60, "regional": 30},
    "bridge_loja_praca": {"cod_loja": 10},
    "fato_pedido": {"numero_pedido": 20, "houve_desconto": 15, "canal_pedido": 20},
}

# Attributes of the -1 member that are not simply UNKNOWN_LABEL.
UNKNOWN_MEMBERS = {
    "dim_tempo": {
        "data": None, "ano": None, "mes": None, "dia": None, "trimestre": None,
        "ano_mes": UNKNOWN_CODE, "fim_de_semana": UNKNOWN_CODE,
    },
    "dim_loja": {
        "cod_loja": UNKNOWN_CODE, "chave_loja": "NAO INFORMADO", "uf": UNKNOWN_CODE,
        "populacao_cidade": None, "area_venda_m2": None,
    },
    "dim_categoria": {},
    "dim_praca": {"cod_praca": UNKNOWN_CODE, "domicilios_com_pet": 0},
}
