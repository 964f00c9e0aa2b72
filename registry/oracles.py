"""The registered queries in SQL, from the undamaged columns of the given tables.

No text is cleaned here. What a cleaner should find is known from how the dirty text
was made: the clean value itself, or the label that stands at the spelling's place.
"""

from __future__ import annotations

from registry.derived import CATEGORIES, CHANNELS, DISCOUNTS


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + value + "'" for value in values) + "]"


# Labels by the place of their spelling.
CATEGORY_LABELS = (
    ["Racao"] * 8
    + ["Medicamento"] * 6
    + ["Petisco"] * 5
    + ["Higiene"] * 5
    + ["Brinquedo"] * 5
    + ["Acessorio"] * 4
    + ["Servico"] * 4
)
GROUP_LABELS = (
    ["Alimentacao"] * 8
    + ["Saude e Higiene"] * 6
    + ["Alimentacao"] * 5
    + ["Saude e Higiene"] * 5
    + ["Bem-estar"] * 13
)
CHANNEL_LABELS = (
    ["App"] * 5
    + ["Site"] * 5
    + ["Loja Fisica"] * 4
    + ["Telefone"] * 3
    + ["WhatsApp"] * 2
    + ["Nao Informado"]
)
DISCOUNT_LABELS = ["Sim"] * 9 + ["Nao"] * 6 + ["Nao Informado"] * 2

# One row per order with every clean value. d1 to d4 are the milestone days, blank or not.
_ORDERS = f"""
o AS (
  SELECT o_orderkey AS k, o_custkey AS c,
         'PED-' || lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS numero_pedido,
         CAST(o_totalprice AS DECIMAL(15,2)) AS a,
         o_orderdate + to_minutes(o_orderkey % 1440) AS t
  FROM orders
),
f AS (
  SELECT k, numero_pedido, a, t, t + to_days(CAST(k % 3 AS INTEGER)) AS e, n_name,
         n_nationkey AS n,
         CASE WHEN k % 1000 = 7 OR n_nationkey IS NULL THEN -1 ELSE n_nationkey + 1 END AS sk_loja,
         ({_list(CATEGORIES)})[k % 37 + 1] AS categoria_origem,
         ({_list(CATEGORY_LABELS)})[k % 37 + 1] AS nome_categoria,
         ({_list(DISCOUNT_LABELS)})[(k // 7) % 17 + 1] AS houve_desconto,
         ({_list(CHANNEL_LABELS)})[(k // 37) % 20 + 1] AS canal_pedido,
         CASE WHEN k % 16 IN (3, 11) THEN NULL ELSE CAST(1 + k % 9 AS INTEGER) END AS qt_itens,
         CAST(CASE WHEN k % 6 = 5 THEN NULL WHEN k % 6 IN (2, 4) THEN 100 * floor(a)
              ELSE 100 * a END AS BIGINT) AS cents,
         CAST(CASE WHEN k % 10 >= 2 THEN k % 5 END AS INTEGER) AS l1,
         CAST(CASE WHEN k % 10 >= 3 THEN (k // 5) % 3 END AS INTEGER) AS l2,
         CAST(CASE WHEN k % 10 >= 4 THEN (k // 15) % 9 END AS INTEGER) AS l3,
         CAST(CASE WHEN k % 10 >= 5 THEN (k // 135) % 4 END AS INTEGER) AS l4,
         CAST(CASE WHEN k % 10 >= 5 THEN k % 5 + (k // 5) % 3 + (k // 15) % 9 + (k // 135) % 4 END
              AS INTEGER) AS lt
  FROM o LEFT JOIN nation ON n_nationkey = c % 25
)"""

_STORES = """
loja AS (
  SELECT n_nationkey + 1 AS sk_loja, 'LJ-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS cod_loja,
         'LOJA ' || n_name AS chave_loja, 'Loja ' || n_name AS nome_loja, n_name AS cidade, 'SC' AS uf,
         r_name AS mesorregiao,
         CASE WHEN n_nationkey = 24 THEN 0 ELSE (n_nationkey + 1) * 10000 END AS populacao_cidade,
         CASE WHEN n_nationkey = 2 THEN 150 ELSE 100 + 20 * n_nationkey END AS area_venda_m2,
         CASE WHEN n_nationkey IN (0, 1) THEN 'Pequena' WHEN n_nationkey < 16 THEN 'Media'
              ELSE 'Grande' END AS porte,
         (['Ouro', 'Prata', 'Bronze', 'Diamante'])[n_nationkey % 4 + 1] AS faixa_franquia,
         (['Padrao', 'Completa', 'Megastore'])[n_nationkey % 3 + 1] AS formato_loja
  FROM nation JOIN region ON r_regionkey = n_regionkey
)"""

# Shares in hundredths.
_BRIDGE = """
ponte AS (
  SELECT n_nationkey + 1 AS sk_loja, n_regionkey AS r, CASE n_nationkey % 2 WHEN 0 THEN 85 ELSE 100 END AS w
  FROM nation
  UNION ALL
  SELECT n_nationkey + 1, (n_regionkey + 1) % 5, 15 FROM nation WHERE n_nationkey % 2 = 0
),
praca AS (
  SELECT r_regionkey AS r, 'PR-' || r_regionkey AS cod_praca, 'Praca ' || r_name AS nome_praca,
         CASE WHEN r_regionkey < 3 THEN 'Norte' ELSE 'Sul' END AS regional,
         (r_regionkey + 1) * 37000 AS domicilios_com_pet
  FROM region
)"""


# The months that are loaded again.
_RELOADED = "(year(t) = 1995 AND month(t) <= 3)"


def _sql(body: str, *parts: str) -> str:
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _ratio(top: str, bottom: str, places: int = 2) -> str:
    """Whole-number quotient rounded half away from zero, as a double."""
    one = 10**places
    size = f"((2 * {one} * abs({top}) + abs({bottom})) // nullif(2 * abs({bottom}), 0)) / {float(one)}"
    return f"CAST(sign({top}) * sign({bottom}) * ({size}) AS DOUBLE)"


def _mean(lag: str) -> str:
    return _ratio(f"sum({lag})", f"count({lag})")


def _money(cents: str) -> str:
    return f"CAST(({cents}) / 100.0 AS DOUBLE)"


def _count(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def _share(part: str, whole: str) -> str:
    return _ratio(f"(100 * {part})", whole)


_STEPS = ["integracao_separacao", "separacao_nota", "nota_despacho", "despacho_entrega"]
_MEANS = ", ".join(
    f"{_mean(lag)} AS media_{name}"
    for lag, name in zip(["l1", "l2", "l3", "l4", "lt"], [*_STEPS, "total_ate_entrega"], strict=True)
)
_STEP_MEANS = ", ".join(
    f"{_mean(lag)} AS {name}" for lag, name in zip(["l1", "l2", "l3", "l4"], _STEPS, strict=True)
)


def _each_step(source: str, labels: list[str], key: str = "") -> str:
    lead = f"{key}, " if key else ""
    tail = f" GROUP BY {key}" if key else ""
    return " UNION ALL ".join(
        f"SELECT {lead}{place} AS ordem, '{label}' AS etapa, {_mean(f'l{place}')} AS media_dias,"
        f" sum(l{place})::DOUBLE / count(l{place}) AS media FROM {source}{tail}"
        for place, label in enumerate(labels, 1)
    )


_WITH = "houve_desconto = 'Sim'"
_WITHOUT = "houve_desconto = 'Nao'"
_TICKETS = f"""
g AS (
  SELECT canal_pedido, count(*) AS n, sum(cents) AS s,
         sum(CASE WHEN {_WITH} THEN cents END) AS sc, count(CASE WHEN {_WITH} THEN cents END) AS nc,
         sum(CASE WHEN {_WITHOUT} THEN cents END) AS ss, count(CASE WHEN {_WITHOUT} THEN cents END) AS ns,
         {_count(_WITH)} AS pc, {_count(_WITHOUT)} AS ps
  FROM f GROUP BY canal_pedido
)"""
_TICKET_WITH = _ratio("sc", "(100 * nc)")
_TICKET_WITHOUT = _ratio("ss", "(100 * ns)")
_TICKET_GAP = _ratio("(sc * ns - ss * nc)", "(100 * nc * ns)")

_CATEGORY_GROUPS = """
g AS (
  SELECT porte, nome_categoria, sum(cents) AS s FROM f JOIN loja USING (sk_loja)
  GROUP BY porte, nome_categoria
)"""
_ALLOCATED = """
g AS (
  SELECT r, sum(cents * w) AS s FROM f JOIN ponte USING (sk_loja) GROUP BY r
)"""


def _checks(rows: list[tuple[str, str, str | None]], source: str = "") -> str:
    """``teste, valor, esperado, ok`` rows from (test, value, expected)."""
    parts = []
    for test, value, expected in rows:
        wanted = f"CAST({expected if expected is not None else 'NULL'} AS BIGINT)"
        parts.append(
            f"SELECT '{test}' AS teste, CAST({value} AS BIGINT) AS valor, {wanted} AS esperado,"
            f" CAST({value} AS BIGINT) = {wanted} AS ok {source}"
        )
    return " UNION ALL ".join(parts)


_LAST_DAY = (
    "(SELECT max(CASE WHEN lt IS NULL THEN CAST(t AS DATE)"
    " ELSE greatest(CAST(t AS DATE), CAST(e AS DATE) + lt) END) FROM f)"
)
_DAYS = f"({_LAST_DAY} - (SELECT CAST(min(t) AS DATE) FROM f) + 2)"

# The number of different store texts, counted over the parts they are made of: the store
# and the way of writing it, or nothing at all.
_STORE_TEXTS = (
    "(SELECT count(DISTINCT CASE WHEN k % 1000 = 7 THEN '' ELSE n_name || '/' || (k % 7) END) FROM f"
    " WHERE n_name IS NOT NULL OR k % 1000 = 7)"
)

_ROW_COUNTS = [
    ("stg_pedido", "(SELECT count(*) FROM orders)", None),
    ("stg_loja", "(SELECT count(*) FROM nation)", "25"),
    ("stg_loja_praca", "(SELECT count(*) FROM ponte)", "38"),
    ("dim_tempo", _DAYS, None),
    ("dim_loja", "(SELECT count(*) + 1 FROM nation)", "26"),
    ("dim_categoria", "(SELECT count(DISTINCT k % 37) + 1 FROM f)", "38"),
    ("dim_praca", "(SELECT count(*) + 1 FROM region)", "6"),
    ("bridge_loja_praca", "(SELECT count(*) FROM ponte)", "38"),
    ("fato_pedido", "(SELECT count(*) FROM f)", None),
]
_SPELLING_COUNTS = [
    ("grafias de categoria", "(SELECT count(DISTINCT k % 37) FROM f)", "37"),
    ("grafias de nome de loja", _STORE_TEXTS, None),
    ("grafias de desconto", "(SELECT count(DISTINCT (k // 7) % 17) FROM f)", "17"),
    ("grafias de canal", "(SELECT count(DISTINCT (k // 37) % 20) FROM f)", "20"),
    ("pedidos sem codigo de loja", "(SELECT count(*) FROM f WHERE k % 5 < 2)", None),
    ("pedidos sem nome de loja", "(SELECT count(*) FROM f WHERE k % 1000 = 7)", None),
]
_BLANKS = [
    (name, f"(SELECT count(*) FROM f WHERE l{place} IS NULL)", None)
    for place, name in enumerate(
        ["dt_separacao_estoque", "dt_nota_fiscal", "dt_despacho_transportadora", "dt_entrega_cliente"], 1
    )
]
_MASK = [("mascara americana", "(SELECT count(t) FROM f)", None)]
_MASK_ALONE = [("mascara americana", "(SELECT count(t) FROM f)", "(SELECT count(*) FROM orders)")]
_OFF_MASK = [("horas fora da mascara", "(SELECT count(*) FROM f WHERE t IS NULL)", "0")]
# Amounts are written by rules that use neither the American form nor a sign.
_MONEY_AUDIT = [
    ("valores com ponto depois de virgula", "(SELECT count(*) FROM f WHERE k % 6 NOT IN (0, 1, 2, 3, 4, 5))", None),
    ("valores negativos", "(SELECT count(*) FROM f WHERE cents < 0)", None),
    ("valores ilegiveis", "(SELECT count(*) FROM f WHERE a IS NOT NULL AND cents IS NULL AND k % 6 <> 5)", "0"),
]
_CHANNEL = [("canal WhatsApp ausente", "(SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM f WHERE canal_pedido = 'WhatsApp')", "0")]
_UNRESOLVED = [
    ("pedidos sem loja", "(SELECT count(*) FROM f WHERE sk_loja = -1)", None),
    ("entregas nao feitas", "(SELECT count(*) FROM f WHERE lt IS NULL)", None),
]
_DOMAIN = [("categorias padronizadas", "(SELECT count(DISTINCT nome_categoria) + 1 FROM f)", "8")]
_COVERAGE = [
    ("lojas na ponte", "(SELECT count(DISTINCT sk_loja) FROM ponte)", "25"),
    ("pracas na ponte", "(SELECT count(DISTINCT r) FROM ponte)", "5"),
]
_UNKNOWN_ROWS = [
    (f"linha -1 de {dim}", "1", "1") for dim in ["dim_tempo", "dim_loja", "dim_categoria", "dim_praca"]
]
_FK = [("FK nula", "(SELECT count(*) FROM f WHERE sk_loja IS NULL OR t IS NULL)", "0")] + [
    (f"FK orfa ({name})", "0", "0") for name in ["loja", "categoria", "tempo do pedido", "tempo da entrega"]
]
# Days outside a calendar that ends with 1997.
_LATE = "CAST('1997-12-31' AS DATE)"
_DATE_ORPHANS = _FK[:3] + [
    ("FK orfa (tempo do pedido)", f"(SELECT count(*) FROM f WHERE CAST(t AS DATE) > {_LATE})", "0"),
    ("FK orfa (tempo da entrega)", f"(SELECT count(*) FROM f WHERE CAST(e AS DATE) + lt > {_LATE})", "0"),
]
_NEGATIVE = [("dias negativos", "(SELECT count(*) FROM f WHERE least(l1, l2, l3, l4, lt) < 0)", "0")]
_REPEATED = "(SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1))"
_UNIQUE = [
    (f"chave repetida em {name}", "0", "0")
    for name in ["dim_tempo", "dim_loja", "dim_categoria", "dim_praca", "bridge_loja_praca", "fato_pedido"]
] + [
    ("chave repetida em numero_pedido", _REPEATED, "0"),
    ("chave natural repetida em loja_chave", "(SELECT count(*) - count(DISTINCT n_name) FROM nation)", "0"),
    ("chave natural repetida em dim_categoria", "0", "0"),
    ("chave natural repetida em dim_praca", "(SELECT count(*) - count(DISTINCT r_regionkey) FROM region)", "0"),
]
_LENGTHS = [
    ("texto longo em dim_tempo", "0", "0"),
    ("texto longo em dim_loja", "(SELECT count(*) FROM nation WHERE length(n_name) > 60)", "0"),
    ("texto longo em dim_categoria", "(SELECT count(*) FROM f WHERE length(categoria_origem) > 50)", "0"),
    ("texto longo em dim_praca", "(SELECT count(*) FROM region WHERE length(r_name) > 54)", "0"),
    ("texto longo em bridge_loja_praca", "0", "0"),
    ("texto longo em fato_pedido", "(SELECT count(*) FROM f WHERE length(numero_pedido) > 20)", "0"),
]
_DATES = [
    ("primeiro pedido", "(SELECT CAST(strftime(min(t), '%Y%m%d') AS BIGINT) FROM f)", None),
    ("ultimo pedido", "(SELECT CAST(strftime(max(t), '%Y%m%d') AS BIGINT) FROM f)", None),
]
_NOTHING_LOST = [
    (name, "0", "0")
    for name in [
        "grafias sem categoria",
        "ordem das regras",
        "lojas com fator diferente de 1",
        "pedidos perdidos ou repetidos",
        "total perdido na juncao de categoria",
        "rateio sem fechar",
    ]
]

_US = "strftime({t}, '%m/%d/%Y %I:%M %p')"


def _staging_text() -> str:
    day = "CAST(e AS DATE)"
    days = ["k % 5", "(k // 5) % 3", "(k // 15) % 9", "(k // 135) % 4"]
    columns = [
        "numero_pedido",
        f"{_US.format(t='t')} AS dt_hora_pedido",
        f"{_US.format(t='e')} AS dt_hora_integracao_erp",
    ]
    names = ["dt_separacao_estoque", "dt_nota_fiscal", "dt_despacho_transportadora", "dt_entrega_cliente"]
    for place, name in enumerate(names, 1):
        total = " + ".join(days[:place])
        columns.append(
            f"CASE WHEN l{place} IS NULL THEN '' ELSE CAST({day} + CAST({total} AS INTEGER) AS VARCHAR) END AS {name}"
        )
    whole = "CAST(floor(a) AS BIGINT)"
    grouped = "translate(format('{:,}', " + whole + "), ',', '.')"
    columns += [
        "CASE WHEN k % 1000 = 7 THEN '' ELSE CASE k % 7 WHEN 0 THEN b WHEN 1 THEN lower(b)"
        " WHEN 2 THEN b || '/SC' WHEN 3 THEN replace(b, ' ', '  ') WHEN 4 THEN translate(b, 'AO', 'ÁÕ')"
        " WHEN 5 THEN '  ' || b || ' ' ELSE replace(b, 'NATION', 'NATIUM') END END AS loja_nome",
        "CASE WHEN k % 5 < 2 THEN '' ELSE 'LJ-' || lpad(CAST(n + 1 AS VARCHAR), 3, '0') END AS cod_loja",
        "categoria_origem AS categoria_produto",
        f"({_list(DISCOUNTS)})[(k // 7) % 17 + 1] AS houve_desconto",
        f"({_list(CHANNELS)})[(k // 37) % 20 + 1] AS canal_pedido",
        "CASE k % 16 WHEN 3 THEN '' WHEN 11 THEN '-' ELSE ' ' || (1 + k % 9) END AS qtd_itens",
        "CASE k % 6 WHEN 0 THEN 'R$ ' || translate(format('{:,.2f}', CAST(a AS DOUBLE)), ',.', '.,')"
        f" WHEN 1 THEN CAST(a AS VARCHAR) WHEN 2 THEN {grouped}"
        f" WHEN 3 THEN replace(CAST(a AS VARCHAR), '.', ',') WHEN 4 THEN CAST({whole} AS VARCHAR)"
        " ELSE CASE WHEN k % 12 = 5 THEN '' ELSE '-' END END AS valor_liquido_pedido",
    ]
    return _sql(
        f"SELECT {', '.join(columns)} FROM (SELECT *, 'LOJA ' || n_name AS b FROM f)",
        _ORDERS,
    )


_WEEKDAYS = _list(["Domingo", "Segunda", "Terca", "Quarta", "Quinta", "Sexta", "Sabado"])
_MONTHS = _list(
    "Janeiro Fevereiro Marco Abril Maio Junho Julho Agosto Setembro Outubro Novembro Dezembro".split()
)
_N = "Nao Informado"


def _cleaner_oracles() -> dict[str, str]:
    per_order = {
        "parse_money": f"{_money('cents')} AS vl_liquido",
        "parse_quantity": "qt_itens",
        "parse_timestamp": "t AS dt_pedido",
        "date_keys": (
            "CAST(strftime(t, '%Y%m%d') AS INTEGER) AS sk_tempo_pedido,"
            " CAST(CASE WHEN lt IS NULL THEN '-1' ELSE strftime(CAST(e AS DATE) + lt, '%Y%m%d') END AS INTEGER)"
            " AS sk_tempo_entrega"
        ),
        "milestone_lags": (
            "l1 AS dias_integracao_separacao, l2 AS dias_separacao_nota, l3 AS dias_nota_despacho,"
            " l4 AS dias_despacho_entrega, lt AS dias_total_ate_entrega"
        ),
        "store_name_key": (
            "CASE WHEN k % 1000 = 7 THEN '' WHEN k % 7 = 6 THEN 'LOJA NATIUM_' || n"
            " ELSE 'LOJA ' || n_name END AS chave_loja"
        ),
        "store_alias": (
            "CASE WHEN sk_loja = -1 THEN 'NAO INFORMADO' ELSE 'LOJA ' || n_name END AS chave_loja"
        ),
        "lookup_category": "categoria_origem, nome_categoria",
        "lookup_store": "sk_loja",
        "fact_orders": (
            "CAST(strftime(t, '%Y%m%d') AS INTEGER) AS sk_tempo_pedido,"
            " CAST(CASE WHEN lt IS NULL THEN '-1' ELSE strftime(CAST(e AS DATE) + lt, '%Y%m%d') END AS INTEGER)"
            " AS sk_tempo_entrega, sk_loja, categoria_origem, houve_desconto, canal_pedido, t AS dt_pedido,"
            f" qt_itens, {_money('cents')} AS vl_liquido,"
            " l1 AS dias_integracao_separacao, l2 AS dias_separacao_nota, l3 AS dias_nota_despacho,"
            " l4 AS dias_despacho_entrega, lt AS dias_total_ate_entrega"
        ),
    }
    found = {
        name: _sql(f"SELECT numero_pedido, {columns} FROM f", _ORDERS) for name, columns in per_order.items()
    }
    for name, raw, column, place, spelled, labels in [
        ("std_category", "categoria_produto", "nome_categoria", "k % 37", CATEGORIES, CATEGORY_LABELS),
        ("std_category_group", "categoria_produto", "grupo_categoria", "k % 37", CATEGORIES, GROUP_LABELS),
        ("std_channel", "canal_pedido", "canal", "(k // 37) % 20", CHANNELS, CHANNEL_LABELS),
        ("std_discount", "houve_desconto", "desconto", "(k // 7) % 17", DISCOUNTS, DISCOUNT_LABELS),
    ]:
        found[name] = _sql(
            f"SELECT ({_list(spelled)})[p + 1] AS {raw}, ({_list(labels)})[p + 1] AS {column},"
            f" count(*) AS pedidos FROM (SELECT {place} AS p FROM o) GROUP BY p",
            _ORDERS,
        )
    found["known_members"] = _sql("SELECT numero_pedido, sk_loja FROM f WHERE sk_loja <> -1", _ORDERS)
    return found


def _dimension_oracles() -> dict[str, str]:
    shares = "('0.' || lpad(CAST(w AS VARCHAR), 2, '0'))"
    numbered = _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS tabela, n AS linhas, CAST(1 AS BIGINT) AS menor, n AS maior, n AS distintas"
            f" FROM (SELECT count({what}) AS n FROM {source})"
            for name, what, source in [
                ("dim_categoria", "DISTINCT k % 37", "f"),
                ("dim_praca", "*", "region"),
                ("fato_pedido", "*", "f"),
            ]
        ),
        _ORDERS,
    )
    return {
        "stg_orders_scan": _staging_text(),
        # CSV files have no NULL beside the blank field.
        "stg_orders_csv": "SELECT * REPLACE (coalesce(valor_liquido_pedido, '') AS valor_liquido_pedido,"
        " coalesce(loja_nome, '') AS loja_nome, coalesce(cod_loja, '') AS cod_loja)"
        f" FROM ({_staging_text()})",
        "parse_date": _sql(
            "SELECT numero_pedido, CASE WHEN lt IS NOT NULL AND k % 9 NOT IN (1, 2, 3, 4, 6, 7)"
            " THEN CAST(e AS DATE) + lt END AS entrega FROM f",
            _ORDERS,
        ),
        "stg_territories_scan": _sql(
            "SELECT 'LJ-' || lpad(CAST(sk_loja AS VARCHAR), 3, '0') AS cod_loja, cod_praca, nome_praca, regional,"
            " translate(format('{:,}', CAST(domicilios_com_pet AS BIGINT)), ',', '.') AS domicilios_com_pet,"
            f" CASE w WHEN 100 THEN '1,00' ELSE replace({shares}, '.', ',') END AS percentual_publico"
            " FROM ponte JOIN praca USING (r)",
            _BRIDGE,
        ),
        "size_band": (
            "SELECT s_suppkey, CAST(CASE WHEN n = 2 THEN 150 ELSE 100 + 20 * n END AS INTEGER) AS area_venda_m2,"
            " CASE WHEN n IN (0, 1) THEN 'Pequena' WHEN n < 16 THEN 'Media' ELSE 'Grande' END AS porte"
            " FROM (SELECT s_suppkey, s_suppkey % 25 AS n FROM supplier)"
        ),
        "dim_calendar": _sql(
            "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_tempo, d AS data, CAST(year(d) AS INTEGER) AS ano,"
            " CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia, strftime(d, '%Y-%m') AS ano_mes,"
            f" ({_MONTHS})[month(d)] AS nome_mes, CAST(quarter(d) AS INTEGER) AS trimestre,"
            f" ({_WEEKDAYS})[dayofweek(d) + 1] AS dia_semana,"
            " CASE WHEN dayofweek(d) IN (0, 6) THEN 'Sim' ELSE 'Nao' END AS fim_de_semana"
            " FROM (SELECT CAST(unnest(generate_series(CAST((SELECT CAST(min(t) AS DATE) FROM f) AS TIMESTAMP),"
            f" CAST({_LAST_DAY} AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d)"
            f" UNION ALL SELECT -1, NULL, NULL, NULL, NULL, 'N/I', '{_N}', NULL, '{_N}', 'N/I'",
            _ORDERS,
        ),
        "dim_store": _sql(
            "SELECT * FROM loja UNION ALL SELECT -1, 'N/I', 'NAO INFORMADO', "
            f"'{_N}', '{_N}', 'N/I', '{_N}', NULL, NULL, '{_N}', '{_N}', '{_N}'",
            _STORES,
        ),
        "dim_category": _sql(
            f"SELECT DISTINCT categoria_origem, nome_categoria, ({_list(GROUP_LABELS)})[k % 37 + 1] AS grupo_categoria"
            f" FROM f UNION ALL SELECT '{_N}', '{_N}', '{_N}'",
            _ORDERS,
        ),
        "dim_territory": _sql(
            "SELECT cod_praca, nome_praca, regional, domicilios_com_pet FROM praca"
            f" UNION ALL SELECT 'N/I', '{_N}', '{_N}', 0",
            _BRIDGE,
        ),
        "dim_unknown_member": " UNION ALL ".join(
            f"SELECT '{dim}' AS dimensao, -1 AS chave, '{_N}' AS nome"
            for dim in ["dim_tempo", "dim_loja", "dim_categoria", "dim_praca"]
        ),
        "bridge_store_territory": _sql(
            "SELECT 'LJ-' || lpad(CAST(sk_loja AS VARCHAR), 3, '0') AS cod_loja, 'PR-' || r AS cod_praca,"
            " CAST(w / 100.0 AS DOUBLE) AS fator_publico FROM ponte",
            _BRIDGE,
        ),
        "surrogate_keys": numbered,
        "surrogate_keys_csv": numbered,
        "fact_days": _sql(
            f"SELECT strftime(t, '%Y-%m') AS ano_mes, count(*) AS pedidos, {_money('sum(cents)')} AS vl_liquido FROM f"
            " WHERE quarter(t) = 2 AND dayofweek(t) IN (0, 6) GROUP BY ALL",
            _ORDERS,
        ),
        "fact_reload": _sql(
            f"SELECT strftime(t, '%Y-%m') AS ano_mes, count(*) AS pedidos, {_count(_RELOADED)} AS novas,"
            f" count(*) AS distintas, {_money('sum(cents)')} AS vl_liquido FROM f"
            f" WHERE NOT {_RELOADED} OR (k % 2 = 0 AND month(t) <> 2) GROUP BY ALL",
            _ORDERS,
        ),
    }


# The planted faults: column, which orders, text, broken rule.
_FAULTS = [
    ("dt_hora_pedido", "k % 101 = 3", "'31/12/1995 10:00 AM'", "dia ou hora inexistente"),
    ("dt_hora_integracao_erp", "k % 103 = 4", "'1995-12-31 10:00'", "fora da mascara americana"),
    ("dt_separacao_estoque", "k % 107 = 5", "'1995-02-30'", "dia ou hora inexistente"),
    ("dt_nota_fiscal", "k % 109 = 6", "'31/12/1995'", "fora do formato ISO"),
    ("dt_despacho_transportadora", "k % 113 = 7", "'1995-03-01 99:99'", "dia ou hora inexistente"),
    ("dt_entrega_cliente", "k % 127 = 8", "'1995-03-01 25:00:00'", "dia ou hora inexistente"),
    ("qtd_itens", "k % 131 = 9", "(k % 9) || ' cx'", "nao e inteiro"),
    ("qtd_itens", "k % 131 = 10", "'99999999999'", "numero fora da faixa"),
    ("valor_liquido_pedido", "k % 137 = 11", "'US$ ' || k", "nao e numero"),
    ("valor_liquido_pedido", "k % 137 = 12", "'1,000.000.000,00'", "nao e numero"),
    ("valor_liquido_pedido", "k % 137 = 13", "'12345678901234567'", "numero fora da faixa"),
]


def _key_oracles() -> dict[str, str]:
    tables = [
        ("dim_categoria", "count(DISTINCT k % 37) FILTER (k % 37 < 20)", "count(DISTINCT k % 37)", "f"),
        ("dim_praca", "count(*) FILTER (regional = 'Norte')", "count(*)", "praca"),
    ]
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS dimensao, {first} AS antes, {second} AS depois FROM {source}" for name, first, second, source in tables
    )
    return {
        "stable_keys": _sql(
            "SELECT *, antes AS iguais, CASE WHEN depois > antes THEN antes + 1 END AS menor_nova,"
            f" CASE WHEN depois > antes THEN depois END AS maior_nova, depois AS distintas FROM ({rows})",
            _ORDERS,
            _BRIDGE,
        )
    }


def _reject_oracles() -> dict[str, str]:
    day = lambda n: f"CASE WHEN {{}} OR l{n} IS NULL THEN NULL ELSE CAST(e AS DATE) + CAST({{}} AS INTEGER) END"
    sums = ["k % 5", "k % 5 + (k // 5) % 3", "k % 5 + (k // 5) % 3 + (k // 15) % 9", "lt"]
    lost = ["k % 107 = 5", "k % 109 = 6", "k % 113 = 7", "k % 127 = 8"]
    days = ", ".join(f"{day(n).format(which, total)} AS m{n}" for n, (which, total) in enumerate(zip(lost, sums, strict=True), 1))
    key = lambda d: f"coalesce(CAST(strftime({d}, '%Y%m%d') AS INTEGER), -1)"
    lags = [("m0", "m1"), ("m1", "m2"), ("m2", "m3"), ("m3", "m4"), ("m0", "m4")]
    names = [*(f"dias_{name}" for name in _STEPS), "dias_total_ate_entrega"]
    spans = ", ".join(f"CAST({b} - {a} AS INTEGER) AS {name}" for (a, b), name in zip(lags, names, strict=True))
    return {
        "load_rejects": _sql(
            " UNION ALL ".join(
                f"SELECT numero_pedido, '{column}' AS coluna, {text} AS texto, '{rule}' AS regra FROM f WHERE {which}"
                for column, which, text, rule in _FAULTS
            ),
            _ORDERS,
        ),
        "fact_lenient": _sql(
            f"SELECT numero_pedido, {key('t2')} AS sk_tempo_pedido, {key('m4')} AS sk_tempo_entrega, t2 AS dt_pedido,"
            f" qt2 AS qt_itens, {_money('cents2')} AS vl_liquido, {spans}"
            " FROM (SELECT *, CASE WHEN k % 101 <> 3 THEN t END AS t2,"
            " CASE WHEN k % 103 <> 4 THEN CAST(e AS DATE) END AS m0,"
            f" {days}, CASE WHEN k % 131 NOT IN (9, 10) THEN qt_itens END AS qt2,"
            " CASE WHEN k % 137 NOT IN (11, 12, 13) THEN cents END AS cents2 FROM f)",
            _ORDERS,
        ),
    }


def _answer_oracles() -> dict[str, str]:
    labels = ["Integracao -> Separacao", "Separacao -> Nota", "Nota -> Despacho", "Despacho -> Entrega"]
    total = "(SELECT sum(cents) FROM f)"
    per_store = "f JOIN loja USING (sk_loja)"
    return {
        "answer_cells": _sql(
            "SELECT sk_loja, categoria_origem, canal_pedido, houve_desconto, count(*) AS n_pedidos,"
            f" {_money('sum(cents)')} AS sum_vl_liquido, count(cents) AS n_vl_liquido,"
            " CAST(sum(qt_itens) AS BIGINT) AS sum_qt_itens, "
            + ", ".join(
                f"CAST(sum({lag}) AS BIGINT) AS sum_dias_{name}, count({lag}) AS n_dias_{name}"
                for lag, name in zip(["l1", "l2", "l3", "l4", "lt"], [*_STEPS, "total_ate_entrega"], strict=True)
            )
            + f", {_count('sk_loja = -1')} AS pedidos_sem_loja, {_count('lt IS NULL')} AS entregas_nao_concluidas,"
            f" {_count('qt_itens IS NULL')} AS pedidos_com_itens_em_branco,"
            f" {_count('cents IS NULL')} AS pedidos_com_valor_em_branco FROM f"
            " GROUP BY sk_loja, categoria_origem, canal_pedido, houve_desconto",
            _ORDERS,
        ),
        "p1_lags_overall": _sql(f"SELECT {_MEANS} FROM f", _ORDERS),
        "p1_bottleneck": _sql(f"SELECT etapa, media_dias FROM ({_each_step('f', labels)})", _ORDERS),
        "p1_lags_by_size": _sql(
            f"SELECT porte, count(*) AS qtd_pedidos, {_MEANS} FROM {per_store} GROUP BY porte", _ORDERS, _STORES
        ),
        "p1_steps_by_size": _sql(
            f"SELECT porte, {_STEP_MEANS} FROM {per_store} GROUP BY porte", _ORDERS, _STORES
        ),
        "p1_bottleneck_by_size": _sql(
            "SELECT porte, etapa, media_dias FROM (SELECT *, row_number() OVER (PARTITION BY porte"
            " ORDER BY media DESC, ordem) AS x FROM ("
            f"{_each_step(per_store, _STEPS, 'porte')})) WHERE x = 1",
            _ORDERS,
            _STORES,
        ),
        "p2_category_revenue": _sql(
            f"SELECT nome_categoria, {_money('sum(cents)')} AS faturamento_categoria,"
            f" {_share('sum(cents)', total)} AS percentual_faturamento FROM f GROUP BY nome_categoria",
            _ORDERS,
        ),
        "p2_category_by_size": _sql(
            f"SELECT porte, nome_categoria, {_money('s')} AS faturamento_categoria,"
            f" {_share('s', '(SELECT sum(h.s) FROM g h WHERE h.porte = g.porte)')} AS percentual_no_porte FROM g",
            _ORDERS,
            _STORES,
            _CATEGORY_GROUPS,
        ),
        "p2_champion": _sql(
            f"SELECT porte, nome_categoria AS categoria_campea, {_money('s')} AS faturamento FROM g"
            " WHERE s = (SELECT max(h.s) FROM g h WHERE h.porte = g.porte)",
            _ORDERS,
            _STORES,
            _CATEGORY_GROUPS,
        ),
        "p3_ticket_by_channel": _sql(
            f"SELECT canal_pedido, {_TICKET_WITH} AS ticket_medio_com_desconto,"
            f" {_TICKET_WITHOUT} AS ticket_medio_sem_desconto, pc AS pedidos_com_desconto,"
            " ps AS pedidos_sem_desconto FROM g",
            _ORDERS,
            _TICKETS,
        ),
        "p3_ticket_gap": _sql(
            f"SELECT canal_pedido, {_TICKET_WITH} AS ticket_com_desconto,"
            f" {_TICKET_WITHOUT} AS ticket_sem_desconto, {_TICKET_GAP} AS diferenca_ticket,"
            f" {_ratio('(100 * (sc * ns - ss * nc))', '(ss * nc)')} AS variacao_percentual FROM g",
            _ORDERS,
            _TICKETS,
        ),
        "p3_channel_share": _sql(
            f"SELECT canal_pedido, n AS qtd_pedidos, {_money('s')} AS faturamento_canal,"
            f" {_share('s', total)} AS percentual_faturamento FROM g",
            _ORDERS,
            _TICKETS,
        ),
        "p3_summary": _sql(
            f"SELECT canal_pedido, n AS qtd_pedidos, {_TICKET_WITH} AS ticket_com_desconto,"
            f" {_TICKET_WITHOUT} AS ticket_sem_desconto, {_TICKET_GAP} AS diferenca_ticket,"
            f" {_money('s')} AS faturamento_canal, {_share('s', total)} AS percentual_faturamento FROM g",
            _ORDERS,
            _TICKETS,
        ),
        "p4_store_revenue": _sql(
            f"SELECT nome_loja, {_money('sum(cents)')} AS faturamento_loja FROM {per_store}"
            " GROUP BY sk_loja, nome_loja",
            _ORDERS,
            _STORES,
        ),
        "p4_allocated": _sql(
            f"SELECT nome_praca, {_ratio('s', '10000')} AS faturamento_rateado FROM g JOIN praca USING (r)",
            _ORDERS,
            _BRIDGE,
            _ALLOCATED,
        ),
        "p4_reconcile": _sql(
            f"SELECT {_money(total)} AS faturamento_total_rede,"
            f" {_ratio('(SELECT sum(s) FROM g)', '10000')} AS faturamento_rateado_pracas,"
            f" {_money('(SELECT sum(cents) FROM f WHERE sk_loja = -1)')} AS faturamento_sem_loja,"
            " CAST(((SELECT sum(s) FROM g) + 100 * (SELECT sum(cents) FROM f WHERE sk_loja = -1)"
            f" - 100 * {total}) / 10000.0 AS DOUBLE) AS diferenca",
            _ORDERS,
            _BRIDGE,
            _ALLOCATED,
        ),
        "p4_per_household": _sql(
            f"SELECT nome_praca, domicilios_com_pet, {_ratio('s', '10000')} AS faturamento_rateado,"
            f" {_ratio('s', '(CAST(10000 AS BIGINT) * domicilios_com_pet)')} AS faturamento_por_domicilio_com_pet"
            " FROM g JOIN praca USING (r)",
            _ORDERS,
            _BRIDGE,
            _ALLOCATED,
        ),
        "p5_items_per_1000": _sql(f"SELECT * FROM ({_items(per_store)})", _ORDERS, _STORES),
        "p5_top10": _sql(
            f"SELECT * FROM ({_items(per_store)}) WHERE itens_por_mil_habitantes IS NOT NULL"
            " ORDER BY itens_por_mil_habitantes DESC, nome_loja LIMIT 10",
            _ORDERS,
            _STORES,
        ),
        "p5_tier_share": _sql(
            f"SELECT faixa_franquia, count(*) AS qtd_pedidos, {_money('sum(cents)')} AS faturamento,"
            f" {_share('sum(cents)', total)} AS percentual_faturamento FROM {per_store} GROUP BY faixa_franquia",
            _ORDERS,
            _STORES,
        ),
        "p5_quality_impact": _sql(
            f"SELECT count(*) AS total_pedidos, {_count('sk_loja = -1')} AS pedidos_sem_loja,"
            f" {_count('lt IS NULL')} AS entregas_nao_concluidas,"
            f" {_count('qt_itens IS NULL')} AS pedidos_com_itens_em_branco,"
            f" {_count('cents IS NULL')} AS pedidos_com_valor_em_branco FROM f",
            _ORDERS,
        ),
        "p5_quality_pct": _sql(
            " UNION ALL ".join(
                f"SELECT '{name}' AS problema, {_count(test)} AS quantidade,"
                f" {_ratio(f'(100 * {_count(test)})', 'count(*)')} AS percentual FROM f"
                for name, test in [
                    ("pedidos_sem_loja", "sk_loja = -1"),
                    ("entregas_nao_concluidas", "lt IS NULL"),
                    ("pedidos_com_itens_em_branco", "qt_itens IS NULL"),
                    ("pedidos_com_valor_em_branco", "cents IS NULL"),
                ]
            ),
            _ORDERS,
        ),
    }


def _items(per_store: str) -> str:
    return (
        "SELECT nome_loja, cidade, porte, populacao_cidade, CAST(sum(qt_itens) AS BIGINT) AS total_itens_vendidos,"
        f" {_ratio('(1000 * sum(qt_itens))', 'populacao_cidade')} AS itens_por_mil_habitantes,"
        f" {_mean('lt')} AS tempo_medio_entrega FROM {per_store}"
        " GROUP BY sk_loja, nome_loja, cidade, porte, populacao_cidade"
    )


def _check_oracles() -> dict[str, str]:
    whole = "CAST(round(({}) / 100.0) AS DOUBLE)"
    lost = "SELECT categoria_origem, nome_categoria FROM f WHERE nome_categoria = 'Nao Informado'"
    total = "(SELECT sum(cents) FROM f)"
    unknown = "(SELECT sum(cents) FROM f WHERE sk_loja = -1)"
    known_total = "(SELECT sum(cents) FROM f WHERE sk_loja <> -1)"
    lists = {
        "check_row_counts": _ROW_COUNTS,
        "check_spellings": _SPELLING_COUNTS,
        "check_blank_milestones": _BLANKS,
        "check_date_mask": _MASK_ALONE,
        "check_money_audit": _MONEY_AUDIT,
        "check_date_orphans": _DATE_ORPHANS,
        "check_category_domain": _DOMAIN,
        "check_bridge_coverage": _COVERAGE,
        "check_unknown_rows": _UNKNOWN_ROWS,
        "check_unique_keys": _UNIQUE,
        "check_text_lengths": _LENGTHS,
        "check_fact_grain": [
            ("fato_pedido", "(SELECT count(*) FROM f)", "(SELECT count(*) FROM orders)"),
        ],
        "check_fk_integrity": _FK,
        "check_unresolved": _UNRESOLVED,
        "check_negative_lags": _NEGATIVE,
        "checks_all": [
            *_ROW_COUNTS,
            *_SPELLING_COUNTS,
            *_BLANKS,
            *_MASK,
            *_OFF_MASK,
            *_MONEY_AUDIT,
            *_CHANNEL,
            *_DOMAIN,
            *_COVERAGE,
            *_UNKNOWN_ROWS,
            *_UNIQUE,
            *_LENGTHS,
            *_FK,
            *_UNRESOLVED,
            *_NEGATIVE,
            *_DATES,
            *_NOTHING_LOST,
        ],
    }
    lists["checks_from_profiles"] = lists["checks_all"]
    found = {name: _sql(_checks(rows), _ORDERS, _BRIDGE) for name, rows in lists.items()}
    filled = [("dim_categoria", _ROW_COUNTS[5][1]), ("dim_praca", _ROW_COUNTS[6][1]), ("bridge_loja_praca", _ROW_COUNTS[7][1]), ("fato_pedido", _ROW_COUNTS[8][1])]
    found |= {
        "check_targets_empty": _sql(
            f"SELECT *, 'antes da carga' AS momento FROM ({_checks([(name, '0', '0') for name, _ in filled])})"
            f" UNION ALL SELECT *, 'depois da carga' AS momento FROM ({_checks([(name, n, '0') for name, n in filled])})",
            _ORDERS,
            _BRIDGE,
        ),
        "check_unclassified": _sql(lost, _ORDERS),
        "check_rule_order": (
            "SELECT unnest(['Ração Medicamentosa', 'RACAO MEDICAMENTOSA']) AS categoria_origem,"
            " 'Medicamento' AS nome_categoria, 'Medicamento' AS esperado"
        ),
        "check_bridge_weights": _sql(
            "SELECT 'LJ-' || lpad(CAST(sk_loja AS VARCHAR), 3, '0') AS cod_loja,"
            " CAST(sum(w) / 100.0 AS DOUBLE) AS soma_dos_fatores FROM ponte GROUP BY sk_loja HAVING sum(w) <> 100",
            _BRIDGE,
        ),
        "check_channel_present": _sql(
            "SELECT canal_pedido, count(*) AS pedidos FROM f WHERE canal_pedido = 'WhatsApp' GROUP BY canal_pedido",
            _ORDERS,
        ),
        "check_date_range": _sql(
            "SELECT CAST(min(t) AS DATE) AS primeiro_pedido, CAST(max(t) AS DATE) AS ultimo_pedido FROM f",
            _ORDERS,
        ),
        "check_join_preserves_total": _sql(
            f"SELECT {whole.format(total)} AS total_na_fato, {whole.format(total)} AS total_pela_p2", _ORDERS
        ),
        "check_allocation": _sql(
            f"SELECT {whole.format(total)} AS total_da_rede, {whole.format(known_total)} AS soma_rateada,"
            f" {whole.format(unknown)} AS sem_loja, CAST(0 AS DOUBLE) AS diferenca",
            _ORDERS,
        ),
    }
    return found


def oracles() -> dict[str, str]:
    return {**_cleaner_oracles(), **_dimension_oracles(), **_key_oracles(), **_reject_oracles(), **_answer_oracles(), **_check_oracles()}
