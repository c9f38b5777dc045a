"""The same results in plain SQL, for checking against another engine."""

from __future__ import annotations

# Personal data, in masking order, as this engine's expressions have it.
PATTERNS = {
    "email": r"[\w.%+-]{1,64}@[a-zA-Z\d.-]+[.][a-zA-Z]{2,}",
    "card": r"\d{13,16}",
    "phone": r"[+]\d{1,3}[ ]?[(]?\d{2,3}[)]?[- ]?\d{3}[- ]?\d{3,4}",
    "ipv4": r"(?:\d{1,3}[.]){3}\d{1,3}",
}
MONEY = "DECIMAL(18,2)"


def _money(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS {MONEY})"


def _half_up_mean(total: str, n: str) -> str:
    """Mean of a 2-decimal total, rounded half up in whole cents (totals are positive)."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST(((2 * {cents} + {n}) // (2 * {n})) / 100.0 AS {MONEY})"


CHARGED = "CAST(l_extendedprice AS DECIMAL(14,2))"
CLIENTES = """clientes AS (
  SELECT c_custkey AS id, c_name AS nome,
         lower(replace(c_name, '#', '.')) || '@exemplo.pt' AS email, n_name AS distrito,
         c_mktsegment AS segmento, CAST(c_acctbal AS DECIMAL(14,2)) AS saldo
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
ORDER_REVENUE = f"""order_revenue AS (
  SELECT o_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
         SUM({CHARGED}) AS receita
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""
FACT = """fact AS (
  SELECT l_orderkey AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS quantidade, CAST(p_retailprice AS DECIMAL(10,2)) AS preco,
         CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(14,2)) AS total_linha,
         o_orderdate AS data_hora, CAST(o_orderdate AS DATE) AS date
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey)"""
REVENUE = f"CAST(SUM(total_linha) AS {MONEY})"
ISO_YEAR = "CAST(isoyear(date) AS INTEGER) AS iso_year"

SQL: dict[str, str] = {}

SQL["top_customers"] = f"""WITH {CLIENTES}, {ORDER_REVENUE}
SELECT c.id AS id_cliente, nome AS nome_cliente, email, distrito, {_money('SUM(receita)')} AS total_gasto
FROM order_revenue r JOIN clientes c ON c.id = r.id_cliente
GROUP BY c.id, nome, email, distrito ORDER BY total_gasto DESC, id_cliente LIMIT 10"""

SQL["best_sellers_by_category"] = """WITH units AS (
  SELECT p_type AS categoria, p_partkey AS id_produto, p_name AS nome_produto,
         CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS unidades_vendidas
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
ranked AS (SELECT *, RANK() OVER (PARTITION BY categoria ORDER BY unidades_vendidas DESC, nome_produto) AS posicao FROM units)
SELECT categoria, id_produto, nome_produto, unidades_vendidas FROM ranked WHERE posicao = 1 ORDER BY categoria"""

SQL["monthly_revenue_trend"] = f"""SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS mes,
  {_money(f'SUM({CHARGED})')} AS receita
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 1"""

SQL["aov_by_district"] = f"""WITH {CLIENTES}, {ORDER_REVENUE}
SELECT distrito, {_half_up_mean('SUM(receita)', 'COUNT(*)')} AS valor_medio_encomenda,
  COUNT(*) AS num_encomendas, {_money('SUM(receita)')} AS receita_total
FROM order_revenue r JOIN clientes c ON c.id = r.id_cliente GROUP BY distrito"""

SQL["top_customers_unit_price"] = f"""WITH {CLIENTES}, {FACT}
SELECT c.id AS id_cliente, nome AS nome_cliente, email, distrito, {_money('SUM(total_linha)')} AS total_gasto
FROM fact JOIN clientes c ON c.id = customer_id
GROUP BY c.id, nome, email, distrito ORDER BY total_gasto DESC, id_cliente LIMIT 10"""

SQL["transaction_fact"] = f"WITH {FACT} SELECT * FROM fact"
SQL["transaction_fact_charged"] = SQL["transaction_fact"]
SQL["customer_lifetime_value"] = f"""WITH {FACT}
SELECT customer_id, {REVENUE} AS customer_lifetime_value FROM fact GROUP BY customer_id"""
SQL["daily_revenue"] = f"WITH {FACT} SELECT date, {REVENUE} AS daily_revenue FROM fact GROUP BY date"
SQL["weekly_revenue"] = f"""WITH {FACT}
SELECT CAST(week(date) AS INTEGER) AS week, {REVENUE} AS weekly_revenue FROM fact GROUP BY 1"""
SQL["weekly_revenue_by_iso_year"] = f"""WITH {FACT}
SELECT {ISO_YEAR}, CAST(week(date) AS INTEGER) AS week, {REVENUE} AS weekly_revenue FROM fact GROUP BY 1, 2"""
SQL["monthly_revenue"] = f"""WITH {FACT}
SELECT strftime(date, '%Y-%m') AS month, {REVENUE} AS monthly_revenue FROM fact GROUP BY 1"""

SQL["monthly_revenue_undated"] = f"""WITH {FACT}
SELECT CASE WHEN o_orderstatus = 'P' THEN 'NaT' ELSE strftime(date, '%Y-%m') END AS month, {REVENUE} AS monthly_revenue
FROM fact JOIN orders ON o_orderkey = transaction_id GROUP BY 1"""

SQL["co_purchase"] = """SELECT x.l_partkey AS product_id_x, y.l_partkey AS product_id_y,
  COUNT(*) AS co_purchase_count
FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_partkey <> y.l_partkey
GROUP BY 1, 2"""

SQL["product_recommendations"] = """WITH b AS (
  SELECT l_orderkey AS o, l_partkey AS p, COUNT(*) AS n FROM lineitem GROUP BY ALL),
pairs AS (SELECT x.p AS product_id_x, y.p AS product_id_y, CAST(SUM(x.n * y.n) AS BIGINT) AS co_purchase_count,
  COUNT(*) AS shared FROM b x JOIN b y ON x.o = y.o AND x.p <> y.p GROUP BY 1, 2),
ranked AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY product_id_x ORDER BY co_purchase_count DESC, product_id_y)
  AS INTEGER) AS position FROM pairs),
per_product AS (SELECT p, COUNT(*) AS n FROM b GROUP BY p)
SELECT product_id_x, position, product_id_y, co_purchase_count,
  ROUND(shared / (SELECT COUNT(DISTINCT o) FROM b)::DOUBLE, 8) AS support,
  ROUND(shared / per_product.n::DOUBLE, 8) AS confidence
FROM ranked JOIN per_product ON per_product.p = product_id_x WHERE position <= 5"""

SQL["calendar_columns"] = """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date,
  CAST(week(o_orderdate) AS INTEGER) AS week, CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year,
  strftime(o_orderdate, '%Y-%m') AS month,
  CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
  o_orderdate - INTERVAL 2 DAY AS late_bound,
  strftime(o_orderdate, 'raw/year=%Y/month=%m/day=%d') AS landing_path
FROM orders"""

# --- data quality ---------------------------------------------------------------

DIRTY = f"""{CLIENTES},
dc AS (SELECT CAST(id AS VARCHAR) AS id, nome,
  CASE WHEN saldo < 0 THEN replace(email, '@', ' at ') WHEN segmento <> 'MACHINERY' THEN email END AS email,
  CASE distrito WHEN 'PERU' THEN '26/10/2025' WHEN 'CHINA' THEN '2025-02-30' WHEN 'JAPAN' THEN ''
    WHEN 'INDIA' THEN '2025-1-5 7:05:09' ELSE '2025-1-5' END AS data_registo, distrito FROM clientes),
dp AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS nome, p_type AS categoria,
  CASE p_size WHEN 1 THEN '' WHEN 2 THEN 'n/a' WHEN 3 THEN '-1.50' WHEN 4 THEN 'nan' WHEN 5 THEN '0'
    WHEN 6 THEN ' 7.5 ' ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS preco,
  p_brand AS fornecedor FROM part),
dt AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS id_cliente,
  CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN o_orderstatus = 'P' THEN 'yesterday'
    WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS data_hora,
  o_orderpriority AS metodo_pagamento FROM orders),
di AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, CAST(l_orderkey AS VARCHAR) AS id_transacao,
  CAST(l_partkey AS VARCHAR) AS id_produto,
  CASE WHEN l_returnflag = 'R' AND l_quantity = 3 THEN '3.0' WHEN l_returnflag = 'R' AND l_quantity = 4 THEN '0'
    WHEN l_returnflag = 'R' AND l_quantity = 5 THEN ' 5 ' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantidade,
  CASE WHEN l_returnflag = 'A' AND l_quantity = 3 THEN '-0.01' WHEN l_returnflag = 'A' AND l_quantity = 4 THEN 'free'
    ELSE CAST({CHARGED} AS VARCHAR) END AS preco_unitario FROM lineitem)"""

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def _quality(name: str, view: str, checks: list[tuple[str, str, str]]) -> list[str]:
    return [
        f"SELECT '{name}' AS tabela, '{rule}' AS regra, '{column}' AS coluna, "
        f"COUNT(*) FILTER (WHERE {fails}) AS linhas_falhadas FROM {view}"
        for rule, column, fails in checks
    ]


def _null(*columns: str) -> list[tuple[str, str, str]]:
    return [("not_null", c, f"{c} IS NULL") for c in columns]


_PRICE = "TRY_CAST(trim(preco) AS DECIMAL(10,2))"
_UNIT = "TRY_CAST(trim(preco_unitario) AS DECIMAL(10,2))"
_QTY = f"(CASE WHEN regexp_matches(quantidade, '{_WHOLE}') THEN CAST(trim(quantidade) AS BIGINT) END)"
_TIME = "TRY_CAST(data_hora AS TIMESTAMP)"
_EXPECTATIONS = (
    _quality("clientes", "dc", _null("id", "email") + [
        ("email", "email", "NOT coalesce(contains(email, '@'), FALSE)")])
    + _quality("produtos", "dp", [("not_null", "id", "id IS NULL"), ("not_null", "preco", f"{_PRICE} IS NULL"),
        ("positive", "preco", f"{_PRICE} <= 0")])
    + _quality("transacoes", "dt", _null("id", "id_cliente") + [
        ("not_null", "data_hora", f"{_TIME} IS NULL"), ("timestamp", "data_hora", f"{_TIME} IS NULL")])
    + _quality("transacao_itens", "di", _null("id", "id_transacao", "id_produto") + [
        ("not_null", "quantidade", f"{_QTY} IS NULL"), ("not_null", "preco_unitario", f"{_UNIT} IS NULL"),
        ("positive", "quantidade", f"{_QTY} <= 0"), ("positive", "preco_unitario", f"{_UNIT} <= 0")])
)
SQL["expectation_results"] = f"WITH {DIRTY}\n" + "\nUNION ALL ".join(_EXPECTATIONS)
SQL["expectation_issue_count"] = (
    f"WITH {DIRTY}, results AS (" + "\nUNION ALL ".join(_EXPECTATIONS)
    + ") SELECT COUNT(*) FILTER (WHERE linhas_falhadas > 0) AS total_issues FROM results"
)


def _rows(name: str, view: str, rule: str, column: str, fails: str) -> str:
    return (
        f"SELECT '{name}' AS tabela, id AS chave, '{rule}' AS regra, '{column}' AS coluna, "
        f"{column} AS valor FROM {view} WHERE {fails}"
    )


def _blank(name: str, view: str, columns: str) -> list[str]:
    return [_rows(name, view, "null value", c, f"coalesce({c}, '') = ''") for c in columns.split()]


_EMAIL_OK = r"coalesce(regexp_matches(email, '^[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+$'), FALSE)"
_PRICE_TEXT = "TRY_CAST(trim(preco) AS DOUBLE)"
_UNIT_TEXT = "TRY_CAST(trim(preco_unitario) AS DOUBLE)"
_VIOLATIONS = (
    _blank("clientes", "dc", "id nome email data_registo distrito")
    + [
        _rows("clientes", "dc", "invalid email", "email", f"NOT {_EMAIL_OK}"),
        _rows("clientes", "dc", "invalid date", "data_registo",
              "coalesce(try_strptime(data_registo, '%Y-%m-%d'), try_strptime(data_registo, '%Y-%m-%d %H:%M:%S')) IS NULL"),
    ]
    + _blank("produtos", "dp", "id nome categoria preco fornecedor")
    + [
        _rows("produtos", "dp", "invalid price", "preco", f"{_PRICE_TEXT} IS NULL"),
        _rows("produtos", "dp", "non-positive price", "preco", f"{_PRICE_TEXT} <= 0"),
    ]
    + _blank("transacoes", "dt", "id id_cliente data_hora metodo_pagamento")
    + [_rows("transacoes", "dt", "invalid timestamp", "data_hora",
             "coalesce(try_strptime(data_hora, '%Y-%m-%d'), try_strptime(data_hora, '%Y-%m-%d %H:%M:%S')) IS NULL")]
    + _blank("transacao_itens", "di", "id id_transacao id_produto quantidade preco_unitario")
    + [
        _rows("transacao_itens", "di", "invalid quantity", "quantidade", f"{_QTY} IS NULL"),
        _rows("transacao_itens", "di", "non-positive quantity", "quantidade", f"{_QTY} <= 0"),
        _rows("transacao_itens", "di", "invalid unit price", "preco_unitario", f"{_UNIT_TEXT} IS NULL"),
        _rows("transacao_itens", "di", "non-positive unit price", "preco_unitario", f"{_UNIT_TEXT} <= 0"),
    ]
)
SQL["row_violations"] = f"WITH {DIRTY}\n" + "\nUNION ALL ".join(_VIOLATIONS)

# Files of one length of id each, rows by id; some lines are a field too wide or too narrow.
_FILES = {
    "dc": ("clientes", "id nome email data_registo distrito", "distrito = 'NATION_3'", "distrito = 'NATION_4'"),
    "dp": ("produtos", "id nome categoria preco fornecedor", "fornecedor = 'Brand#3'", "fornecedor = 'Brand#4'"),
    "dt": ("transacoes", "id id_cliente id_produto quantidade data_hora metodo_pagamento",
           "metodo_pagamento = '1-URGENT' AND data_hora LIKE '1996-01%'",
           "metodo_pagamento = '2-HIGH' AND data_hora LIKE '1996-01%'"),
    "di": ("transacao_itens", "id id_transacao id_produto quantidade preco_unitario", "quantidade = '7'", "quantidade = '8'"),
}


def _numbered(view: str) -> str:
    """The view as f<view>, with file, row number and malformed line."""
    name, columns, wide, narrow = _FILES[view]
    source = "(SELECT *, '1' AS id_produto, '1' AS quantidade FROM dt)" if view == "dt" else view
    fields = columns.split()
    text = [f"coalesce({c}, '')" for c in fields]
    kept = [f"nullif({c}, '') AS {c}" for c in fields[:-1]]
    kept.append(f"CASE WHEN NOT narrow THEN nullif({fields[-1]}, '') END AS {fields[-1]}")
    return f"""m{view} AS (SELECT *, coalesce({wide}, FALSE) AS wide, coalesce({narrow}, FALSE) AS narrow FROM {source}),
l{view} AS (SELECT *, CASE WHEN wide THEN concat_ws(',', {', '.join(text)}, 'extra')
    WHEN narrow THEN concat_ws(',', {', '.join(text[:-1])}) ELSE concat_ws(',', {', '.join(text)}) END AS line FROM m{view}),
f{view} AS (SELECT {', '.join(kept)}, '{name}.csv/part=' || length(id) AS ficheiro, CASE WHEN wide OR narrow THEN line END AS odd,
  row_number() OVER (PARTITION BY length(id) ORDER BY CAST(id AS BIGINT), line) AS linha FROM l{view})"""


_LINE_VIOLATIONS = [
    v.replace(" AS chave,", " AS chave, ficheiro, linha,").replace(f" FROM {view} ", f" FROM f{view} ")
    for v in _VIOLATIONS for view in _FILES if f" FROM {view} " in v
] + [
    f"SELECT '{_FILES[view][0]}', id, ficheiro, linha, 'wrong number of fields', NULL, odd FROM f{view} WHERE odd IS NOT NULL"
    for view in _FILES
]
SQL["row_violation_lines"] = f"WITH {DIRTY}, {', '.join(map(_numbered, _FILES))}\n" + "\nUNION ALL ".join(_LINE_VIOLATIONS)

SQL["broken_constraints"] = f"""WITH {CLIENTES}, c AS (SELECT * FROM clientes WHERE saldo >= 0),
p AS (SELECT * FROM part WHERE p_size < 50),
found AS (
  SELECT 'clientes' AS tabela, 'unique(id)' AS restricao, CAST(id AS VARCHAR) AS valor, COUNT(*) AS linhas
    FROM c GROUP BY id HAVING COUNT(*) > 1
  UNION ALL SELECT 'clientes', 'unique(email)', email, COUNT(*) FROM c GROUP BY email HAVING COUNT(*) > 1
  UNION ALL SELECT 'produtos', 'unique(id)', CAST(p_partkey AS VARCHAR), COUNT(*) FROM p GROUP BY p_partkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'transacoes', 'unique(id)', CAST(o_orderkey AS VARCHAR), COUNT(*) FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1
  UNION ALL SELECT 'transacao_itens', 'unique(id)', CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), COUNT(*)
    FROM lineitem GROUP BY l_orderkey * 10 + l_linenumber HAVING COUNT(*) > 1
  UNION ALL SELECT 'transacoes', 'foreign key(id_cliente)', CAST(o_custkey AS VARCHAR), COUNT(*)
    FROM orders WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.id = o_custkey) GROUP BY o_custkey
  UNION ALL SELECT 'transacao_itens', 'foreign key(id_transacao)', CAST(l_orderkey AS VARCHAR), COUNT(*)
    FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey) GROUP BY l_orderkey
  UNION ALL SELECT 'transacao_itens', 'foreign key(id_produto)', CAST(l_partkey AS VARCHAR), COUNT(*)
    FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM p WHERE p_partkey = l_partkey) GROUP BY l_partkey)
SELECT * FROM found"""

# --- incremental maintenance ----------------------------------------------------

SQL["upsert_orders"] = f"""WITH {ORDER_REVENUE}
SELECT o_orderkey AS id, o_custkey AS id_cliente, CAST(o_totalprice AS {MONEY}) AS valor,
  TIMESTAMP '2002-01-01' AS version_timestamp
FROM orders WHERE o_orderstatus <> 'O' AND o_orderkey NOT IN (SELECT id FROM order_revenue)
UNION ALL
SELECT id, id_cliente, CAST(receita AS {MONEY}), TIMESTAMP '2002-02-01' FROM order_revenue"""

SQL["latest_version"] = """WITH v AS (
  SELECT l_orderkey AS id, l_partkey AS id_produto, CAST(l_quantity AS INTEGER) AS quantidade,
         l_shipdate AS version_timestamp,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS FIRST,
           l_partkey DESC NULLS LAST, CAST(l_quantity AS INTEGER) DESC NULLS LAST) AS nth FROM lineitem)
SELECT id, id_produto, quantidade, version_timestamp FROM v WHERE nth = 1"""

_LATEST_SHIPMENT = """shipments AS (
  SELECT l_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
         l_returnflag AS metodo_pagamento, l_shipdate AS version_timestamp,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate DESC NULLS FIRST, l_returnflag DESC NULLS LAST) AS nth
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
latest AS (SELECT * EXCLUDE (nth) FROM shipments WHERE nth = 1)"""


def _merge(held_version: str, wins: str) -> str:
    return f"""WITH {_LATEST_SHIPMENT},
target AS (SELECT o_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
  o_orderpriority AS metodo_pagamento, {held_version} AS version_timestamp FROM orders WHERE o_orderstatus <> 'O'),
batch AS (SELECT l.* FROM latest l LEFT JOIN target t ON t.id = l.id WHERE t.id IS NULL OR {wins})
SELECT * FROM target WHERE id NOT IN (SELECT id FROM batch) UNION ALL SELECT * FROM batch"""


SQL["merge_shipments"] = _merge("o_orderdate", "TRUE")
SQL["merge_shipments_newer_only"] = _merge(
    "o_orderdate + INTERVAL 60 DAY", "l.version_timestamp >= t.version_timestamp"
)
_VERSIONED = """SELECT o_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
  o_orderpriority AS metodo_pagamento, o_orderdate AS version_timestamp FROM orders"""
_SINCE = "o_orderdate >= TIMESTAMP '2000-06-01' - INTERVAL 2 DAY"
SQL["increment_since"] = f"{_VERSIONED} WHERE {_SINCE}"
SQL["next_checkpoint"] = f"""SELECT greatest(max(o_orderdate), TIMESTAMP '2000-06-01') AS last_processed
FROM orders WHERE {_SINCE}"""
SQL["incremental_fact"] = _VERSIONED

_SCD2_INPUT = """dim AS (SELECT p_partkey AS id, p_name AS nome, p_type AS categoria, p_brand AS fornecedor,
  CAST(p_retailprice AS DECIMAL(10,2)) AS preco, TIMESTAMP '2025-01-01' AS start_date
  FROM part WHERE p_brand <> 'Brand#5'),
src AS (SELECT p_partkey AS id, CASE WHEN p_brand = 'Brand#7' THEN p_name || ' plus' ELSE p_name END AS nome,
  p_type AS categoria, p_brand AS fornecedor,
  CAST(CASE WHEN p_size >= 40 THEN CAST(p_retailprice AS DECIMAL(10,2)) * 2
    ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS DECIMAL(10,2)) AS preco
  FROM part WHERE NOT (p_type = 'PROMO' AND p_size < 5))"""


def _scd2(same: str, differs: str) -> str:
    return f"""WITH {_SCD2_INPUT},
matched AS (SELECT s.*, d.id IS NOT NULL AS held, d.id IS NOT NULL AND ({differs}) AS changed
  FROM src s LEFT JOIN dim d ON {same})
SELECT id, nome, categoria, fornecedor, preco, start_date,
  CASE WHEN closes THEN TIMESTAMP '2025-02-01' END AS end_date, NOT closes AS is_current
FROM (SELECT d.*, d.id IN (SELECT id FROM matched WHERE changed) AS closes FROM dim d)
UNION ALL
SELECT id, nome, categoria, fornecedor, preco, TIMESTAMP '2025-02-01', CAST(NULL AS TIMESTAMP), TRUE
FROM matched WHERE changed OR NOT held"""


_SAME_TEXT = "s.nome = d.nome AND s.categoria = d.categoria AND s.fornecedor = d.fornecedor"
SQL["scd2_products"] = _scd2(f"s.id = d.id AND {_SAME_TEXT}", "s.preco <> d.preco")
SQL["scd2_products_strict"] = _scd2("s.id = d.id", f"s.preco <> d.preco OR NOT ({_SAME_TEXT})")



def _deliveries(same: str, differs: str) -> str:
    """Four snapshots, applied one by one."""
    old = "p_partkey AS id, p_name AS nome, p_type AS categoria, p_brand AS fornecedor"
    price = "CAST(p_retailprice AS DECIMAL(10,2)) AS preco"
    second = "CAST(CASE WHEN p_size >= 40 THEN 2 ELSE 1 END * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS preco"
    renamed = "CASE WHEN p_brand = 'Brand#7' THEN p_name || ' plus' ELSE p_name END AS nome"
    kept = "WHERE NOT (p_type = 'PROMO' AND p_size < 5)"
    steps = [
        f"s1 AS (SELECT {old}, {price} FROM part WHERE p_brand <> 'Brand#5')",
        f"s2 AS (SELECT {old.replace('p_name AS nome', renamed)}, {second} FROM part {kept})",
        f"s3 AS (SELECT {old}, {second} FROM part {kept})",
        f"s4 AS (SELECT {old}, CAST(p_retailprice + CASE WHEN p_size < 20 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS preco FROM part)",
        "d1 AS (SELECT *, TIMESTAMP '2025-01-01' AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current FROM s1)",
    ]
    for k, day in ((2, "08"), (3, "15"), (4, "22")):
        steps += [
            f"m{k} AS (SELECT s.*, d.id IS NOT NULL AS held, d.id IS NOT NULL AND ({differs}) AS changed "
            f"FROM s{k} s LEFT JOIN (SELECT * FROM d{k - 1} WHERE is_current) d ON {same})",
            f"d{k} AS (SELECT id, nome, categoria, fornecedor, preco, start_date, "
            f"CASE WHEN closes THEN TIMESTAMP '2025-01-{day}' ELSE end_date END AS end_date, is_current AND NOT closes AS is_current "
            f"FROM (SELECT *, is_current AND id IN (SELECT id FROM m{k} WHERE changed) AS closes FROM d{k - 1}) "
            f"UNION ALL SELECT id, nome, categoria, fornecedor, preco, TIMESTAMP '2025-01-{day}', NULL, TRUE FROM m{k} WHERE changed OR NOT held)",
        ]
    return f"WITH {', '.join(steps)} SELECT * FROM d4"


SQL["scd2_from_deliveries"] = _deliveries(f"s.id = d.id AND {_SAME_TEXT}", "s.preco <> d.preco")
SQL["scd2_from_deliveries_strict"] = _deliveries("s.id = d.id", f"s.preco <> d.preco OR NOT ({_SAME_TEXT})")
SQL["scd2_stored_history"] = SQL["scd2_products"]

# --- files, tables and jobs -----------------------------------------------------

def _text(table: str, *cells: str, n: int = 5) -> str:
    cells = [*[f"CAST({c} AS VARCHAR)" for c in cells], *["NULL"] * (n - len(cells))]
    return f"SELECT '{table}' AS tabela, " + ", ".join(f"{c} AS c{i}" for i, c in enumerate(cells, 1))


_DAY = "CAST(coalesce(try_strptime(data_registo, '%Y-%m-%d'), try_strptime(data_registo, '%Y-%m-%d %H:%M:%S')) AS DATE)"
SQL["csv_all_entities"] = f"""WITH {DIRTY}
{_text('clientes', 'id', 'nome', 'email', _DAY, 'distrito')} FROM dc
UNION ALL {_text('produtos', 'id', 'nome', 'categoria', _PRICE, 'fornecedor')} FROM dp
UNION ALL {_text('transacoes', 'id', 'id_cliente', _TIME, 'metodo_pagamento')} FROM dt
UNION ALL {_text('transacao_itens', 'id', 'id_transacao', 'id_produto', _QTY, _UNIT)} FROM di"""
_TYPED = {
    "clientes": ("id nome email data_registo distrito", "c5 <> 'NATION_3'"),
    "produtos": ("id nome categoria preco fornecedor", "c5 <> 'Brand#5'"),
    "transacoes": ("id id_cliente data_hora metodo_pagamento", "TRUE"),
    "transacao_itens": ("id id_transacao id_produto quantidade preco_unitario", "TRUE"),
}


def _breaches() -> str:
    views = [f"{t} AS (SELECT {', '.join(f'c{i} AS {c}' for i, c in enumerate(cs.split(), 1))} FROM entities "
             f"WHERE tabela = '{t}' AND {kept})" for t, (cs, kept) in _TYPED.items()]
    found = [f"SELECT '{t}' AS tabela, 'not null({c})' AS restricao, NULL AS valor, COUNT(*) AS linhas FROM {t}_t WHERE {c} IS NULL HAVING COUNT(*) > 0"
             for t, (cs, _) in _TYPED.items() for c in cs.split()]
    found += [f"SELECT '{t}', 'unique({c})', {c}, COUNT(*) FROM {t}_t WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"
              for t, c in (("clientes", "id"), ("clientes", "email"), ("produtos", "id"), ("transacoes", "id"), ("transacao_itens", "id"))]
    found += [f"SELECT '{t}', 'foreign key({c})', {c}, COUNT(*) FROM {t}_t WHERE {c} IS NOT NULL AND {c} NOT IN "
              f"(SELECT id FROM {p}_t WHERE id IS NOT NULL) GROUP BY {c}"
              for t, c, p in (("transacoes", "id_cliente", "clientes"), ("transacao_itens", "id_transacao", "transacoes"),
                              ("transacao_itens", "id_produto", "produtos"))]
    views = [v.replace(" AS (SELECT", "_t AS (SELECT", 1) for v in views]
    return f"WITH entities AS ({SQL['csv_all_entities']}), {', '.join(views)} " + " UNION ALL ".join(found)


SQL["constraint_breaches"] = _breaches()
SQL["csv_round_trip"] = """SELECT o_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
  o_orderpriority AS metodo_pagamento FROM orders"""
SQL["landing_newest_version"] = f"""WITH {CLIENTES}
SELECT id, nome, array_to_string(list_transform(string_split(distrito, ' '),
  lambda w: upper(w[1]) || lower(w[2:])), ' ') AS distrito FROM clientes"""
SQL["landed_day"] = f"""{_text('clientes', 'id', 'nome', 'distrito', n=4)} FROM ({SQL['landing_newest_version']})
UNION ALL {_text('produtos', 'p_partkey', 'p_name', 'p_type', 'CAST(p_retailprice AS DECIMAL(10,2))', n=4)} FROM part
UNION ALL {_text('transacoes', 'o_orderkey', 'o_custkey', 'o_orderpriority', n=4)} FROM orders"""
SQL["landing_oldest_version"] = f"WITH {CLIENTES} SELECT id, nome, distrito FROM clientes"
SQL["load_audit"] = """SELECT 'clientes' AS tabela, 'clientes.csv' AS ficheiro,
  COUNT(*) AS linhas_carregadas, TRUE AS sucesso FROM customer
UNION ALL SELECT 'produtos', 'produtos.csv', COUNT(*), TRUE FROM part
UNION ALL SELECT 'transacoes', 'transacoes.csv', COUNT(*), TRUE FROM orders
UNION ALL SELECT 'transacao_itens', 'transacao_itens.csv',
  CASE WHEN COUNT(*) = COUNT(DISTINCT l_orderkey * 10 + l_linenumber) THEN COUNT(*) ELSE 0 END,
  COUNT(*) = COUNT(DISTINCT l_orderkey * 10 + l_linenumber) FROM lineitem"""
SQL["load_rejects"] = """WITH lines AS (
  SELECT COUNT(*) > COUNT(DISTINCT l_orderkey * 10 + l_linenumber) AS twice,
    COUNT(*) FILTER (l_returnflag = 'A' AND l_quantity = 4) > 0 AS free,
    COUNT(*) FILTER (l_returnflag = 'R' AND l_quantity = 3) > 0 AS broken, COUNT(*) AS n FROM lineitem),
bad AS (
  SELECT 'clientes' AS tabela, COUNT(*) AS n, CASE WHEN COUNT(*) > 1 THEN 'email' ELSE '' END AS colunas FROM customer
  UNION ALL SELECT 'produtos', COUNT(*), CASE WHEN COUNT(*) FILTER (p_size IN (1, 2, 4)) > 0 THEN 'preco' ELSE '' END FROM part
  UNION ALL SELECT 'transacoes', COUNT(*), CASE WHEN COUNT(*) FILTER (
    o_orderpriority = '5-LOW' AND o_orderstatus <> 'F') > 0 THEN 'data_hora' ELSE '' END FROM orders
  UNION ALL SELECT 'transacao_itens', n, concat_ws(',', CASE WHEN twice THEN 'id' END,
    CASE WHEN free THEN 'preco_unitario' END, CASE WHEN broken THEN 'quantidade' END) FROM lines)
SELECT tabela, CASE WHEN colunas = '' THEN n ELSE 0 END AS linhas_carregadas, colunas = '' AS sucesso, colunas FROM bad"""
SQL["loaded_lines"] = """SELECT l_orderkey * ((SELECT COUNT(*) FROM part) + 1) + l_partkey AS id,
  l_orderkey AS id_transacao, l_partkey AS id_produto, CAST(SUM(l_quantity) AS BIGINT) AS quantidade,
  MAX(CAST(l_extendedprice AS DECIMAL(10,2))) AS preco_unitario
FROM lineitem GROUP BY l_orderkey, l_partkey"""
SQL["loaded_products"] = """SELECT p_partkey AS id, p_name AS nome, p_type AS categoria,
  CAST(CASE WHEN p_size >= 40 THEN CAST(p_retailprice AS DECIMAL(10,2)) * 2
    ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS DECIMAL(10,2)) AS preco, p_brand AS fornecedor,
  CASE WHEN p_size >= 40 THEN TIMESTAMP '2025-01-02' ELSE TIMESTAMP '2025-01-01' END AS version_timestamp
FROM part"""
SQL["warehouse_totals"] = f"""WITH {FACT}, pairs AS ({SQL['co_purchase']}),
measures AS (
  SELECT 'dim_products' AS table_name, CAST(p_retailprice AS DECIMAL(10,2)) AS v FROM part
  UNION ALL SELECT 'dim_customer_value', SUM(total_linha) FROM fact GROUP BY customer_id
  UNION ALL SELECT 'fact_recommendations', co_purchase_count FROM pairs
  UNION ALL SELECT 'fact_daily_sales', SUM(total_linha) FROM fact GROUP BY date
  UNION ALL SELECT 'fact_weekly_sales', SUM(total_linha) FROM fact GROUP BY week(date)
  UNION ALL SELECT 'fact_monthly_sales', SUM(total_linha) FROM fact GROUP BY strftime(date, '%Y-%m'))
SELECT table_name, COUNT(*) AS n_rows, CAST(SUM(v) AS {MONEY}) AS total FROM measures GROUP BY table_name"""
_WAREHOUSE = {
    "dim_customer_value": ("customer_id customer_lifetime_value", SQL["customer_lifetime_value"]),
    "fact_recommendations": ("product_id_x product_id_y co_purchase_count", SQL["co_purchase"]),
    "fact_daily_sales": ("date daily_revenue", SQL["daily_revenue"]),
    "fact_weekly_sales": ("week weekly_revenue", SQL["weekly_revenue"]),
    "fact_monthly_sales": ("month monthly_revenue", SQL["monthly_revenue"]),
}
_DIMENSION = "id nome categoria fornecedor preco start_date end_date is_current"


def _measures(table: str, columns: str, source: str, run: int) -> str:
    counted = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in columns.split())
    return (f"SELECT CAST({run} AS BIGINT) AS run, '{table}' AS table_name, n_rows, column_name, n_nulls FROM "
            f"(UNPIVOT (SELECT COUNT(*) AS n_rows, {counted} FROM ({source})) "
            f"ON {', '.join(columns.split())} INTO NAME column_name VALUE n_nulls)")


def _dimension_rows(run: int) -> str:
    """What a build stores of the dimension; the second also closes the old rows of large parts."""
    row = "p_partkey AS id, p_name AS nome, p_type AS categoria, p_brand AS fornecedor, p_retailprice AS preco, 1 AS start_date"
    now = f"SELECT {row}, NULL AS end_date, TRUE AS is_current FROM part"
    return now if run == 0 else f"{now} UNION ALL SELECT {row}, 1, FALSE FROM part WHERE p_size >= 40"


SQL["warehouse_run_metrics"] = "\nUNION ALL ".join(
    [_measures(t, c, q, run) for run in (0, 1) for t, (c, q) in _WAREHOUSE.items()]
    + [_measures("dim_products", _DIMENSION, _dimension_rows(run), run) for run in (0, 1)]
)
SQL["backfilled_days"] = f"""WITH {FACT} SELECT * FROM fact
WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'"""

_REFINED = f"""{DIRTY},
delivered AS (SELECT id, id_cliente, data_hora, metodo_pagamento, 1 AS delivery FROM dt
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), 'corrected', 2 FROM orders WHERE o_orderstatus = 'P'),
checked AS (SELECT *, coalesce(try_strptime(data_hora, '%Y-%m-%d'),
  try_strptime(data_hora, '%Y-%m-%d %H:%M:%S')) AS parsed FROM delivered),
silver AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY delivery DESC) AS nth
  FROM checked WHERE parsed IS NOT NULL) WHERE nth = 1)"""
SQL["lake_silver_months"] = f"""WITH {_REFINED}
SELECT strftime(parsed, '%Y-%m') AS month, COUNT(*) AS n_orders,
  COUNT(*) FILTER (WHERE metodo_pagamento = 'corrected') AS n_corrected,
  MIN(CAST(id AS BIGINT)) AS lowest_id, MAX(parsed) AS latest FROM silver GROUP BY 1"""
_SILVER = """SELECT o_orderkey AS id, o_custkey AS id_cliente,
  CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2010-05-05 05:05:05'
    WHEN o_orderpriority = '5-LOW' THEN CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) ELSE o_orderdate END AS data_hora,
  CASE WHEN o_orderstatus = 'P' THEN 'corrected' ELSE o_orderpriority END AS metodo_pagamento
FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority <> '5-LOW' OR o_orderstatus = 'F'"""
SQL["compacted_orders"] = """SELECT o_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
  CASE WHEN year(o_orderdate) = 1996 THEN 'corrected' ELSE o_orderpriority END AS metodo_pagamento FROM orders"""
SQL["lake_silver_rows"] = f"SELECT *, strftime(data_hora, '%Y-%m') AS month FROM ({_SILVER})"
SQL["lake_gold_revenue"] = f"""SELECT CAST(date_trunc('month', data_hora) AS TIMESTAMP) AS mes,
  {_money(f'SUM({CHARGED})')} AS receita
FROM ({_SILVER}) JOIN lineitem ON l_orderkey = id GROUP BY 1 ORDER BY 1"""
SQL["lake_quarantine"] = f"""WITH {_REFINED}
SELECT id, id_cliente, data_hora, metodo_pagamento FROM checked WHERE parsed IS NULL"""

# --- clicks ---------------------------------------------------------------------

# Values are summed with all their decimals; the total is rounded once.
_MEASURES = f"COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(28,10))) AS {MONEY}) AS total_value"
_TUMBLING = f"""SELECT event_type, date_trunc('hour', ts) AS window_start,
  date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {_MEASURES}
FROM events GROUP BY ALL"""
_SLIDING = f"""SELECT event_type, window_start, window_start + INTERVAL 1 HOUR AS window_end, {_MEASURES}
FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(CAST(15 * k AS INTEGER)) AS window_start
  FROM events, range(4) r(k)) GROUP BY ALL"""
_SESSIONS = f"""SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end, {_MEASURES}
FROM (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS nth
  FROM (SELECT *, CASE WHEN ts <= LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
    THEN 0 ELSE 1 END AS opens FROM events))
GROUP BY user_id, nth"""


def _closed(sql: str, end: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE {end} <= (SELECT MAX(ts) FROM events) - INTERVAL 2 DAY"


def _session_columns(sql: str) -> str:
    return f"SELECT user_id, session_start, session_end, n_events, total_value FROM ({sql})"


SQL["clicks_tumbling"] = _TUMBLING
SQL["clicks_sliding"] = _SLIDING
SQL["clicks_sliding_uneven"] = f"""SELECT event_type, window_start, window_start + INTERVAL 60 MINUTE AS window_end, {_MEASURES}
FROM (SELECT *, time_bucket(INTERVAL 25 MINUTE, ts, TIMESTAMP '1970-01-01') - to_minutes(CAST(25 * k AS INTEGER)) AS window_start
  FROM events, range(3) r(k)) WHERE ts < window_start + INTERVAL 60 MINUTE GROUP BY ALL"""
SQL["clicks_sessions"] = _session_columns(_SESSIONS)
SQL["stream_tumbling"] = _closed(_TUMBLING, "window_end")
SQL["stream_sliding"] = _closed(_SLIDING, "window_end")
SQL["stream_sessions"] = _session_columns(_closed(_SESSIONS, "session_end"))
SQL["stream_latest_versions"] = SQL["latest_version"]
_HELD = "(event_type = 'purchase' AND coalesce(value, 30) < 30 AND ts < TIMESTAMP '2024-01-20')"
SQL["stream_late_events"] = f"""SELECT event_id, ts, user_id, event_type, value FROM events
WHERE {_HELD} AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events WHERE NOT {_HELD}) - INTERVAL 2 DAY"""
SQL["stream_corrected_windows"] = _closed(f"""SELECT event_type, date_trunc('hour', ts) AS window_start,
  date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, {_MEASURES}, bool_or({_HELD}) AS corrected
FROM events GROUP BY ALL""", "window_end")
SQL["stream_merged_orders"] = """SELECT o_orderkey AS id, o_custkey AS id_cliente, o_orderdate AS data_hora,
  CASE WHEN o_orderstatus = 'P' THEN 'corrected' ELSE o_orderpriority END AS metodo_pagamento,
  CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2002-02-01' ELSE TIMESTAMP '2002-01-01' END AS version_timestamp
FROM orders"""

# --- personal data and features -------------------------------------------------

SQL["pii_scan"] = "\nUNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS hits "
    f"FROM documents WHERE regexp_matches(text, '{p}')"
    for kind, p in PATTERNS.items()
)
_MASKED = "text"
for _kind, _p in PATTERNS.items():
    _MASKED = f"regexp_replace({_MASKED}, '{_p}', '<{_kind}>', 'g')"
SQL["pii_masked"] = f"SELECT doc_id, {_MASKED} AS text FROM documents"
_HITS = "\nUNION ALL ".join(
    f"SELECT '{c}' AS coluna, '{kind}' AS tipo, COUNT(*) AS linhas, "
    f"COUNT(*) FILTER (WHERE regexp_matches({c}, '{p}')) AS linhas_com_dados FROM documents"
    for c in ("text", "lang", "source") for kind, p in PATTERNS.items()
)
SQL["pii_columns"] = f"""SELECT *, CASE WHEN linhas_com_dados > 0 AND linhas_com_dados >= 0.01 * linhas
  THEN 'pessoal' ELSE 'limpa' END AS classe FROM ({_HITS})"""
SQL["pii_pseudonyms"] = f"WITH {CLIENTES} SELECT id, sha256('s3cr3t|' || email) AS email_key FROM clientes"

_FEATURES = f"""{ORDER_REVENUE},
months AS (SELECT id_cliente AS customer_id, CAST(date_trunc('month', data_hora) AS DATE) AS month,
  COUNT(*) AS n, SUM(receita) AS s, MAX(data_hora) AS last_at FROM order_revenue GROUP BY ALL),
versions AS (SELECT customer_id, 'v1' AS feature_version,
  CAST(month + INTERVAL 1 MONTH AS DATE) AS valid_from,
  CAST(LEAD(month) OVER w + INTERVAL 1 MONTH AS DATE) AS valid_to,
  CAST(SUM(n) OVER w AS BIGINT) AS orders_to_date, CAST(SUM(s) OVER w AS {MONEY}) AS spend_to_date,
  MAX(last_at) OVER w AS last_order
  FROM months WINDOW w AS (PARTITION BY customer_id ORDER BY month))"""
SQL["customer_features"] = f"WITH {_FEATURES} SELECT * FROM versions"
SQL["features_as_of"] = f"""WITH {_FEATURES},
kept AS (SELECT * REPLACE ('v2' AS feature_version, valid_from + INTERVAL 14 DAY AS valid_from,
  valid_to + INTERVAL 10 DAY AS valid_to) FROM versions)
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS data_hora,
  o_orderpriority = '1-URGENT' AS urgent, feature_version, valid_from, orders_to_date, spend_to_date, last_order
FROM orders ASOF LEFT JOIN kept ON customer_id = o_custkey AND o_orderdate >= valid_from"""
SQL["features_as_of"] = f"""SELECT order_id, customer_id, data_hora, urgent,
  CASE WHEN ok THEN feature_version END AS feature_version, CASE WHEN ok THEN valid_from END AS valid_from,
  CASE WHEN ok THEN orders_to_date END AS orders_to_date, CASE WHEN ok THEN spend_to_date END AS spend_to_date,
  CASE WHEN ok THEN last_order END AS last_order
FROM (SELECT *, valid_to IS NULL OR data_hora < valid_to AS ok FROM ({SQL["features_as_of"].replace("valid_from, orders_to_date", "valid_from, valid_to, orders_to_date")}))"""
SQL["customer_features_trailing"] = f"""WITH {ORDER_REVENUE},
daily AS (SELECT id_cliente AS customer_id, CAST(data_hora AS DATE) AS day, COUNT(*) AS n, SUM(receita) AS spend
  FROM order_revenue WHERE id_cliente IS NOT NULL GROUP BY ALL)
SELECT customer_id, 'v1' AS feature_version, day,
  CAST(SUM(n) OVER m AS BIGINT) AS orders_30d, CAST(SUM(spend) OVER m AS {MONEY}) AS spend_30d,
  CAST(SUM(n) OVER q AS BIGINT) AS orders_90d, CAST(SUM(spend) OVER q AS {MONEY}) AS spend_90d
FROM daily WINDOW m AS (PARTITION BY customer_id ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW),
  q AS (PARTITION BY customer_id ORDER BY day RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW)"""


def _k_anonymous(k: int) -> str:
    """The same turns, each column told one level finer where all parts keep k rows."""
    levels = {"d": 4, "r": 2, "s": 1}
    steps = [f"""s0 AS (SELECT coalesce(strftime(d, '%Y'), '?') AS d1,
  coalesce(strftime(d, '%Y') || '-Q' || quarter(d), '?') AS d2, coalesce(strftime(d, '%Y-%m'), '?') AS d3,
  coalesce(strftime(d, '%Y-%m-%d'), '?') AS d4, coalesce(r_name, '?') AS r1, coalesce(n_name, '?') AS r2,
  coalesce(c_mktsegment, '?') AS s1, CAST(c_acctbal AS DECIMAL(14,2)) AS saldo,
  '*' AS td, '*' AS tr, '*' AS ts, 0 AS ld, 0 AS lr, 0 AS ls
FROM customer LEFT JOIN (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""]
    group, at = "td, tr, ts, ld, lr, ls", 0
    for turn in range(4):
        for c, depth in levels.items():
            if turn >= depth:
                continue
            finer = f"CASE l{c} " + " ".join(f"WHEN {i} THEN {c}{i + 1}" for i in range(depth)) + " END"
            steps += [
                f"p{at} AS (SELECT *, {finer} AS finer, COUNT(*) OVER (PARTITION BY {group}, {finer}) AS part FROM s{at})",
                f"f{at} AS (SELECT *, l{c} < {depth} AND MIN(part) OVER (PARTITION BY {group}) >= {k} AS fits FROM p{at})",
                f"s{at + 1} AS (SELECT * EXCLUDE (finer, part, fits) REPLACE (CASE WHEN fits THEN finer ELSE t{c} END AS t{c}, "
                f"CASE WHEN fits THEN l{c} + 1 ELSE l{c} END AS l{c}) FROM f{at})",
            ]
            at += 1
    return (f"WITH {', '.join(steps)} SELECT tr AS distrito, ts AS segmento, td AS primeira_encomenda, saldo FROM s{at} "
            f"WHERE (SELECT COUNT(*) FROM s0) >= {k}")


SQL["clientes_k_anonymous"] = _k_anonymous(20)
SQL["product_features"] = """WITH sold AS (SELECT l_partkey, COUNT(*) AS lines,
  CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units FROM lineitem GROUP BY l_partkey)
SELECT p_partkey AS product_id, 'v1' AS feature_version, p_type AS categoria,
  CAST(p_retailprice AS DECIMAL(10,2)) AS preco, coalesce(lines, 0) AS lines_sold, coalesce(units, 0) AS units_sold
FROM part LEFT JOIN sold ON p_partkey = l_partkey"""

ORACLE_SQL = SQL
