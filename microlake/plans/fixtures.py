"""The given tables in the shapes that the operators expect, in SQL that Spark and the oracle share but for the month."""

from .. import constants as C

MOV = """
SELECT l_orderkey, l_linenumber, {ym} AS competenciamov, CAST(year(l_shipdate) AS INT) AS ano_particao, CAST(month(l_shipdate) AS INT) AS mes_particao,
       CASE l_suppkey % 6 WHEN 0 THEN '6201501' WHEN 1 THEN '6204000' WHEN 2 THEN '4711302'
            WHEN 3 THEN '6422100' WHEN 4 THEN '8411600' ELSE '00000-1' END AS subclasse,
       CASE l_partkey % 7 WHEN 0 THEN '212405' WHEN 1 THEN '317110' WHEN 2 THEN '317210'
            WHEN 3 THEN '212305' WHEN 4 THEN '313220' WHEN 5 THEN '521110' ELSE '411010' END AS cbo2002ocupacao,
       lpad(CAST(s_nationkey AS VARCHAR(10)), 2, '0') AS uf, CAST(n_regionkey AS VARCHAR(10)) AS regiao,
       lpad(CAST(l_suppkey AS VARCHAR(10)), 6, '0') AS municipio,
       CASE l_linenumber % 3 WHEN 0 THEN '1' WHEN 1 THEN '3' ELSE '9' END AS sexo,
       CAST(l_partkey % 6 + 1 AS VARCHAR(5)) AS racacor, lpad(CAST(l_partkey % 11 + 1 AS VARCHAR(5)), 2, '0') AS graudeinstrucao,
       CASE WHEN l_returnflag = 'R' THEN '-1' ELSE '1' END AS saldomovimentacao,
       CASE WHEN l_discount = 0 THEN '0,00'
            ELSE replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20)), '.', ',') END AS salario,
       CAST(CAST(l_quantity AS INT) AS VARCHAR(5)) AS idade
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""

LEDGER = """
SELECT CASE user_id % 4 WHEN 0 THEN 'caged_mov' WHEN 1 THEN 'caged_old' WHEN 2 THEN 'rais_vinc' ELSE 'rais_estab' END AS tabela,
       CAST(user_id AS VARCHAR(20)) AS arquivo_fonte, event_id AS seq, ts AS data_hora, CAST(year(ts) AS INT) AS ano,
       CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN 'erro' ELSE 'ok' END AS status, CAST(round(value * 100) AS BIGINT) AS linhas, CAST(round(value * 1000) AS BIGINT) AS bytes_compactado, value AS segundos
FROM events
"""

INVENTORY = """
SELECT o_orderkey AS item, CASE o_orderkey % 9 WHEN 0 THEN 'CAGEDMOV' || {ym} || '.7z' WHEN 1 THEN 'CAGEDEST_' || {m} || {y} || '.7z'
            WHEN 2 THEN 'ESTB' || {y} || '.7z' WHEN 3 THEN 'sp' || {y} || '.zip' WHEN 4 THEN 'CAGEDEST_AJUSTES_' || {m} || {y} || '.7z'
            WHEN 5 THEN 'CAGEDEST_AJUSTES_' || {y} || '.7z' WHEN 6 THEN 'IGNORANDOS' || {y} || '.7z'
            WHEN 7 THEN 'RAIS_VINC_PUB_SUL.7z' ELSE 'leia-me.7z' END AS nome_arquivo,
       CAST({y} AS INT) AS ano_pasta, o_orderkey % 11 = 0 AS parcial, CAST(round(o_totalprice) AS BIGINT) AS tamanho
FROM orders
"""

#: Code books, as sheets.
SHEETS = {
    "uf": ("colon", "SELECT CONCAT(CAST(n_nationkey AS VARCHAR(5)), ':', n_name) AS col_00 FROM nation UNION ALL SELECT 'Lista de UF'"),
    "regiao": ("2col", "SELECT CAST(r_regionkey AS VARCHAR(5)) AS col_00, r_name AS col_01 FROM region UNION ALL SELECT 'Código', 'Descrição'"),
    "municipio": ("colon", "SELECT CONCAT(CAST(s_suppkey AS VARCHAR(10)), ':', s_name) AS col_00 FROM supplier"),
    "sexo": ("titulo_codigo", "SELECT DISTINCT CASE l_linenumber % 3 WHEN 0 THEN 'Homem' ELSE 'Mulher' END AS col_00, CASE l_linenumber % 3 WHEN 0 THEN '1' ELSE '3' END AS col_01 FROM lineitem WHERE l_linenumber % 3 < 2 UNION ALL SELECT 'Sexo', NULL UNION ALL SELECT 'x', 'Valor na Fonte'"),
    "racacor": ("2col", "SELECT CAST(p_partkey % 6 + 1 AS VARCHAR(5)) AS col_00, p_brand AS col_01 FROM part"),
    "graudeinstrucao": ("2col", "SELECT CAST(p_partkey % 11 + 1 AS VARCHAR(5)) AS col_00, CONCAT(p_type, ' ', CAST(p_partkey % 11 AS VARCHAR(5))) AS col_01 FROM part WHERE p_partkey % 11 < 10"),
    "cbo2002ocupacao": ("2col", "SELECT CASE p_partkey % 7 WHEN 0 THEN '212405' WHEN 1 THEN '317110' WHEN 2 THEN '317210' WHEN 3 THEN '212305' WHEN 4 THEN '313220' WHEN 5 THEN '521110' ELSE '411010' END AS col_00, p_name AS col_01 FROM part"),
}
SPARK_MONTH, DUCK_MONTH = "date_format(l_shipdate, 'yyyyMM')", "strftime(l_shipdate, '%Y%m')"
SPARK_DATES = {"ym": "date_format(o_orderdate, 'yyyyMM')", "m": "date_format(o_orderdate, 'MM')", "y": "date_format(o_orderdate, 'yyyy')"}
DUCK_DATES = {"ym": "strftime(o_orderdate, '%Y%m')", "m": "strftime(o_orderdate, '%m')", "y": "strftime(o_orderdate, '%Y')"}

_ACTIVITY = "CASE {k} % 4 WHEN 0 THEN '6201501' WHEN 1 THEN '6204000' WHEN 2 THEN '4711302' ELSE '00000-1' END"
_LINKS, _PLACES = C.CENSUS_WORKBOOKS["rais_vinc"], C.CENSUS_WORKBOOKS["rais_estab"]


def _layout(first: str, second: str) -> str:
    """A layout sheet with two fields in turn, each of 20 lines."""
    return f"SELECT p_partkey AS row_index, CASE p_partkey % 40 WHEN 1 THEN '{first}' WHEN 21 THEN '{second}' END AS col_00, p_type AS col_03, CAST(p_partkey % 20 AS VARCHAR(5)) AS col_04 FROM part"


_TOWNS = "SELECT CONCAT(CAST(s_suppkey AS VARCHAR(10)), ':', '{word}', s_name) AS col_00 FROM supplier UNION ALL SELECT 'Município'"
#: Tables with a map of their own: the text, the columns that are summed, and the sheets by workbook and name. Sheets of other
#: workbooks have the same names.
CENSUS = {
    "rais_vinc": (
        f"""SELECT lpad(CAST(l_suppkey AS VARCHAR(10)), 6, '0') AS municipio, {_ACTIVITY.format(k='l_suppkey')} AS cnae_20_subclasse,
        CASE l_partkey % 3 WHEN 0 THEN '212405' WHEN 1 THEN '317110' ELSE '411010' END AS cbo_ocupacao_2002, CAST(l_linenumber % 3 AS VARCHAR(5)) AS sexo_trabalhador,
        lpad(CAST(l_partkey % 13 AS VARCHAR(5)), 2, '0') AS mes_admissao, CAST(CAST(l_quantity AS INT) AS VARCHAR(5)) AS idade,
        replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20)), '.', ',') AS vl_remun_media_nom, CAST(year(l_shipdate) AS INT) AS ano_particao FROM lineitem""",
        ("idade", "vl_remun_media_nom"),
        {
            (_LINKS, "municipio"): _TOWNS.format(word=""), ("rais_vinculos_layout2012", "municipio"): _TOWNS.format(word="alt "), (_PLACES, "municipio"): _TOWNS.format(word="estab "),
            (_LINKS, "raisd_layout"): _layout("SEXO", "RACA_COR"), (_LINKS, "mes_adm_ou_desl"): "SELECT CAST(p_partkey % 13 AS VARCHAR(5)) AS col_00, p_brand AS col_01 FROM part WHERE p_partkey % 13 < 12 UNION ALL SELECT 'Categorias', 'x'",
        },
    ),
    "rais_estab": (
        f"""SELECT lpad(CAST(o_custkey % 100 AS VARCHAR(10)), 6, '0') AS municipio, {_ACTIVITY.format(k='o_custkey')} AS cnae_20_subclasse, lpad(CAST(o_custkey % 21 AS VARCHAR(5)), 2, '0') AS tamanho_estabelecimento,
        CAST(o_custkey % 15 AS VARCHAR(5)) AS bairros_sp, CAST(o_custkey % 300 AS VARCHAR(5)) AS qtd_vinculos_ativos, CAST(year(o_orderdate) AS INT) AS ano_particao FROM orders""",
        ("qtd_vinculos_ativos",),
        {
            (_PLACES, "municipio"): _TOWNS.format(word="estab "), (_LINKS, "municipio"): _TOWNS.format(word=""), (_PLACES, "estb_layout"): _layout("Tamanho Estabelecimento", "Tipo Estab"),
            (_PLACES, "bairro_sp"): "SELECT p_type AS col_00, p_name AS col_01, CAST(p_partkey % 14 AS VARCHAR(5)) AS col_02 FROM part UNION ALL SELECT 'x', 'y', 'Valor na Fonte'",
        },
    ),
    "caged_ajustes": (
        f"""SELECT lpad(CAST(o_custkey % 100 AS VARCHAR(10)), 6, '0') AS municipio, {_ACTIVITY.format(k='o_custkey')} AS cnae_20_subclas, CASE o_custkey % 3 WHEN 0 THEN '212405' ELSE '411010' END AS cbo_2002_ocupacao,
        CAST(o_custkey % 4 AS VARCHAR(5)) AS sexo, {{ym}} AS competencia_movimentacao, replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR(20)), '.', ',') AS salario_mensal,
        CASE WHEN o_orderstatus = 'F' THEN '-1' ELSE '1' END AS saldo_mov, CAST(year(o_orderdate) AS INT) AS ano_particao FROM orders""",
        ("salario_mensal", "saldo_mov"),
        {(None, "municipio"): _TOWNS.format(word=""), (None, "cagestid_layout"): _layout("SEXO", "RACACOR")},
    ),
}
