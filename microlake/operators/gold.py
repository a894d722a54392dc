"""Aggregates of movements: the gold tables, the published ones, the unified series, and the long-series tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import area_of, is_tech_occupation, is_tech_sector, lens_category, metrics, section_of, with_lenses

GOLD_ROWS, PUBLISHED_ROWS = 200, 50


def aggregate(df: DataFrame, keys: dict[str, str | Column], measures: list[Column], needed: tuple[str, ...] = (), least_rows: int = 0) -> DataFrame:
    """Measures by keys (name: column). needed: keys that may not be null; least_rows: groups below it go."""
    named = df.withColumns({k: F.col(c) if isinstance(c, str) else c for k, c in keys.items()})
    for k in needed:
        named = named.filter(F.col(k).isNotNull())
    if not least_rows:
        return named.groupBy(*keys).agg(*measures)
    return named.groupBy(*keys).agg(*measures, F.count("*").alias("_rows")).filter(F.col("_rows") >= least_rows).drop("_rows")


_MONTH, _YEAR, _UF, _SECTION = {"competencia": "competenciamov_data"}, {"ano": "ano_particao"}, {"uf": "uf_descricao"}, {"setor": "secao_descricao"}
_LENSES = {"setor_ti": "setor_ti", "ocupacao_ti": "ocupacao_ti"}
_PEOPLE = {"sexo": "sexo_descricao", "raca_cor": "racacor_descricao", "escolaridade": "graudeinstrucao_descricao"}

#: name: (keys, those that may not be null, least rows)
GOLD = {
    "saldo_mensal": (_MONTH | _LENSES, ("competencia",), 0),
    "saldo_uf": (_MONTH | _UF | {"regiao": "regiao_descricao"} | _LENSES, ("competencia", "uf"), 0),
    "saldo_setor": (_MONTH | _SECTION | {"ocupacao_ti": "ocupacao_ti"}, ("competencia", "setor"), 0),
    "perfil_demografico": (_MONTH | _PEOPLE | _LENSES, ("competencia",), 0),
    "ocupacoes": (_YEAR | {"ocupacao": "cbo2002ocupacao_descricao"} | _LENSES, ("ocupacao",), GOLD_ROWS),
    "saldo_municipio": (_YEAR | _UF | {"municipio": "municipio_descricao", "ocupacao_ti": "ocupacao_ti"}, ("municipio",), 0),
    "ti_setor_vs_ocupacao": (_YEAR | _LENSES | {"setor_empresa": "secao_descricao"}, (), 0),
}
PUBLISHED = {
    "mensal": (_MONTH, ("competencia",), 0),
    "mensal_uf": (_MONTH | _UF | {"regiao": "regiao_descricao"}, ("competencia", "uf"), 0),
    "setor": (_YEAR | _SECTION, ("setor",), 0),
    "ocupacao": (_YEAR | {"ocupacao": "cbo2002ocupacao_descricao"}, ("ocupacao",), PUBLISHED_ROWS),
    "demografia": (_YEAR | _PEOPLE, (), 0),
}
LONG = {
    "serie_longa_anual": (("ano", "geracao"), (), 0),
    "serie_longa_mensal": (("competencia",), ("competencia",), 0),
    "setor_longo": (("ano", "setor"), ("setor",), 0),
    "uf_longo": (("ano", "uf"), ("uf",), 0),
    "ocupacao_longa": (("ano", "ocupacao"), ("ocupacao",), PUBLISHED_ROWS),
    "demografia_longa": (("ano", "sexo", "raca_cor", "escolaridade"), (), 0),
}


def gold(silver: DataFrame, name: str) -> DataFrame:
    """One of the seven gold tables. The labelled base is one plan, so it can be persisted once if several are built."""
    keys, needed, least = GOLD[name]
    base = with_lenses(silver)
    if name == "ti_setor_vs_ocupacao":
        base = base.filter(F.col("ocupacao_ti") | F.col("setor_ti"))
    return aggregate(base, keys, metrics(wage_name="salario_medio_admissao", age_name="idade_media_admissao"), needed, least)


#: Columns of partials that add up.
_SUMS = ("admissoes", "desligamentos", "saldo", "salario_soma", "salario_n", "idade_soma", "idade_n", "_rows")
MONTH = ("ano_particao", "mes_particao")


def gold_partials(silver: DataFrame, name: str) -> DataFrame:
    """What a gold table needs of each month of the silver, by month and the table's keys: counts and exact sums, which add up. A
    month's partials depend on its rows alone, so a month that is new or has changed is built by itself."""
    keys, needed, _ = GOLD[name]
    base = with_lenses(silver)
    if name == "ti_setor_vs_ocupacao":
        base = base.filter(F.col("ocupacao_ti") | F.col("setor_ti"))
    b, wage, age = F.col("saldomovimentacao"), F.col("salario"), F.col("idade")
    paid, aged = F.when((b == 1) & (wage > 0), wage).cast("decimal(28,6)"), F.when(b == 1, age).cast("decimal(28,6)")
    sums = (F.count_if(b == 1), F.count_if(b == -1), F.sum(b).cast("long"), F.sum(paid), F.count(paid), F.sum(aged), F.count(aged), F.count("*"))
    return aggregate(base, {m: m for m in MONTH} | {k: c for k, c in keys.items()}, [x.alias(n) for x, n in zip(sums, _SUMS, strict=True)], needed)


def gold_of_partials(partials: DataFrame, name: str) -> DataFrame:
    """The gold table of the partials of all months; the same as gold() of all rows."""
    keys, _, least = GOLD[name]
    one = partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS]).filter(F.col("_rows") >= least)
    mean = lambda s, n, places: F.round(F.col(s).cast("double") / F.nullif(F.col(n), F.lit(0)), places)
    return one.select(*keys, "admissoes", "desligamentos", "saldo", mean("salario_soma", "salario_n", 2).alias("salario_medio_admissao"), mean("idade_soma", "idade_n", 1).alias("idade_media_admissao"))


def published(silver: DataFrame, name: str) -> DataFrame:
    """One of the six published tables."""
    if name == "lentes":
        category = lens_category(is_tech_sector("subclasse"), is_tech_occupation("cbo2002ocupacao"))
        return aggregate(silver, {"ano": "ano_particao", "categoria": category, "setor_empresa": "secao_descricao"}, metrics())
    keys, needed, least = PUBLISHED[name]
    return aggregate(silver, keys, metrics(), needed, least)


def long_series(unified: DataFrame, name: str) -> DataFrame:
    """One of the six tables over both generations."""
    keys, needed, least = LONG[name]
    return aggregate(unified, {k: k for k in keys}, metrics("saldo"), needed, least)


#: Unified column: its column in the new and in the old layout (None: derived).
_UNIFIED = {
    "competencia": ("competenciamov_data", "competencia_declarada_data"), "ano": ("ano_particao",) * 2, "mes": ("mes_particao",) * 2,
    "uf": ("uf_descricao",) * 2, "municipio": ("municipio_descricao",) * 2, "setor": ("secao_descricao", None),
    "cnae_subclasse": ("subclasse", "cnae_20_subclas"), "cnae_subclasse_descricao": ("subclasse_descricao", "cnae_20_subclas_descricao"),
    "cbo": ("cbo2002ocupacao", "cbo_2002_ocupacao"), "ocupacao": ("cbo2002ocupacao_descricao", "cbo_2002_ocupacao_descricao"), "area_ti": (None, None),
    "sexo": ("sexo_descricao",) * 2, "raca_cor": ("racacor_descricao", "raca_cor_descricao"), "escolaridade": ("graudeinstrucao_descricao", "grau_instrucao_descricao"),
    "idade": ("idade",) * 2, "saldo": ("saldomovimentacao", "saldo_mov"), "salario": ("salario", "salario_mensal"),
    "tipo_movimentacao": ("tipomovimentacao_descricao", "tipo_mov_desagregado_descricao"),
}


def harmonised(silver: DataFrame, old: bool) -> DataFrame:
    """One generation's rows with the 19 names of the unified table. The old layout's section comes from its activity
    code."""
    sector, occupation = C.SCOPE_COLUMNS["caged_old" if old else "caged_mov"]
    derived = {"setor": section_of(sector), "area_ti": area_of(occupation)}
    held = lambda c: F.col(c) if c in silver.columns else F.lit(None).cast("string")
    columns = [(held(pair[old]) if pair[old] else derived[name]).alias(name) for name, pair in _UNIFIED.items()]
    return silver.select(*columns, F.lit(C.OLD_LAYOUT if old else C.NEW_LAYOUT).alias("geracao"))


def unify(new: DataFrame, old: DataFrame) -> DataFrame:
    """Both generations in one table."""
    return harmonised(new, False).unionByName(harmonised(old, True), allowMissingColumns=True)


def union_summary(unified: DataFrame) -> DataFrame:
    return unified.agg(F.count("*").alias("linhas"), F.min("ano").alias("ano_min"), F.max("ano").alias("ano_max"), F.count_distinct("setor").alias("setores"))


def sector_coverage(unified: DataFrame) -> DataFrame:
    return unified.groupBy("geracao").agg((F.count("setor") / F.count("*") * 100).alias("cobertura_pct"))
