"""Second-level figures over small aggregates: re-aggregations, shares, rankings, and facts of a series.

Means of wages are unweighted means of group means, which is what the compared figures are; the *_ponderado columns beside
them weigh by admissions. Null keys are left out, and rankings break ties by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import exact_mean


def reaggregate(df: DataFrame, key: str, weighted: bool = False) -> DataFrame:
    """Sums of balance and admissions, and the mean of mean wages, by one key."""
    out = [F.sum("saldo").alias("saldo"), F.sum("admissoes").alias("admissoes"), exact_mean(F.col("salario_medio")).alias("salario_medio")]
    if weighted:
        held = F.when(F.col("salario_medio").isNotNull(), F.col("admissoes"))
        out.append((F.sum(F.col("salario_medio") * held) / F.nullif(F.sum(held), F.lit(0))).alias("salario_medio_ponderado"))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*out)


def period(df: DataFrame, first: int, last: int) -> DataFrame:
    return df.filter(F.col("ano").between(first, last))


def top(df: DataFrame, key: str, by: str, n: int, ascending: bool = False, label: int = 0) -> DataFrame:
    """The n rows with the highest by (with ties to the smaller key), highest first or, for bars, last. label: width of
    a shortened key in rotulo."""
    chosen = df.orderBy(F.desc(by), F.asc(key)).limit(n)
    if label:
        chosen = chosen.withColumn("rotulo", F.substring(key, 1, label))
    return chosen.orderBy(F.asc(by), F.desc(key)) if ascending else chosen


def top_hiring_sections(lenses: DataFrame, n: int = 10) -> DataFrame:
    """Sections that hire most technology professionals outside the sector."""
    return top(reaggregate(lenses.filter(F.col("categoria").contains("fora")), "setor_empresa"), "setor_empresa", "admissoes", n)


def share_outside(lenses: DataFrame) -> DataFrame:
    """Of admissions of technology professionals, the percentage outside the sector."""
    mine = lenses.filter(F.col("categoria").startswith("Profissional de TI"))
    outside = F.sum(F.when(F.col("categoria").contains("fora"), F.col("admissoes")).otherwise(0))
    return mine.agg(outside.alias("fora"), F.sum("admissoes").alias("total"), F.try_divide(outside * F.lit(100.0), F.sum("admissoes")).alias("fora_pct"))


def women_share_and_gap(people: DataFrame, women: str = "Mulher", men: str = "Homem") -> DataFrame:
    """Women's percentage of admissions, and how much less they are paid than men, in percent."""
    by = reaggregate(people, "sexo")
    pick = lambda word, c: F.min_by(F.when(F.col("sexo").contains(word), F.col(c)), F.when(F.col("sexo").contains(word), F.col("sexo")))
    w, m = pick(women, "salario_medio"), pick(men, "salario_medio")
    share = F.try_divide(pick(women, "admissoes") * F.lit(100.0), F.sum("admissoes"))
    return by.agg(share.alias("participacao_pct"), ((F.lit(1.0) - F.try_divide(w, m)) * 100).alias("diferenca_pct"))


def schooling_ratio(people: DataFrame) -> DataFrame:
    """Highest over lowest mean wage by schooling; null where the lowest is 0 or unknown."""
    by = reaggregate(people, "escolaridade")
    known = by.filter(F.col("salario_medio").isNotNull())
    high, low = F.max(F.struct("salario_medio", "escolaridade")), F.min(F.struct("salario_medio", "escolaridade"))
    return known.agg(high.alias("h"), low.alias("l"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("h.escolaridade").alias("topo"), F.col("l.escolaridade").alias("base"), F.try_divide(F.col("h.salario_medio"), F.col("l.salario_medio")).alias("razao")
    )


def year_over_year(series: DataFrame, value: str = "saldo", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds anterior and variacao. Series are small aggregates; by: keys of several of them."""
    before = F.lag(value).over(W.partitionBy(*by).orderBy("ano"))
    return series.withColumns({"anterior": before, "variacao": F.col(value) - before})


def flag_partial_year(series: DataFrame) -> DataFrame:
    """Marks the last year, which is released month by month."""
    return series.crossJoin(F.broadcast(series.agg(F.max("ano").alias("_last")))).withColumn("parcial", F.col("ano") == F.col("_last")).drop("_last")


def argbest(value: str, key: str, largest: bool = True) -> Column:
    """Struct (v, k) of the largest or smallest value; of equal ones, that with the smallest key."""
    order = F.struct(F.col(value).alias("v"), (-F.col(key)).alias("k")) if largest else F.struct(F.col(value).alias("v"), F.col(key).alias("k"))
    best = F.max(order) if largest else F.min(order)
    return F.struct(best["v"].alias("v"), (-best["k"] if largest else best["k"]).alias("k"))


def history_arc(annual: DataFrame) -> DataFrame:
    """One row of facts of an annual series (ano, saldo, admissoes, salario_medio). Comparisons leave the last year
    out, unless it is the only one."""
    last = annual.agg(F.max("ano").alias("last"), F.min("ano").alias("first"))
    closed = annual.crossJoin(F.broadcast(last)).filter((F.col("ano") < F.col("last")) | (F.col("first") == F.col("last")))
    moved = year_over_year(closed.select("ano", "saldo"))
    fallen = F.when(F.col("variacao").isNotNull(), F.struct("variacao", "ano", "anterior"))
    facts = moved.agg(
        argbest("saldo", "ano").alias("best"), F.min(fallen).alias("fall"),
        F.array_sort(F.collect_list(F.when(F.col("saldo") < 0, F.col("ano")))).alias("anos_negativos"),
        F.coalesce(F.sum(F.when(F.col("saldo") < 0, F.col("saldo"))), F.lit(0)).alias("saldo_negativo"),
    )
    whole = annual.agg(
        F.min("ano").alias("ano_inicio"), F.max("ano").alias("ano_fim"), F.sum("saldo").alias("saldo_total"), F.sum("admissoes").alias("admissoes_total"),
        F.min(F.struct("ano", "salario_medio"))["salario_medio"].alias("salario_inicio"), F.max(F.struct("ano", "salario_medio"))["salario_medio"].alias("salario_fim"),
    )
    return whole.filter("ano_inicio IS NOT NULL").crossJoin(F.broadcast(facts)).select(
        "ano_inicio", "ano_fim", "saldo_total", "admissoes_total", F.col("best.k").alias("melhor_ano"), F.col("best.v").alias("melhor_saldo"), "anos_negativos",
        "saldo_negativo", F.col("fall.ano").alias("ano_queda"), F.col("fall.variacao").alias("queda_valor"), F.col("fall.anterior").alias("queda_de"), "salario_inicio", "salario_fim",
    )


def arc_ratios(arc: DataFrame) -> DataFrame:
    """The fall in percent of the level before, and the last wage as a multiple of the first."""
    fall = F.try_divide(F.abs("queda_valor") * F.lit(100.0), F.col("queda_de"))
    return arc.select("ano_inicio", "ano_fim", fall.alias("queda_pct"), F.try_divide("salario_fim", "salario_inicio").alias("multiplo_salario"))


def profile(movements: DataFrame, year: int) -> DataFrame:
    """Rows by state, sex and race in a year."""
    return movements.filter(F.col("ano_particao") == year).groupBy(F.col("uf_descricao").alias("uf"), F.col("sexo_descricao").alias("sexo"), F.col("racacor_descricao").alias("raca_cor")).agg(F.count("*").alias("n"))
