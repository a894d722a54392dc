from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from microlake import constants as C
from microlake.functions import columns as X


def values(spark, cells, column, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_clean_text(spark):
    assert values(spark, ["  x ", "   ", " x　", "a b", None, "\tx"], X.clean_text("c")) == ["x", None, "x", "a b", None, "\tx"]


def test_decimal_comma(spark):
    assert values(spark, ["000005,10", "", "1.234,56", "7", "1d", None, "-,5"], X.decimal_comma("c", "double")) == [5.1, None, None, 7.0, None, None, -0.5]
    assert values(spark, ["12,5", "300", "-1", "x", "12,4"], X.decimal_comma("c", "tinyint")) == [13, None, -1, None, 12]
    assert values(spark, ["-12,5", "40000", "2147483648"], X.decimal_comma("c", "int")) == [-13, 40000, None]


def test_yyyymm(spark):
    got = values(spark, ["202401", "202413", "", "2024010", None, " 199912 "], X.yyyymm("c").cast("string"))
    assert got == ["2024-01-01", None, None, None, None, "1999-12-01"]


def test_canonical_key(spark):
    assert values(spark, ["07", "7", " A ", "", None, "12.7", "000"], X.canonical_key("c")) == ["7", "7", "A", "", None, "12.7", "0"]


def test_section(spark):
    got = values(spark, ["6201501", "00000-1", "0111301", "3400000", "1", None], X.section_of("c"))
    assert got == ["Informação e Comunicação", None, C.SECTIONS[0][2], None, None, None]
    every = [f"{a:02d}00000" for a, _, _ in C.SECTIONS]
    assert values(spark, every, X.section_of("c")) == [n for _, _, n in C.SECTIONS]


def test_area_and_lenses(spark):
    assert values(spark, ["212405", "2124-05", "313220", None, "999999"], X.area_of("c")) == ["Desenvolvimento", "Desenvolvimento", "Suporte e Operação", C.AREA_OTHER, C.AREA_OTHER]
    assert values(spark, ["2124-05", "21-2405", "142135", None, " 317110"], X.is_tech_occupation("c")) == [True, False, True, None, True]
    assert values(spark, ["6201501", " 6201501", None], X.is_tech_sector("c")) == [True, False, None]
    df = spark.createDataFrame([("6201501", "212405"), ("6201501", None), (None, "212405"), ("x", "y")], "subclasse string, cbo2002ocupacao string")
    labelled = X.with_lenses(df)
    assert [(r["setor_ti"], r["ocupacao_ti"]) for r in labelled.collect()] == [(True, True), (True, False), (False, True), (False, False)]
    category = X.lens_category(X.is_tech_sector("subclasse"), X.is_tech_occupation("cbo2002ocupacao"))
    assert [r[0] for r in df.select(category).collect()] == [C.LENS_BOTH, C.LENS_OTHER, C.LENS_OCCUPATION, C.LENS_OTHER]


def test_scope(spark):
    assert X.scope_columns("rais_estab", ["cnae_20_subclasse"]) == ("cnae_20_subclasse", None)
    assert X.technology_scope("caged_old", ["municipio"]) is None
    df = spark.createDataFrame([("6201501", None), (None, None), ("x", "212405"), ("x", "y")], "subclasse string, cbo2002ocupacao string")
    assert df.filter(X.technology_scope("caged_mov", df.columns)).count() == 2


def test_metrics(spark):
    df = spark.createDataFrame([(1, 10.0, 20), (1, 0.0, 30), (1, None, None), (-1, 99.0, 60), (None, 5.0, 5)], "saldomovimentacao int, salario double, idade int")
    assert tuple(df.agg(*X.metrics()).first()) == (3, 1, 2, 10.0, 25.0)
    assert tuple(df.limit(0).agg(*X.metrics()).first()) == (0, 0, None, None, None)


def test_exact_mean_has_no_order(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 1e15, 0.2, -1e15)], "x double")
    assert df.agg(X.exact_mean(F.col("x"))).first()[0] == pytest.approx(float(Decimal("0.3") / 4), rel=1e-12)


def test_names(spark):
    assert X.normalized_names(["Competência Mov", "Seção", "1ª col", "Seção", "??"]) == ["competencia_mov", "secao", "1a_col", "secao_2", "coluna"]
    assert values(spark, ["É um Nome/Longo!", "--", None, "Straße"], X.slug("c")) == ["e_um_nome_longo", "sem_nome", "sem_nome", "stra_e"]


def test_plain_digits_have_a_short_way_with_the_same_values(spark):
    """Integers and months in plain digits are told without a pattern or a parser of dates; all other text goes the long way."""
    numbers = [("7", 7), ("-1", -1), ("127", 127), ("128", None), ("+7", 7), ("007", 7), ("-0", 0), (" 7 ", 7), ("\t7", None), ("2,5", 3), ("-2.5", -3), ("1e2", 100), ("7d", None), ("", None), (None, None)]
    whole = spark.createDataFrame(numbers, "x string, y int").select(X.decimal_comma("x", "tinyint").alias("got"), F.col("y"), "x")
    assert [r["x"] for r in whole.collect() if r["got"] != r["y"]] == []
    months = [("199907", "1999-07-01"), (" 199907 ", "1999-07-01"), ("010112", "0101-12-01"), ("999912", "9999-12-01"), ("199900", None), ("199913", None), ("000001", "0000-01-01"), ("-19990", None), ("19990", None), ("1999070", None), ("199907\t", None), (None, None)]
    dates = spark.createDataFrame(months, "x string, y string").select(X.yyyymm("x").cast("string").alias("got"), "y", "x")
    assert [r["x"] for r in dates.collect() if r["got"] != r["y"]] == []
    short = spark.range(1).select(F.col("id").cast("string").alias("x")).select(X.decimal_comma("x", "tinyint").alias("a"), X.yyyymm("x").alias("b"))
    assert short._jdf.queryExecution().optimizedPlan().toString().lower().count("coalesce") == 2
