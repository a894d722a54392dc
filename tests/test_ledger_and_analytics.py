import datetime as dt

import pytest
from pyspark.sql import functions as F

from microlake.operators import analytics as A
from microlake.operators import ledger as L


def test_classification_order(spark):
    names = ["CAGEDMOV202401.7z", "cagedexc202402.ZIP", "CAGEDEST_AJUSTES_012010.7z", "CAGEDEST_AJUSTES_2009.7z", "CAGEDEST_032005.7z", "RAIS_ESTAB_PUB.7z", "RAIS_VINC_PUB_SP.7z", "ESTB2001.7z", "IGNORANDOS1985.7z", "IGNORADO1988.7z", "SP1999.zip", "readme.7z", "CAGEDMOV202401.txt"]
    df = spark.createDataFrame([(n,) for n in names], "nome_arquivo string")
    got = {r["nome_arquivo"]: (r["tabela"], r["ano"], r["mes"], r["recorte"]) for r in L.classify_files(df, folder_year=F.lit(2020)).collect()}
    assert [got[n] for n in names] == [
        ("caged_mov", 2024, 1, None), ("caged_exc", 2024, 2, None), ("caged_ajustes", 2010, 1, None), ("caged_ajustes", 2009, None, None), ("caged_old", 2005, 3, None),
        ("rais_estab", 2020, None, None), ("rais_vinc", 2020, None, "sp"), ("rais_estab", 2001, None, None), ("rais_vinc", 1985, None, "ignorado"), ("rais_vinc", 1988, None, "ignorado"),
        ("rais_vinc", 1999, None, "sp"), (None,) * 4, (None,) * 4,
    ]
    assert L.classify_files(df).filter("nome_arquivo LIKE 'RAIS%' AND tabela IS NOT NULL").count() == 0


def test_inventory(spark):
    paths = ["/r/RAIS/2019/Legado/SP2019.7z", "/r/RAIS/2019 Parcial/x/SP.7z", "/r/CAGED/f.pdf", "/r/CAGED/2001/2002/A.ZIP"]
    got = sorted((r["nome_arquivo"], r["ano_pasta"], r["parcial"], r["dataset"]) for r in L.inventory_of(spark.createDataFrame([(p, 1) for p in paths], "path string, length long"), "/r").collect())
    assert got == [("A.ZIP", 2002, False, "CAGED"), ("SP.7z", 2019, True, "RAIS")]


def test_inventory_of_a_folder_by_any_way_to_write_it(spark, tmp_path):
    for folder in ("caged/2001 Parcial", "caged/Legado/2002"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "CAGEDMOV200101.7z").write_text("x")
    for root in (f"{tmp_path}", f"file:{tmp_path}/", f"file://{tmp_path}"):
        assert [(r["dataset"], r["ano_pasta"], r["parcial"], r["tamanho"]) for r in L.file_inventory(spark, root).collect()] == [("caged", 2001, True, 1)]


def test_coverage(spark):
    months = spark.createDataFrame([(2020, 1), (2020, 2), (2020, 5), (2020, 5)], "ano int, mes int")
    assert tuple(L.coverage(months).first()) == ("2020-01", "2020-05", 3, ["2020-03", "2020-04"])
    years = spark.createDataFrame([(2018, None), (2020, None)], "ano int, mes int")
    assert tuple(L.coverage(years).first()) == ("2018", "2020", 2, ["2019"])
    assert tuple(L.coverage(months.limit(0)).first()) == (None, None, 0, [])


def test_latest_row_of_one_second(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "f", 1, t, "erro", 2001), ("a", "f", 2, t, "ok", 2001), ("b", "g", 3, t, "erro", 1999), ("caged_old", "h", 4, t, "erro", 2005)]
    now = L.latest_per_key(spark.createDataFrame(rows, "tabela string, arquivo_fonte string, seq long, data_hora timestamp, status string, ano int"))
    assert sorted((r["tabela"], r["status"]) for r in now.collect()) == [("a", "ok"), ("b", "erro"), ("caged_old", "erro")]
    plan = L.retry_plan(L.current_errors(now)).first()
    assert tuple(plan) == (["b", "caged_old"], ["caged"], 1999, 2005, 2)


def test_progress(spark):
    found, wanted = spark.createDataFrame([("a", 5), ("x", 1)], "tabela string, n int"), spark.createDataFrame([("a", 8), ("b", 2), ("c", 0)], "tabela string, n int")
    assert {r["tabela"]: (r["achados"], r["pct"]) for r in L.progress(found, wanted).collect()} == {"a": (5, 62), "x": (1, None), "b": (0, 0), "c": (0, None)}


def annual(spark, rows):
    return spark.createDataFrame(rows, "ano int, saldo long, admissoes long, salario_medio double")


def test_history_arc(spark):
    rows = [(2018, 10, 100, 1000.0), (2019, -4, 90, 1100.0), (2020, 30, 120, 1200.0), (2021, 30, 130, None), (2022, 5, 80, 1500.0), (2023, -99, 1, 2000.0)]
    a = A.history_arc(annual(spark, rows)).first()
    assert (a["melhor_ano"], a["melhor_saldo"], a["anos_negativos"], a["saldo_negativo"]) == (2020, 30, [2019], -4)
    assert (a["ano_queda"], a["queda_valor"], a["queda_de"], a["salario_inicio"], a["salario_fim"]) == (2022, -25, 30, 1000.0, 2000.0)
    assert tuple(A.arc_ratios(A.history_arc(annual(spark, rows))).first())[2:] == (pytest.approx(25 / 30 * 100), 2.0)
    one = A.history_arc(annual(spark, rows[:1])).first()
    assert one["melhor_ano"] == 2018 and one["ano_queda"] is None
    assert A.history_arc(annual(spark, []).limit(0)).count() == 0


def test_reaggregation_leaves_null_keys_out_and_weighs(spark):
    df = spark.createDataFrame([("a", 1, 10, 100.0), ("a", 2, 30, 200.0), (None, 5, 5, 1.0), ("b", 1, 1, None)], "k string, saldo long, admissoes long, salario_medio double")
    got = {r["k"]: (r["saldo"], r["salario_medio"], r["salario_medio_ponderado"]) for r in A.reaggregate(df, "k", weighted=True).collect()}
    assert got == {"a": (3, 150.0, 175.0), "b": (1, None, None)}


def test_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, v int")
    assert [r["k"] for r in A.top(df, "k", "v", 2).collect()] == ["a", "b"]
    assert [r["k"] for r in A.top(df, "k", "v", 2, ascending=True).collect()] == ["b", "a"]
