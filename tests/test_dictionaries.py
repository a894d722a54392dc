import pytest
from pyspark.sql import functions as F

from microlake import constants as C
from microlake.operators import dictionaries as D
from microlake.operators import silver as S
from microlake.sources import files


def pairs(df):
    return sorted(tuple(r) for r in df.select("codigo", "descricao").collect())


def test_styles(spark):
    two = spark.createDataFrame([("Código", "Descrição"), ("1", " a "), ("1", "a"), (None, "x"), ("2", None)], "col_00 string, col_01 string")
    assert pairs(D.two_columns(two)) == [("1", "a")]
    lists = spark.createDataFrame([("Lista",), ("110001:Ro:x",), (":y",), (None,)], "col_00 string")
    assert pairs(D.colon(lists)) == [("", "y"), ("110001", "Ro:x")]
    title = spark.createDataFrame([("título", None), ("ANALFABETO", "1"), ("Descrição", "Valor na Fonte")], "col_00 string, col_01 string")
    assert pairs(D.title_code(title)) == [("1", "ANALFABETO")]


def test_layout_sheet_in_any_physical_order(spark):
    rows = [(3, "SEXO", "Homem", "1"), (1, "GRAU INSTR", "Analfabeto", "1"), (2, None, "Até 5ª", "2"), (4, None, "Mulher", "3"), (5, None, None, "9")]
    sheet = spark.createDataFrame(rows, "row_index int, col_00 string, col_03 string, col_04 string").withColumn("aba_origem", F.lit("l"))
    assert pairs(D.layout_field(sheet, "sexo")) == [("1", "Homem"), ("3", "Mulher")]
    assert pairs(D.layout_field(sheet, "Grau Instr")) == [("1", "Analfabeto"), ("2", "Até 5ª")]


def test_rows_are_not_multiplied(spark, monkeypatch):
    """Looked up in a projection or joined, by the size of the books."""
    book = D.unique_key(spark.createDataFrame([("1", "b"), ("01", "a"), ("x", "c"), (None, "d"), ("8", None)], "codigo string, descricao string"))
    assert sorted(tuple(r) for r in book.select("codigo_norm", "codigo", "descricao").collect() if r["descricao"]) == [("1", "01", "a"), ("x", "x", "c")]
    fact = spark.createDataFrame([("001", "p"), ("1", "q"), ("z", "r"), (None, "s"), ("08", "t"), ("", "u")], "uf string, k string")
    small = S.sized({"uf": book, "k": book.limit(0)})
    monkeypatch.setattr(S, "LOOKUP_BYTES", 10)
    large = S.sized({"uf": book})
    assert small["uf"].buckets == 3 and small["k"].buckets == 1 and large["uf"].buckets is None
    for books in (small, large):
        out = S.translate(fact, books)
        assert out.columns[:3] == ["uf", "uf_descricao", "k"]
        assert sorted((r["k"], r["uf_descricao"]) for r in out.collect()) == [("p", "a"), ("q", "a"), ("r", None), ("s", None), ("t", None), ("u", None)]
    assert S.sized({}) == {}


def test_all_columns_are_looked_up_without_a_join_or_an_exchange(spark):
    """A thousand codes in each of twelve columns, in one projection."""
    book = spark.range(1000).select(F.col("id").cast("string").alias("codigo_norm"), F.concat(F.lit("d"), "id").alias("descricao"))
    books = S.sized({f"c{i}": book for i in range(12)})
    fact = spark.range(5000).select(*[F.lpad(((F.col("id") * (i + 1)) % 1100).cast("string"), 5, "0").alias(f"c{i}") for i in range(12)])
    out = S.translate(fact, books)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted").split("===== Subqueries =====")[0]
    assert "Join" not in plan and "Exchange" not in plan
    wrong = [F.count_if(~F.col(f"c{i}_descricao").eqNullSafe(F.when(F.col(f"c{i}").cast("int") < 1000, F.concat(F.lit("d"), F.col(f"c{i}").cast("int"))))) for i in range(12)]
    assert list(out.agg(*wrong).first()) == [0] * 12


def test_dispatch(spark):
    sheet = spark.createDataFrame([("1:a", "2:b")], "col_00 string, col_01 string")
    assert pairs(D.dictionary(sheet, "colon_coluna", coluna="col_01")) == [("2", "b")]
    assert D.dictionary(sheet.limit(0), "colon") is None
    with pytest.raises(ValueError):
        D.dictionary(sheet, "other")


def test_maps():
    assert D.translation_map("caged_mov", ["uf", "ano_particao", "layout", "x"], {"uf", "ano_particao", "layout"}) == {"uf": {"estilo": "2col", "aba": "uf"}}
    assert len(D.manual_map("caged_old")) == 36 and len(D.manual_map("rais_vinc")) == 33 and len(D.manual_map("rais_estab")) == 17
    assert D.translation_map("caged_old", ["municipio", "sexo"], {"municipio"}) == {"municipio": {"estilo": "colon", "aba": "municipio"}}
    assert D.manual_map("unknown") == {}


def test_books_come_from_their_workbook_and_unreadable_sheets_are_passed_over(spark, tmp_path):
    mine, other = C.CENSUS_WORKBOOKS["rais_vinc"], "rais_vinculos_layout2012"
    for book, word in ((mine, "right"), (other, "wrong")):
        spark.createDataFrame([(f"1:{word}",)], "col_00 string").write.parquet(files.sheet_path(str(tmp_path), "rais_layouts", "municipio", book))
    (tmp_path / "rais_layouts" / mine / "ocupacao.parquet").write_text("no parquet")
    load = lambda book, sheet: spark.read.parquet(files.sheet_path(str(tmp_path), "rais_layouts", sheet, book))
    with pytest.warns(UserWarning) as told:
        found = D.dictionaries_of("rais_vinc", ["municipio", "cbo_ocupacao_2002", "sexo_trabalhador", "idade"], load)
    assert sorted(str(w.message).split()[0] for w in told if "untranslated" in str(w.message)) == ["rais_vinc.cbo_ocupacao_2002", "rais_vinc.sexo_trabalhador"]
    assert {c: b.first()["descricao"] for c, b in found.items()} == {"municipio": "right"}
    assert all(m["planilha"] == C.CENSUS_WORKBOOKS[t] for t in C.CENSUS_TABLES for m in D.manual_map(t).values())


def test_a_sheet_that_breaks_when_it_is_read_is_an_error(spark, tmp_path):
    path = tmp_path / "municipio.parquet"
    spark.createDataFrame([("1:a",)], "col_00 string").write.parquet(str(path))
    sheet = spark.read.parquet(str(path))
    for part in path.glob("part-*"):
        part.write_text("broken")
    with pytest.raises(Exception, match="(?i)parquet|checksum"):
        D.dictionaries_of("rais_vinc", ["municipio"], lambda book, name: sheet)


def test_sheet_rows(spark):
    raw = spark.createDataFrame([("a", None, "nan"), (None, None, "NaT"), ("b", None, "c")], "x string, y string, z string")
    out = D.sheet_rows(raw, "aba", "livro")
    assert out.columns == ["col_00", "col_01", "aba_origem", "planilha_origem"]
    assert sorted((r["col_00"], r["col_01"]) for r in out.collect()) == [("a", None), ("b", "c")]
    assert D.sheet_rows(raw.limit(0), "aba", "livro").count() == 0


def test_silver(spark):
    fact = spark.createDataFrame([("6201501", "1", "10,50", "202401", 2024), ("x", "1", "?", "2024", 2024)], "subclasse string, saldomovimentacao string, salario string, competenciamov string, ano_particao int")
    out = S.build_silver("caged_mov", fact, {})
    assert out.columns == ["subclasse", "saldomovimentacao", "salario", "competenciamov", "competenciamov_data", "ano_particao"]
    assert out.count() == 1 and S.build_silver("caged_mov", fact, {}, full_market=True).count() == 2
    assert dict(out.dtypes)["saldomovimentacao"] == "tinyint" and out.first()["salario"] == 10.5
    report = S.translation_report(spark, {"caged_mov": ["uf"], "rais_estab": ["municipio"]}, {"uf", "municipio"})
    assert report.count() == 2
    assert C.TECHNICAL[0] in S.bronze(fact.drop("ano_particao"), 2024, 1).columns
