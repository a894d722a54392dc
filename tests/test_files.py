import datetime as dt
import random
import shutil

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from microlake.operators import gold as G
from microlake.plans import lake
from microlake.plans import queries as lake_queries
from microlake.plans.queries import QUERIES
from microlake.sources import files, sinks
from microlake.streaming import ingest


def test_profiles(spark, tmp_path):
    for name, raw in {"a": "competência Mov;a\nx;y\n".encode(), "b": "competência Mov;a,b\nx;y\n".encode("latin-1"), "c": b"a,b,c;\r\nx\n"}.items():
        (tmp_path / name).write_bytes(raw)
    got = {r["path"][-1]: (r["encoding"], r["delimiter"], r["header"]) for r in files.file_profiles(spark, str(tmp_path)).collect()}
    assert got == {"a": ("UTF-8", ";", "competência Mov;a"), "b": ("ISO-8859-1", ";", "competência Mov;a,b"), "c": ("ISO-8859-1", ",", "a,b,c;")}


def test_ragged_rows(spark, tmp_path):
    """Short rows are filled, long ones and open quotation marks dropped; an empty field behind the last is passed over."""
    (tmp_path / "x.csv").write_text('a;b;c\n1;2;3\n4;5\n6;7;8;9\n10;11;12;\n13;14;15;;\n"16;17";;18\n"19;20;21\n;;\n')
    (tmp_path / "y.csv").write_bytes("c,ã\né,1\n\nb,\n".encode("latin-1"))
    landed = files.read_landed(spark, str(tmp_path))
    assert landed.rows.columns == ["c", "a", "b"] or landed.rows.columns == ["a", "b", "c"]
    rows = sorted((tuple(r[c] or "" for c in "abc") for r in landed.rows.collect()))
    assert rows == sorted([("1", "2", "3"), ("4", "5", ""), ("10", "11", "12"), ("13", "14", "15"), ("16;17", "", "18"), ("", "", ""), ("1", "", "é"), ("", "", "b")])
    counts = {r["path"][-5]: (r["linhas"], r["curtas"], r["descartadas"]) for r in landed.counts.collect()}
    assert counts == {"x": (6, 1, 2), "y": (2, 0, 0)}


def test_ragged_rows_as_a_tolerant_reader_reads_them(spark, tmp_path):
    """The rows that DuckDB's reader keeps, with the header's columns, null padding and errors ignored."""
    rng, rows = random.Random(1), []
    for i in range(300):
        fields = [str(i), *(rng.choice(["x", "", '"a;b"', '"q""q"', " y "]) for _ in range(rng.choice([1, 2, 2, 2, 3, 4])))]
        rows.append(";".join(fields))
    (tmp_path / "z.csv").write_text("\n".join(["k;a;b", *rows]) + "\n")
    options = "delim=';', header=true, auto_detect=false, columns={'k': 'VARCHAR', 'a': 'VARCHAR', 'b': 'VARCHAR'}, ignore_errors=true, null_padding=true, quote='\"', escape='\"'"
    plain = duckdb.sql(f"SELECT k, coalesce(a, ''), coalesce(b, '') FROM read_csv('{tmp_path}/z.csv', {options})").fetchall()
    got = [(r["k"], r["a"] or "", r["b"] or "") for r in files.read_landed(spark, str(tmp_path)).rows.collect()]
    assert sorted(got) == sorted(plain) and len(got) < 300


def test_unclean_lines_are_cleaned_before_they_are_parsed(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"a;b\n1\0;2\n\0x\n \0\t\n3;\0\0\n;\n")
    landed = files.read_landed(spark, str(tmp_path), sanitize=True)
    assert sorted((r["a"], r["b"]) for r in landed.rows.collect()) == [("1", "2"), ("3", None)]
    assert tuple(landed.counts.select("linhas", "curtas", "descartadas").first()) == (2, 0, 0)


def test_many_files_are_one_scan(spark, tmp_path):
    for i in range(1000):
        head, sep = (("a", "b"), ";") if i % 2 else (("b", "a", "x"), ",")
        (tmp_path / f"f{i:04}.csv").write_bytes(f"{sep.join(head)}\n{sep.join(c + str(i) for c in head)}\n{sep.join(['ç'] * 9)}\n".encode("latin-1" if i % 3 else "utf-8"))
    landed = files.read_landed(spark, str(tmp_path))
    got = landed.rows.agg(F.count("*"), F.count("x"), F.count_distinct("a"), F.count_if(F.col("a") == F.concat(F.lit("a"), F.substring("b", 2, 9)))).first()
    assert tuple(got) == (1000, 500, 1000, 1000)
    assert tuple(landed.counts.agg(F.count("*"), F.sum("linhas"), F.sum("descartadas")).first()) == (1000, 1000, 1000)
    plan = spark._jvm.PythonSQLUtils.explainString(landed.rows._jdf.queryExecution(), "simple")
    assert plan.count("FileScan text") == 2  # the rows, and the profiles


def test_sanitize(spark):
    lines = spark.createDataFrame([("ab",), ("a\x00",), ("\x00\x00xy",), (" ",), (None,), ("x",)], "value string")
    assert sorted(r[0] for r in files.sanitized_lines(lines).collect()) == ["ab", "xy"]
    assert tuple(files.sanitize_report(lines).first()) == (2, 4)


def test_row_groups_and_counts(spark, tmp_path):
    df = spark.range(120_000).repartition(1)
    assert sinks.write_bronze(df, str(tmp_path / "b")) == 120_000 and sinks.verified(spark, str(tmp_path / "b"), 120_000)
    sinks.write_sorted(df, str(tmp_path / "s"), "id", 1)
    meta = pq.ParquetFile(next((tmp_path / "s").glob("*.parquet"))).metadata
    assert meta.row_group(0).num_rows <= 50_000 and meta.row_group(0).column(0).compression == "ZSTD"
    assert meta.row_group(0).column(0).statistics.max < meta.row_group(1).column(0).statistics.min
    sinks.write_sorted(df, str(tmp_path / "u"), "missing")
    assert files.row_count(spark, str(tmp_path / "u")) == 120_000


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "p")
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "ano int, x string"), out, ["ano"])
    sinks.write_partitioned(spark.createDataFrame([(2, "c")], "ano int, x string"), out, ["ano"])
    assert sorted((r["ano"], r["x"]) for r in files.read_hive(spark, out).collect()) == [(1, "a"), (2, "c")]


def test_silver_per_file_goes_on_where_it_was_stopped(spark, tmp_path):
    out = str(tmp_path / "k2")
    rows = spark.createDataFrame([("f/1", 1, 7), ("f/1", 2, 7), ("f2", 3, 7), ("none", -1, 8)], "arquivo_fonte string, x int, ano int")
    scope = lambda df: df.filter("x > 0")
    told = lambda df: sorted((r["arquivo_fonte"], r["linhas_bronze"], r["linhas"]) for r in df.collect())
    read = lambda: sorted((str(r["arquivo_fonte"]), r["x"]) for r in sinks.read_per_file(spark, out).collect())
    assert sinks.manifest(spark, out) is None
    assert told(sinks.build_per_file(rows.filter("arquivo_fonte = 'none'"), scope, out, ("ano",))) == [("none", 1, 0)]
    assert told(sinks.build_per_file(rows.filter("arquivo_fonte <> 'f2'"), scope, out, ("ano",))) == [("f/1", 2, 2)]
    assert told(sinks.build_per_file(rows, scope, out, ("ano",))) == [("f2", 1, 1)]  # neither done files nor the one without rows
    assert told(sinks.build_per_file(rows, scope, out, ("ano",))) == []
    assert read() == [("f/1", 1), ("f/1", 2), ("f2", 3)] and (tmp_path / "k2/dados/lote=2/ano=7/arquivo_fonte=f%2F1").is_dir()
    # a file that is built again replaces its own, and loses its rows if there are none any more
    sinks.build_per_file(rows.filter("x = 2"), scope, out, ("ano",), force=True)
    assert read() == [("f/1", 2), ("f2", 3)]
    sinks.build_per_file(rows.filter("x = 3").withColumn("x", F.lit(-3)), scope, out, ("ano",), force=True)
    assert read() == [("f/1", 2)] and told(sinks.manifest(spark, out)) == [("f/1", 1, 1), ("f2", 1, 0), ("none", 1, 0)]


def test_a_build_that_is_stopped_leaves_nothing_that_is_read(spark, tmp_path, monkeypatch):
    out, rows = str(tmp_path / "k2"), spark.createDataFrame([("a", 1), ("b", 2)], "arquivo_fonte string, x int")
    sinks.build_per_file(rows.filter("x = 1"), lambda df: df, out)

    def stopped(*_):
        raise KeyboardInterrupt

    write = sinks.write_partitioned
    monkeypatch.setattr(sinks, "write_partitioned", lambda *a: (write(*a), stopped()))
    with pytest.raises(KeyboardInterrupt):
        sinks.build_per_file(rows, lambda df: df, out)
    assert [r["arquivo_fonte"] for r in sinks.read_per_file(spark, out).collect()] == ["a"]
    monkeypatch.setattr(sinks, "write_partitioned", write)
    sinks.build_per_file(rows, lambda df: df, out)
    assert sorted(r["x"] for r in sinks.read_per_file(spark, out).collect()) == [1, 2]


def test_layers_are_built_once_and_again_when_they_are_gone(spark, tmp_path):
    made = []
    get = lambda: lake.built(spark, "d", "test", lambda path: (made.append(path), spark.range(3).write.parquet(path)))
    assert get().count() == get().count() == 3 and len(made) == 1
    shutil.rmtree(made[0].removeprefix("file://"))
    assert get().count() == 3 and len(made) == 2
    lake.forget(spark)
    assert get().count() == 3 and len(made) == 3


def test_layers_follow_their_tables(spark, tmp_path):
    """A G, an L and an A query give new answers when a table is replaced."""
    folder = tmp_path / "tables"
    shutil.copytree("/root/testdata/sf0.001", folder)
    asked = ("g_saldo_uf", "l_serie_longa_anual", "a1_union_summary")
    first = {q: QUERIES[q](spark, str(folder)).collect() for q in asked}
    assert {q: QUERIES[q](spark, str(folder)).collect() for q in asked[2:]} == {q: first[q] for q in asked[2:]}
    some = pq.read_table(folder / "lineitem.parquet").slice(0, 700)
    pq.write_table(some, folder / "lineitem.parquet")
    again = {q: QUERIES[q](spark, str(folder)).collect() for q in asked}
    assert all(again[q] != first[q] for q in asked) and again["a1_union_summary"][0]["linhas"] < 700


SCHEMA = "tabela string, arquivo_fonte string, seq long, data_hora timestamp, status string"


def test_the_state_of_a_ledger_goes_on_after_a_restart(spark, tmp_path):
    log, check = str(tmp_path / "log"), str(tmp_path / "check")
    for n in range(4):
        rows = [("a", f"f{k}", n, dt.datetime(2024, 1, 1 + n), "ok") for k in (0, n)] + [("a", None, n, dt.datetime(2024, 2, 1), "erro")]
        spark.createDataFrame(rows, SCHEMA).dropDuplicates().write.mode("append").parquet(log)
        ingest.keep_current(spark, log, spark.createDataFrame([], SCHEMA).schema, check)
    ingest.keep_current(spark, log, spark.createDataFrame([], SCHEMA).schema, check)  # nothing new
    want = [("", 3), ("f0", 3), ("f1", 1), ("f2", 2), ("f3", 3)]
    found = ingest.latest(spark, check)
    assert found.columns == ["tabela", "arquivo_fonte", "seq", "data_hora", "status"]
    assert sorted((r["arquivo_fonte"] or "", r["seq"]) for r in found.collect()) == want
    # an older row that comes late changes nothing
    spark.createDataFrame([("a", "f0", 1, dt.datetime(2023, 1, 1), "erro")], SCHEMA).write.mode("append").parquet(log)
    ingest.keep_current(spark, log, spark.createDataFrame([], SCHEMA).schema, check)
    assert sorted((r["arquivo_fonte"] or "", r["seq"]) for r in ingest.latest(spark, check).collect()) == want
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")  # set for the query alone


class _Session:
    def __init__(self, **conf):
        self.conf = self
        self.held = {"spark." + k.replace("_", "."): v for k, v in conf.items()}

    def get(self, name, other=None):
        return self.held.get(name, other)

    def set(self, name, value):
        self.held[name] = value


def test_only_one_machine_gets_a_folder_of_its_own():
    for master in ("local", "local[4]", "local[*]"):
        one = _Session(master=master)
        assert sinks.shared_dir(one) == sinks.shared_dir(one)
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError):
            sinks.shared_dir(_Session(master=master))
        assert sinks.work_dir(_Session(master=master, checkpoint_dir="s3://x"), "a").startswith("s3://x/a-")


def test_fallback(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "none"))
    spark.range(2).write.parquet(str(tmp_path / "some"))
    assert files.first_available(spark, [str(tmp_path / "missing"), str(tmp_path / "none"), str(tmp_path / "some")]).count() == 2
    assert files.first_available(spark, [str(tmp_path / "missing")]) is None
    catalogue = spark.createDataFrame([("a", "uf")], "namespace string, sheet string")
    assert files.sheet_exists(catalogue, "a", "uf") and not files.sheet_exists(catalogue, "b", "uf")


def test_ingest_takes_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType())])
    for n in (1, 2):
        spark.createDataFrame([(f" {n} ",)], schema).write.mode("append").csv(str(tmp_path / "in"))
        ingest.ingest_new(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "check"))
    assert sorted(r["a"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2"]


def test_ingest_and_its_ledger_survive_a_stop_between_the_two(spark, tmp_path, monkeypatch):
    """The run is stopped when the rows are written and the ledger is not; the next one gives each file once in both."""
    schema = T.StructType([T.StructField("a", T.StringType())])
    paths = {k: str(tmp_path / k) for k in ("in", "out", "ledger", "check")}
    go = lambda check="check": ingest.ingest_with_ledger(spark, paths["in"], schema, paths["out"], paths["ledger"], str(tmp_path / check), "t", files_per_batch=2)
    rows = lambda: sorted(r["a"] for r in ingest.ingested(spark, paths["out"], paths["ledger"]).collect())
    listed = lambda: sorted((r["arquivo_fonte"], r["linhas"], r["status"]) for r in ingest.read_ledger(spark, paths["ledger"]).collect())
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"f{n}.csv").write_text(f" {n} \nx{n}\n")
    go()
    (tmp_path / "in" / "g.csv").write_text("new\n")
    plain, calls = ingest.F.unix_micros, []

    def stops(c):
        calls.append(c)
        raise RuntimeError("stopped")

    monkeypatch.setattr(ingest.F, "unix_micros", stops)
    with pytest.raises(StreamingQueryException):
        go()
    monkeypatch.setattr(ingest.F, "unix_micros", plain)
    assert calls and rows() == ["0", "1", "2", "x0", "x1", "x2"] and len(listed()) == 3
    for check in ("check", "check", "a new checkpoint"):
        go(check)
        assert rows() == ["0", "1", "2", "new", "x0", "x1", "x2"]
        assert listed() == [("f0.csv", 2, "ok"), ("f1.csv", 2, "ok"), ("f2.csv", 2, "ok"), ("g.csv", 1, "ok")]


def test_counts_come_from_footers(spark, tmp_path):
    for n in (1, 2):
        spark.range(n * 10).coalesce(1).write.parquet(str(tmp_path / f"d/{n}"))
    found = files.row_counts(spark, str(tmp_path / "d"))
    assert sorted(r["n"] for r in found.collect()) == [10, 20]
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    assert "ReadSchema: struct<>" in plan


def test_gold_of_partials_is_gold_of_all_rows(spark, tmp_path):
    silver = lake_queries.new_silver(spark, "/root/testdata/sf0.001")
    for name in G.GOLD:
        whole, parts = G.gold(silver, name), G.gold_of_partials(G.gold_partials(silver, name), name)
        assert parts.columns == whole.columns
        assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect())), name


def test_unify_fills_missing_columns(spark):
    new = spark.createDataFrame([("6201501", "212405", 1)], "subclasse string, cbo2002ocupacao string, saldomovimentacao int")
    new = new.withColumns({c: F.lit(1) for c in ("ano_particao", "mes_particao", "idade", "salario")}).withColumn("competenciamov_data", F.current_date())
    assert len(G.harmonised(new, False).columns) == 19


def test_stages_that_are_too_long_to_compile_are_cut(spark):
    """The silver of a large table is one stage, whose method the JVM would only interpret; a limit that is set stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    for own, want in ((None, "8000"), ("5000", "5000")):
        spark.conf.unset(name)
        if own:
            spark.conf.set(name, own)
        QUERIES["f8_not_null_dimension"](spark, "/root/testdata/sf0.001").collect()
        assert spark.conf.get(name) == want
    spark.conf.unset(name)


def test_lines_meet_their_profiles_where_they_are_read(spark, tmp_path):
    """No exchange goes over the lines, which would bring all of a file to one task."""
    (tmp_path / "x.csv").write_text("a;b\n1;2\n")
    rows = files.read_landed(spark, str(tmp_path), sanitize=True).rows
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [tuple(r) for r in rows.collect()] == [("1", "2")]


def test_silver_and_unified_rows_are_not_shuffled(spark, tmp_path):
    """A table of few partitions is written where its rows are, with one file a task and partition; the unified series is made of the silver."""
    rows = spark.range(0, 1000, 1, 3).select("id", (F.col("id") % 4).alias("k"))
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    sinks.write_few_partitioned(rows, str(tmp_path / "t"), "k")
    assert spark.conf.get(name) == before
    assert len(list((tmp_path / "t").glob("k=*/*.parquet"))) == 12
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(1000))
    series, silver = lake_queries.unified(spark, "/root/testdata/sf0.001"), lake_queries.new_silver(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in series._jdf.queryExecution().executedPlan().toString() and set(series.inputFiles()) == set(silver.inputFiles())
    assert series.count() == silver.count()


def test_files_of_the_silver_are_built_in_stages_that_are_compiled(spark):
    """k2 builds its silver by file, not from the layer."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(name)
    QUERIES["k2_write_silver_per_file"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(name) == "8000"
    spark.conf.unset(name)


def test_rows_are_brought_together_by_file_before_they_are_built(spark, tmp_path, monkeypatch):
    """What build adds is not shuffled, what it leaves out is not either, and nothing is sorted by file while it is written."""
    seen, write = [], sinks.write_partitioned
    monkeypatch.setattr(sinks, "write_partitioned", lambda df, *a: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, *a)))
    open_files, writer = [], sinks._writer
    monkeypatch.setattr(sinks, "_writer", lambda *a: (open_files.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")), writer(*a))[1])
    rows = spark.range(90).select(F.concat(F.lit("f"), F.col("id") % 3).alias("arquivo_fonte"), (F.col("id") % 2).alias("ano"), F.col("id").alias("x"))
    out = str(tmp_path / "k2")
    sinks.build_per_file(rows, lambda df: df.filter("x >= 30").withColumn("wide", F.repeat(F.lit("descricao"), F.col("x").cast("int"))), out, ("ano",))
    above, below = seen[0].split("RebalancePartitions")
    assert "wide" in above and "wide" not in below and ">= 30" in below
    assert open_files == [str(sinks.FEW_PARTITIONS)] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert sorted(r["x"] for r in sinks.read_per_file(spark, out).collect()) == list(range(30, 90))
    many = spark.range(4 * sinks.FEW_PARTITIONS).withColumn("k", F.col("id")).coalesce(1)  # more than a task keeps open
    sinks.write_partitioned(many, str(tmp_path / "many"), ["k"], False)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "many")).collect()) == list(range(4 * sinks.FEW_PARTITIONS))
