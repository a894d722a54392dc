"""The file inventory, the ingestion ledger, and the coverage of periods."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C

_SCHEME = r"^[A-Za-z0-9+.-]+:/+"
_END = r"\.(?:7z|zip)$"
# The names of the archive's files.
#: Tried in this order: (pattern, table, group of the year, group of the month, group of the slice). Group 0: the folder's
#: year; a table in braces takes the group in lower case.
_FILES = (
    (r"CAGED(MOV|FOR|EXC)(\d{4})(\d{2})", "caged_{1}", 2, 3, None),
    (r"CAGEDEST_AJUSTES_(\d{2})(\d{4})", "caged_ajustes", 2, 1, None),
    (r"CAGEDEST_AJUSTES_(\d{4})", "caged_ajustes", 1, None, None),
    (r"CAGEDEST_(\d{2})(\d{4})", "caged_old", 2, 1, None),
    (r"RAIS_ESTAB_PUB", "rais_estab", 0, None, None),
    (r"RAIS_VINC_PUB_(.+?)", "rais_vinc", 0, None, 1),
    (r"ESTB(\d{4})", "rais_estab", 1, None, None),
    (r"IGNORAN?DOS?(\d{4})", "rais_vinc", 1, None, "ignorado"),
    (r"([A-Za-z]{2})(\d{4})", "rais_vinc", 2, None, 1),
)
_CUT = "\x01"


def _groups() -> list[int]:
    """Where each pattern stands among the groups of all patterns in one, each in a group of its own."""
    out, at = [], 1
    for pattern, *_ in _FILES:
        out.append(at)
        at += 1 + re.compile(pattern).groups
    return [*out, at]


def classify_files(files: DataFrame, name: str = "nome_arquivo", folder_year: Column | None = None) -> DataFrame:
    """Adds tabela, ano, mes and recorte by the file's name; all null for a file that is none of the known ones, or
    that needs its folder's year and has none. All patterns stand in one, which runs once over a name."""
    at = _groups()
    whole = "(?i)^(?:" + "|".join(f"({p})" for p, *_ in _FILES) + ")" + _END
    parts = F.split(F.regexp_replace(F.col(name), whole, "".join(f"{_CUT}${g}" for g in range(1, at[-1]))), _CUT)
    folder = F.lit(None).cast("int") if folder_year is None else folder_year.cast("int")
    empty = F.lit("").alias("x")
    of = lambda x, some: F.concat(empty, *[x[g] for g in some])  # noqa: E731  one of them at most has matched

    def fields(x: Column) -> Column:
        """Of the groups' texts, or one text for a name that no pattern matches."""
        which = F.array_position(F.transform(F.array(*[x[g] for g in at[:-1]]), lambda g: g != ""), True)
        kind = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (which - 1).cast("int"))
        month = of(x, [at[i] + f[3] for i, f in enumerate(_FILES) if f[3]])
        year = of(x, [at[i] + f[2] for i, f in enumerate(_FILES) if f[2]])
        part = of(x, [at[i] + f[4] for i, f in enumerate(_FILES) if isinstance(f[4], int)])
        first = of(x, [at[i] + 1 for i, f in enumerate(_FILES) if "{" in f[1]])
        years = F.when(kind([f[2] == 0 for f in _FILES]), folder).otherwise(F.nullif(year, F.lit("")).cast("int"))
        made = F.struct(
            F.concat(kind([f[1].removesuffix("{1}") for f in _FILES]), F.lower(first)).alias("tabela"), years.alias("ano"), F.nullif(month, F.lit("")).cast("int").alias("mes"),
            F.coalesce(F.nullif(F.lower(part), F.lit("")), kind([f[4] if isinstance(f[4], str) else None for f in _FILES])).alias("recorte"),
        )
        return F.when(years.isNotNull(), made)

    known = F.filter(F.transform(F.filter(F.array(parts), lambda x: F.size(x) == at[-1]), fields), lambda x: x.isNotNull())
    return files.select("*", F.inline_outer(known))


def file_inventory(spark: SparkSession, root: str, extensions: tuple[str, ...] = C.ARCHIVES, skipped: tuple[str, ...] = C.SKIPPED_FOLDERS) -> DataFrame:
    """(caminho_remoto, nome_arquivo, tamanho, parcial, ano_pasta, dataset) of the archives below root; folders to be skipped
    don't count. The year and the word parcial are inherited from the deepest, and from any, folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return inventory_of(found, root, extensions, skipped)


def inventory_of(paths: DataFrame, root: str = "", extensions: tuple[str, ...] = C.ARCHIVES, skipped: tuple[str, ...] = C.SKIPPED_FOLDERS) -> DataFrame:
    """file_inventory for a table (path, length)."""
    plain = re.sub(_SCHEME, "/", root).rstrip("/") + "/"  # the same path may be written with one slash or three
    below = F.regexp_replace(F.regexp_replace("path", _SCHEME, "/"), "^.*?" + _quoted(plain) if root else "^$", "")
    parts = F.split(below, "/")
    folders = F.slice(parts, 1, F.size(parts) - 1)
    years = F.filter(F.transform(folders, lambda x: F.regexp_extract(x, r"(\d{4})", 1)), lambda y: y != "")
    out = paths.select(
        F.col("path").alias("caminho_remoto"), F.element_at(parts, -1).alias("nome_arquivo"), F.col("length").alias("tamanho"),
        F.exists(folders, lambda x: F.lower(x).contains("parcial")).alias("parcial"), F.try_element_at(years, F.lit(-1)).cast("int").alias("ano_pasta"),
        F.when(F.size(folders) > 0, F.element_at(parts, 1)).alias("dataset"), folders.alias("_folders"),
    )
    passed = F.exists("_folders", lambda x: F.lower(F.trim(x)).isin(*skipped))
    return out.filter(F.lower("nome_arquivo").rlike(r"\.(?:%s)$" % "|".join(extensions)) & ~passed).drop("_folders")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def destination_path(bucket: str = "bronze") -> Column:
    """Path of an item's file, of (tabela, ano, mes, recorte, parcial): by month, by slice, or by year."""
    year = F.concat(F.col("ano").cast("string"), F.when(F.col("parcial"), "_parcial").otherwise(""))
    base = F.concat(F.lit(f"s3://{bucket}/"), F.col("tabela"), F.lit("/ano="), year, F.lit("/"))
    name = lambda *x: F.concat(base, *x, F.lit(".parquet"))
    month = F.lpad(F.col("mes").cast("string"), 2, "0")
    by_month = name(F.lit("mes="), F.col("mes").cast("string"), F.lit("/"), F.col("tabela"), F.lit("_"), F.col("ano").cast("string"), month)
    by_slice = name(F.col("tabela"), F.lit("_"), F.col("recorte"))
    by_year = name(F.col("tabela"), F.lit("_"), F.col("ano").cast("string"))
    return F.when(F.col("mes").isNotNull(), by_month).when(F.coalesce(F.col("recorte"), F.lit("")) != "", by_slice).otherwise(by_year)


def data_files(files: DataFrame, archive: str = "archive", name: str = "nome_arquivo", size: str = "tamanho") -> DataFrame:
    """Inside archives: data extensions of some size; where an archive has none, files without extension of that size."""
    big = F.col(size) >= C.LEAST_DATA_BYTES
    data = big & F.lower(name).rlike(r"\.(?:txt|csv|comt|dat)$")
    any_data = F.max(data).over(W.partitionBy(archive))
    return files.withColumn("_any", any_data).filter(F.when(F.col("_any"), data).otherwise(big & ~F.col(name).contains("."))).drop("_any")


def plan(items: DataFrame, first_year: int | None = None, last_year: int | None = None, tables: list[str] | None = None, partial: bool = False, limit: int | None = None) -> DataFrame:
    """Work items in order, by the given filters; items without a year pass that on years."""
    out = items.filter("tabela IS NOT NULL")
    if first_year is not None:
        out = out.filter(F.col("ano").isNull() | (F.col("ano") >= first_year))
    if last_year is not None:
        out = out.filter(F.col("ano").isNull() | (F.col("ano") <= last_year))
    if not partial and "parcial" in out.columns:
        out = out.filter(~F.coalesce("parcial", F.lit(False)))
    if tables:
        out = out.filter(F.col("tabela").isin(*tables))
    order = ["tabela", "ano", F.coalesce("mes", F.lit(0)), F.coalesce("recorte", F.lit("")), "nome_arquivo"]
    return out.orderBy(*order) if limit is None else out.orderBy(*order).limit(limit)


def plan_summary(items: DataFrame) -> DataFrame:
    """Files, years and bytes by table; the row with tabela null is the total."""
    out = [F.count("*").alias("arquivos"), F.min("ano").alias("ano_min"), F.max("ano").alias("ano_max"), F.sum("tamanho").alias("bytes")]
    return items.filter("tabela IS NOT NULL").rollup("tabela").agg(*out)


def skip_existing(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key), key, "left_anti")


def latest_per_key(ledger: DataFrame, keys: tuple[str, ...] = ("tabela", "arquivo_fonte")) -> DataFrame:
    """The last row of each item; seq settles rows of one second."""
    last = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("data_hora"), F.desc("seq")))
    return ledger.withColumn("_n", last).filter("_n = 1").drop("_n")


def volume(current: DataFrame) -> DataFrame:
    """Rows and bytes by table over items that went well, and the total (tabela null)."""
    out = [F.sum("linhas").alias("linhas"), F.sum("bytes_compactado").alias("bytes"), F.count("*").alias("itens")]
    return current.filter("status = 'ok'").rollup("tabela").agg(*out)


def status(current: DataFrame) -> DataFrame:
    seconds = F.when((F.col("status") == "ok") & (F.col("segundos") > 0), F.col("segundos"))
    bad = F.count_if(F.col("status") == "erro")
    return current.agg(F.count("*").alias("total"), (F.count("*") - bad).alias("ok"), bad.alias("erro"), F.bround(F.avg(seconds), 1).alias("segundos_medio"))


def current_errors(current: DataFrame) -> DataFrame:
    return current.filter("status = 'erro'").orderBy(F.desc("data_hora"), F.desc("seq"))


def recent(ledger: DataFrame, n: int = 25) -> DataFrame:
    return ledger.orderBy(F.desc("data_hora"), F.desc("seq")).limit(n)


def retry_plan(errors: DataFrame) -> DataFrame:
    """Tables and datasets in error, years, and number of items. errors: (tabela, ano)."""
    of = F.create_map(*[F.lit(x) for pair in C.DATASET_OF.items() for x in pair])
    return errors.agg(
        F.array_sort(F.collect_set("tabela")).alias("tabelas"), F.array_sort(F.collect_set(F.try_element_at(of, F.col("tabela")))).alias("datasets"),
        F.min("ano").alias("ano_inicio"), F.max("ano").alias("ano_fim"), F.count("*").alias("itens"),
    )


def progress(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Found against expected files, both (tabela, n), with the percentage; null where nothing is expected."""
    both = counts.withColumnRenamed("n", "achados").join(expected.withColumnRenamed("n", "esperados"), "tabela", "full_outer")
    both = both.withColumn("achados", F.coalesce("achados", F.lit(0)))
    share = F.least(F.lit(100), F.bround(F.try_divide(F.col("achados") * 100, F.col("esperados"))).cast("int"))
    return both.withColumn("pct", F.when(F.col("esperados") != 0, share))


def percent_of(part: Column, whole: Column, places: int = 2) -> Column:
    return F.bround(F.try_divide(part * F.lit(100.0), F.nullif(whole, F.lit(0))), places)


def remaining_seconds(items: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Items that are not done yet, times the mean seconds of those that went well."""
    ok = current.filter("status = 'ok'")
    pace = ok.filter("segundos > 0").agg(F.avg("segundos").alias("ritmo"))
    return skip_existing(items, ok, key).agg(F.count("*").alias("pendentes")).crossJoin(F.broadcast(pace)).withColumn("segundos", F.col("pendentes") * F.col("ritmo"))


def missing_months(months: DataFrame, month: str) -> DataFrame:
    """Months (first days) between the first and the last that are not there."""
    span = months.agg(F.min(month).alias("a"), F.max(month).alias("b")).filter("a IS NOT NULL")
    wanted = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias(month))
    return wanted.join(months.select(month).distinct(), month, "left_anti")


def coverage(periods: DataFrame) -> DataFrame:
    """inicio, fim, presentes, faltando of (ano, mes) rows: by month if any row has one, else by year. Only gaps inside
    count. Without any period there is one row, with none present."""
    known = periods.filter("ano IS NOT NULL").distinct()
    monthly = F.max(F.col("mes").isNotNull())
    number = F.col("ano") * 12 + F.col("mes") - 1
    both = known.agg(monthly.alias("monthly"), F.array_sort(F.collect_set(number)).alias("months"), F.array_sort(F.collect_set(F.when(F.col("mes").isNull(), F.col("ano")))).alias("years"))
    have = both.select("monthly", F.when(F.col("monthly"), F.col("months")).otherwise(F.col("years")).alias("have"))
    label = lambda x: F.when(F.col("monthly"), F.concat(F.floor(x / 12).cast("string"), F.lit("-"), F.lpad((x % 12 + 1).cast("string"), 2, "0"))).otherwise(x.cast("string"))
    first, last = F.try_element_at("have", F.lit(1)), F.try_element_at("have", F.lit(-1))
    gaps = F.when(F.size("have") > 0, F.array_except(F.sequence(first, last), "have")).otherwise(F.col("have"))
    return have.select(label(first).alias("inicio"), label(last).alias("fim"), F.size("have").alias("presentes"), F.transform(F.array_sort(gaps), label).alias("faltando"))
