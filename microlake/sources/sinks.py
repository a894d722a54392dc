"""Parquet sinks: compression and row groups of each layer, sorted and partitioned writes, and the ledger."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where that is unset on one machine (tests), a new temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


BRONZE_ROWS, PUBLISHED_ROWS = 250_000, 50_000


def _writer(df: DataFrame, group_rows: int):
    return df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").option("parquet.block.row.count.limit", str(group_rows))


def write_bronze(df: DataFrame, path: str) -> int:
    """Writes and returns the number of rows written, counted on the way."""
    seen = Observation()
    _writer(df.observe(seen, F.count(F.lit(1)).alias("n")), BRONZE_ROWS).mode("overwrite").parquet(path)
    return seen.get["n"]


#: Partitions that a task writes at once, with a file open for each.
FEW_PARTITIONS = 40


def _write_unsorted(df: DataFrame, path: str, by: list[str], **options: str) -> None:
    """Each task writes a file for each partition that it has rows for, without sorting the rows by partition before; only those beyond
    FEW_PARTITIONS are sorted."""
    spark, name = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, FEW_PARTITIONS)
    try:
        _writer(df, BRONZE_ROWS).mode("overwrite").options(**options).partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(name, before)


def dealt(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a partition are brought together, so that it gets few files; very large ones are split."""
    return df.hint("rebalance", *by)


def write_partitioned(df: DataFrame, path: str, by: list[str], deal: bool = True) -> None:
    """Replaces the partitions that df has rows for, and no others. deal: rows are not dealt() out yet."""
    _write_unsorted(dealt(df, by) if deal else df, path, by, partitionOverwriteMode="dynamic")


def write_few_partitioned(df: DataFrame, path: str, by: str) -> None:
    """A new table of few partitions: each task writes a file for each of them, and no row is shuffled or sorted before."""
    _write_unsorted(df, path, [by])


def build_per_file(bronze: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, by: tuple[str, ...] = (), file: str = "arquivo_fonte", force: bool = False) -> DataFrame:
    """Builds the silver of the bronze files that are not built yet (all of them if force), and returns their rows of the manifest:
    (file, lote, linhas_bronze, linhas). A file of which no row is in scope is in the manifest with none, so it is done too.

    The rows stand below path/dados in a folder for each build and, as in bronze, for each value of by and each file. What counts
    is the last row of the manifest for a file: a file that is built again, even to no rows, loses its old ones with that
    row. Rows are brought together by file before they are built, while they are narrow; build's filters are pushed down to where they are
    read. A build that is stopped before it leaves nothing that is read, and the next one begins with the same files."""
    spark = bronze.sparkSession
    held = manifest(spark, path, file)
    todo = bronze.groupBy(file).agg(F.count("*").alias("linhas_bronze"))
    if held is not None and not force:
        todo = todo.join(held.select(file), file, "left_anti")
        bronze = bronze.join(held.select(file), file, "left_anti")
    number = 1 + (0 if held is None else held.agg(F.max("lote")).first()[0] or 0)
    out = f"{path}/dados/lote={number}"
    write_partitioned(build(dealt(bronze, [*by, file])), out, [*by, file], False)
    todo.write.mode("overwrite").parquet(f"{path}/pedidos/lote={number}")
    wanted = spark.read.parquet(f"{path}/pedidos/lote={number}")
    try:
        made = spark.read.parquet(out).groupBy(F.col(file).cast("string").alias(file)).agg(F.count("*").alias("linhas"))
        rows = wanted.join(made, file, "left").fillna(0, ["linhas"])
    except AnalysisException:  # no file has rows in scope
        rows = wanted.withColumn("linhas", F.lit(0).cast("long"))
    rows.select(file, F.lit(number).alias("numero"), "linhas_bronze", "linhas").write.mode("overwrite").parquet(f"{path}/manifesto/lote={number}")
    return spark.read.parquet(f"{path}/manifesto/lote={number}").select(file, F.col("numero").alias("lote"), "linhas_bronze", "linhas")


def manifest(spark: SparkSession, path: str, file: str = "arquivo_fonte") -> DataFrame | None:
    """The last row of each file, (file, lote, linhas_bronze, linhas); None before the first build has ended."""
    try:
        rows = spark.read.parquet(f"{path}/manifesto")
    except AnalysisException:
        return None
    return rows.groupBy(file).agg(F.max_by(F.struct("numero", "linhas_bronze", "linhas"), "numero").alias("x")).select(file, F.col("x.numero").alias("lote"), "x.linhas_bronze", "x.linhas")


def read_per_file(spark: SparkSession, path: str, file: str = "arquivo_fonte") -> DataFrame:
    """The rows that count, with their file."""
    held = manifest(spark, path, file).filter("linhas > 0").select(F.col(file).alias("_f"), F.col("lote").alias("_l"))
    rows = spark.read.option("basePath", f"{path}/dados").parquet(f"{path}/dados")
    return rows.join(held, (F.col(file).cast("string") == F.col("_f")) & (F.col("lote") == F.col("_l")), "left_semi").drop("lote")


def write_sorted(df: DataFrame, path: str, by: str | None, files: int | None = None) -> None:
    """Sorted by a column over all files, so that readers skip row groups; unsorted if the column isn't there. files: a
    fixed number of them, for small tables."""
    if by in df.columns:
        df = (df.repartitionByRange(files, by) if files else df.repartitionByRange(by)).sortWithinPartitions(by)
    elif files:
        df = df.coalesce(files)
    _writer(df, PUBLISHED_ROWS).mode("overwrite").parquet(path)


def write_small(df: DataFrame, path: str) -> None:
    """An aggregate as one file."""
    _writer(df.coalesce(1), PUBLISHED_ROWS).mode("overwrite").parquet(path)


def verified(spark: SparkSession, path: str, written: int) -> bool:
    """Whether a table holds as many rows as were written."""
    return spark.read.parquet(path).count() == written


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
