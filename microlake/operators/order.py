"""Order over many files and tasks: places of rows, places in their group, and forward fill of long series.

A table is range-sorted into files, each with its place in the order and each row with its place in the file. What has to be known of the
files before one (how many rows they have, which value they end with) is a row for each file, so no task gets more than a file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources import files, sinks

_FILE, _ROW = "_file", "_row"


@dataclass(frozen=True)
class Sorted:
    """A table in order: rows with _file (place of the row's file, from 0) and _row (its place in the file, from 0)."""

    rows: DataFrame
    columns: list[str]


def sorted_files(df: DataFrame, order: list[str | Column], tasks: int | None = None) -> Sorted:
    """df in ascending order (or as its columns say) in the shared folder, in ranges of about equal size."""
    path = sinks.work_dir(df.sparkSession, "sorted")
    dealt = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    return Sorted(read.select("*", part.alias(_FILE), F.col("_metadata.row_index").alias(_ROW)), df.columns)


def _before(counts: DataFrame, file: str) -> DataFrame:
    """counts: (file, n); adds what the files before one have together. A row for each file."""
    return counts.withColumn("_before", F.coalesce(F.sum("n").over(W.orderBy(file).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def placed(df: DataFrame, order: list[str | Column], name: str = "lugar", by: list[str] | None = None) -> DataFrame:
    """Adds a row's place in the order, from 1; with by, its place in its group. Rows that are equal in the order keep different
    places. Groups may be of any size."""
    found = sorted_files(df, [*(by or []), *order])
    before = _before(found.rows.groupBy(_FILE).agg(F.count("*").alias("n")), _FILE)
    whole = found.rows.join(F.broadcast(before.select(_FILE, "_before")), _FILE).withColumn("_place", F.col("_before") + F.col(_ROW))
    if by:
        firsts = whole.groupBy(*by).agg(F.min("_place").alias("_first"))
        same = [F.col(f"f.{c}").eqNullSafe(F.col(f"w.{c}")) for c in by]
        whole = whole.alias("w").join(firsts.alias("f"), same).select("w.*", (F.col("_place") - F.col("_first") + 1).cast("int").alias(name))
    else:
        whole = whole.withColumn(name, F.col("_place") + 1)
    return whole.select(*[f"`{c}`" for c in found.columns], name)


def table_ordinal(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all Parquet files below root with arquivo, row_index (place in the file, from 0) and lugar (place over all files in
    the order of their paths, from 0). Files are counted from their footers."""
    before = _before(files.row_counts(spark, root), "arquivo")
    rows = files.read_root(spark, root).select("*", F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.row_index").alias("row_index"))
    return rows.join(F.broadcast(before.select("arquivo", "_before")), "arquivo").withColumn("lugar", F.col("_before") + F.col("row_index")).drop("_before")


def forward_fill_long(df: DataFrame, column: str, order: list[str], by: list[str] | None = None, name: str | None = None, tasks: int | None = None) -> DataFrame:
    """forward_fill for series of any length: each file is filled by itself, and its first series goes on with the last value that
    the files before it have for that series."""
    by, found = by or [], sorted_files(df, [*(by or []), *order], tasks)
    key = F.struct(*[F.col(f"`{c}`") for c in by]) if by else F.lit(0)
    rows = found.rows.withColumn("_key", key)
    value = F.struct(F.col(f"`{column}`").alias("v"))
    ends = rows.groupBy(_FILE).agg(F.min_by("_key", _ROW).alias("first"), F.max_by("_key", _ROW).alias("last"))
    lasts = rows.filter(F.col(f"`{column}`").isNotNull()).groupBy(_FILE, "_key").agg(F.max_by(value, _ROW).alias("end"))
    # a row for each file: the series that it begins with, and what the files before it leave for that series
    closing = ends.alias("e").join(lasts.alias("l"), (F.col(f"e.{_FILE}") == F.col(f"l.{_FILE}")) & F.col("e.last").eqNullSafe(F.col("l._key")), "left")
    steps = closing.select(F.col(f"e.{_FILE}").alias(_FILE), F.col("last").alias("k"), "end", F.lit(1).alias("what"))
    asked = ends.select(_FILE, F.col("first").alias("k"), F.lit(None).cast(lasts.schema["end"].dataType).alias("end"), F.lit(0).alias("what"))
    over = W.partitionBy("k").orderBy(_FILE, "what").rowsBetween(W.unboundedPreceding, -1)
    carried = steps.unionByName(asked).withColumn("carry", F.last("end", ignorenulls=True).over(over)).filter("what = 0 AND carry IS NOT NULL")
    inside = F.last(value.getField("v"), ignorenulls=True).over(W.partitionBy(_FILE, "_key").orderBy(_ROW).rowsBetween(W.unboundedPreceding, W.currentRow))
    filled = rows.withColumn("_in", inside).alias("r").join(F.broadcast(carried.select(_FILE, "k", "carry").alias("c")), (F.col(f"r.{_FILE}") == F.col(f"c.{_FILE}")) & F.col("r._key").eqNullSafe(F.col("c.k")), "left")
    target = name or column
    kept = [F.col(f"r.`{c}`") for c in found.columns if c != target]
    return filled.select(*kept, F.coalesce(F.col("_in"), F.col("carry.v")).alias(target)).select(*[f"`{c}`" for c in [*df.columns, *([] if target in df.columns else [target])]])
