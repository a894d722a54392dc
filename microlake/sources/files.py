"""Landed files: profiles of text files, tolerant readers, and Parquet roots of mixed depth."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import normalized_names


#: Rows up to which spread() shuffles a table.
SPREAD_ROWS = 5_000_000


def delimiter_of(line: Column) -> Column:
    """; or , by which the line has more of; ; if it has as many."""
    return F.when(F.regexp_count(line, F.lit(",")) > F.regexp_count(line, F.lit(";")), ",").otherwise(";")


def file_profiles(spark: SparkSession, root: str) -> DataFrame:
    """(path, encoding, delimiter, header) of text files of any size. A file is UTF-8 if it has bytes beyond ASCII and is
    valid UTF-8, else Latin-1. Lines are read as bytes, in splits, and each file's are summed up where they are read."""
    lines = spark.read.option("recursiveFileLookup", True).text(root)
    raw = F.col("value").cast("binary")
    beyond = F.octet_length(F.decode(raw, "ISO-8859-1").cast("binary")) > F.octet_length(raw)
    head = F.when(F.col("_metadata.file_block_start") == 0, raw)  # of the first split, the first line
    tested = lines.select(F.col("_metadata.file_path").alias("path"), beyond.alias("beyond"), F.is_valid_utf8("value").alias("valid"), head.alias("head"), F.monotonically_increasing_id().alias("at"))
    first = F.min_by("head", F.when(F.col("head").isNotNull(), F.col("at")))  # a split is read from its start on, by one task
    files = tested.groupBy("path").agg(F.max("beyond").alias("beyond"), F.min("valid").alias("valid"), first.alias("head"))
    encoding = F.when(F.col("beyond") & F.col("valid"), "UTF-8").otherwise("ISO-8859-1")
    header = F.when(encoding == "UTF-8", F.decode("head", "UTF-8")).otherwise(F.decode("head", "ISO-8859-1"))
    return files.select("path", encoding.alias("encoding"), header.alias("header")).withColumn("delimiter", delimiter_of(F.col("header")))


#: Stands behind the last field while a line is parsed, so that empty fields at the end are told from missing ones.
_END = "\x01end"


@dataclass(frozen=True)
class Landed:
    """Rows of text files, united by column name; every column is text. Beside them, how many rows each file has of each kind."""

    rows: DataFrame
    counts: DataFrame


def read_landed(spark: SparkSession, root: str, sanitize: bool = False) -> Landed:
    """All text files below root, whatever their encodings, delimiters and headers are, in one scan: each line is parsed by its
    file's profile. Rows with too few fields are filled with nulls. Rows with too many are dropped (unless
    those beyond are empty), and so are rows whose quotation marks do not close. Lines that repeat the header of their file are headers.
    counts has (path, linhas, curtas, descartadas); linhas are those kept, curtas the ones of them that were filled. sanitize: lines are
    cleaned as by sanitized_lines() before they are parsed, and those that it drops count in nothing. Lines stay where they are read: the
    profiles, a row for each file as in the driver's own list of files, are sent to them."""
    profiles = file_profiles(spark, root)
    kinds = profiles.select("header", "delimiter").distinct().filter("header IS NOT NULL").orderBy("header").collect()  # different headers, not files
    headers = [(k["header"], [x.strip('"') for x in k["header"].split(k["delimiter"])]) for k in kinds]
    names = {h: normalized_names(fields) for h, fields in headers}
    columns = list(dict.fromkeys(c for some in names.values() for c in some))
    widest = max((len(some) for some in names.values()), default=0)
    lines = spark.read.option("recursiveFileLookup", True).text(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("raw"))
    told = lines.join(F.broadcast(profiles), "path").withColumn("line", F.when(F.col("encoding") == "UTF-8", F.decode("raw", "UTF-8")).otherwise(F.decode("raw", "ISO-8859-1")))
    if sanitize:
        told = sanitized_lines(told, "line")
    told = told.filter((F.col("line") != F.col("header")) & (F.trim("line") != ""))
    told = told.withColumn("core", F.rtrim("line", F.col("delimiter"))).withColumn("empty", F.length("line") - F.length("core"))
    marked = F.concat("core", "delimiter", F.lit(_END))
    schema = ", ".join(f"c{i} string" for i in range(widest + 3))
    parsed = lambda sep: F.from_csv(marked, F.lit(schema), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    one = told.withColumn("fields", F.when(F.col("delimiter") == ";", parsed(";")).otherwise(parsed(",")))
    cells = F.array(*[F.col(f"fields.c{i}") for i in range(widest + 3)])
    of = F.create_map(*[F.lit(x) for h, some in names.items() for x in (h, len(some))]) if names else F.lit(None).cast("map<string,int>")
    sized = one.select("path", "header", "empty", cells.alias("cells"), F.try_element_at(of, F.col("header")).alias("width"))
    found = (F.array_position("cells", _END) - 1).cast("int").alias("found")  # fields but for empty ones at the end; -1: too many, or an open quotation mark
    beyond = F.slice("cells", F.col("width") + 1, F.greatest(F.lit(0), F.col("found") - F.col("width")))
    kept = (F.col("found") >= 0) & F.forall(beyond, lambda x: F.coalesce(x, F.lit("")) == "")
    judged = sized.select("*", found).select("*", kept.alias("kept"), (F.col("found") + F.col("empty") < F.col("width")).alias("short"))

    def cell(column: str) -> Column:
        places = [(h, some.index(column)) for h, some in names.items() if column in some]
        at = F.try_element_at(F.create_map(*[F.lit(x) for place in places for x in place]), F.col("header"))
        return F.when(at < F.col("found"), F.get("cells", at)).alias(column)

    rows = judged.filter("kept").select(*[cell(c) for c in columns])
    n = lambda c: F.count_if(c)
    counts = judged.groupBy("path").agg(n(F.col("kept")).alias("linhas"), n(F.col("kept") & F.col("short")).alias("curtas"), n(~F.col("kept")).alias("descartadas"))
    return Landed(rows, counts)


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_positional(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.union(b), parts)


def sanitized_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines without NUL characters; those with less than two others are dropped."""
    clean = F.replace(F.col(column), F.lit("\x00"), F.lit(""))
    return lines.withColumn(column, clean).filter(F.length(F.trim(F.regexp_replace(F.col(column), r"\s+", " "))) >= 2)


def sanitize_report(lines: DataFrame, column: str = "value") -> DataFrame:
    """How many lines sanitized_lines keeps and drops."""
    kept = F.length(F.trim(F.regexp_replace(F.replace(F.col(column), F.lit("\x00"), F.lit("")), r"\s+", " "))) >= 2
    return lines.agg(F.count_if(F.coalesce(kept, F.lit(False))).alias("mantidas"), F.count_if(~F.coalesce(kept, F.lit(False))).alias("descartadas"))


def read_root(spark: SparkSession, root: str, merge: bool = False) -> DataFrame:
    """Parquet files below root at any depth, without columns from folder names. merge: columns differ between files."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge).parquet(root)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table of SPREAD_ROWS rows at most, which may stand in one file and so be read by one task, dealt out over the cores by a
    key; larger ones are left as they are read. Rows are counted from the files' footers."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key) if df.count() <= SPREAD_ROWS else df


def read_hive(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files with columns from folder names, by which Spark prunes."""
    return spark.read.parquet(root)


def row_count(spark: SparkSession, root: str) -> int:
    """Rows below root; no column is read."""
    return read_root(spark, root).count()


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """(arquivo, n) of the Parquet files below root that have rows, by path; no column is read."""
    return read_root(spark, root).groupBy(F.col("_metadata.file_path").alias("arquivo")).agg(F.count("*").alias("n"))


def first_available(spark: SparkSession, roots: list[str]) -> DataFrame | None:
    """The first root that can be read and isn't empty."""
    for root in roots:
        try:
            df = spark.read.parquet(root)
        except AnalysisException:
            continue
        if has_data(df):
            return df
    return None


def has_data(df: DataFrame) -> bool:
    return not df.isEmpty()


def row_ordinal(df: DataFrame) -> DataFrame:
    """Adds arquivo and row_index, a row's place in its Parquet file."""
    return df.select("*", F.col("_metadata.file_name").alias("arquivo"), F.col("_metadata.row_index").alias("row_index"))


def sheet_path(root: str, namespace: str, sheet: str, workbook: str | None = None) -> str:
    """Path of a code book's sheet: of a given workbook, or in any."""
    return f"{root}/{namespace}/{workbook or '*'}/{sheet}.parquet"


def sheet_exists(catalogue: DataFrame, namespace: str, sheet: str) -> bool:
    """catalogue: (namespace, sheet) of what is there."""
    return not catalogue.filter((F.col("namespace") == namespace) & (F.col("sheet") == sheet)).isEmpty()
