"""From the clean text layer to the typed one: scope, dictionaries, numbers, months, lineage."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import canonical_key, clean_text_columns, decimal_comma, technology_scope, yyyymm
from ..sources.sinks import work_dir
from .dictionaries import translation_map

#: Bytes of dictionaries that a projection holds at most, all together.
LOOKUP_BYTES = 8 << 20


def add_lineage(df: DataFrame, year: Column | int, month: Column | int | None, part: str | None, file: Column | str, path: Column | str) -> DataFrame:
    """The six lineage columns, at the end."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.withColumns(
        {
            "ano_particao": lit(year).cast("smallint"), "mes_particao": lit(month).cast("tinyint"), "recorte_particao": lit(part).cast("string"),
            "arquivo_fonte": lit(file), "caminho_fonte": lit(path), "data_ingestao": F.current_timestamp(),
        }
    )


def bronze(raw: DataFrame, year: Column | int, month: Column | int | None = None, part: str | None = None, file: Column | str = "", path: Column | str = "") -> DataFrame:
    """Landed text with clean cells and lineage."""
    return add_lineage(clean_text_columns(raw), year, month, part, file, path)


@dataclass(frozen=True)
class Book:
    """A dictionary (codigo_norm, descricao; one row for each key). table: the same as a hash table in one row (see write_tables), with so
    many buckets; None for one that is so large that it is joined."""

    rows: DataFrame
    buckets: int | None = None
    table: DataFrame | None = None


_TABLES = "coluna string, n long, buckets array<map<string,string>>"


def write_tables(books: DataFrame, columns: list[str], path: str) -> None:
    """Writes a row for each column's dictionary: how many buckets its hash table has, and the table, an array of maps. The smallest
    dictionaries have one, as long as all together are within LOOKUP_BYTES; the others have none. books: (coluna, codigo_norm, descricao)."""
    spark, every = books.sparkSession, books.filter("codigo_norm IS NOT NULL")
    size = F.octet_length("codigo_norm") + F.coalesce(F.octet_length("descricao"), F.lit(0)) + 32
    found = {r["coluna"]: (r["bytes"], r["n"]) for r in every.groupBy("coluna").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).collect()}  # a row for each dictionary
    held, room = {}, LOOKUP_BYTES
    for c in sorted(columns, key=lambda c: found.get(c, (0, 0))):
        room -= found.get(c, (0, 0))[0]
        held[c] = max(1, found.get(c, (0, 0))[1]) if room >= 0 else None
    numbers = spark.createDataFrame([(c, n) for c, n in held.items()], "coluna string, n long")
    small = numbers.filter("n IS NOT NULL")
    placed = every.join(F.broadcast(small), "coluna").select("coluna", "n", F.pmod(F.xxhash64("codigo_norm"), "n").alias("place"), F.struct("codigo_norm", "descricao").alias("entry"))
    empty = small.select("coluna", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("place"), F.lit(None).cast(placed.schema["entry"].dataType).alias("entry"))
    buckets = placed.unionByName(empty).groupBy("coluna", "n", "place").agg(F.collect_list("entry").alias("entries"))
    in_order = F.array_sort(F.collect_list(F.struct("place", "entries")))  # within LOOKUP_BYTES
    tables = buckets.groupBy("coluna", "n").agg(F.transform(in_order, lambda x: F.map_from_entries(x["entries"])).alias("buckets"))
    tables.unionByName(numbers.filter("n IS NULL"), allowMissingColumns=True).coalesce(1).write.parquet(path)


def books_of(dictionaries: dict[str, DataFrame], tables: DataFrame) -> dict[str, Book]:
    """The dictionaries with their hash tables, as write_tables has written them."""
    sizes = {r["coluna"]: r["n"] for r in tables.select("coluna", "n").collect()}  # a row for each dictionary
    return {c: Book(d, sizes[c], tables.filter(F.col("coluna") == c).select("buckets")) for c, d in dictionaries.items()}


def sized(dictionaries: dict[str, DataFrame]) -> dict[str, Book]:
    """The dictionaries as translate() takes them, with tables in the shared folder."""
    if not dictionaries:
        return {}
    parts = [d.select(F.lit(c).alias("coluna"), "codigo_norm", "descricao") for c, d in dictionaries.items()]
    every = reduce(lambda a, b: a.union(b), parts)
    path = work_dir(every.sparkSession, "tables")
    write_tables(every, list(dictionaries), path)
    return books_of(dictionaries, every.sparkSession.read.schema(_TABLES).parquet(path))


def looked_up(code: Column, book: Book) -> Column:
    """Description of a code, by its canonical key; null for one that the book does not have. The table is a scalar subquery, so it is read
    once and sent with the tasks."""
    key = canonical_key(code)
    return F.try_element_at(F.get(book.table.scalar(), F.pmod(F.xxhash64(key), F.lit(book.buckets))), key)


def translate(fact: DataFrame, books: dict[str, Book]) -> DataFrame:
    """Adds <column>_descricao after each column that has a book (see sized). Rows and codes stay as they are. All columns of books
    with buckets are looked up in one projection, without a join; each of the others costs a join on the canonical key."""
    out, names = fact, []
    for c in fact.columns:
        names.append(F.col(f"`{c}`"))
        if c not in books:
            continue
        if books[c].buckets:
            names.append(looked_up(F.col(f"`{c}`"), books[c]).alias(f"{c}_descricao"))
        else:
            d = books[c].rows.select(F.col("codigo_norm").alias("_key"), F.col("descricao").alias(f"{c}_descricao"))
            out = out.join(d, canonical_key(F.col(f"`{c}`")) == F.col("_key"), "left").drop("_key")
            names.append(F.col(f"{c}_descricao"))
    return out.select(*names)


def typed(fact: DataFrame, numbers: dict[str, str], months: tuple[str, ...]) -> DataFrame:
    """Numbers by their types, <column>_data for months, lineage last; columns that are not there are passed over."""
    out, last = [], []
    for c in fact.columns:
        col = F.col(f"`{c}`")
        if c in C.TECHNICAL:
            continue
        out.append(decimal_comma(col, numbers[c]).alias(c) if c in numbers else col)
        if c in months:
            last.append(yyyymm(col).alias(f"{c}_data"))
    return fact.select(*out, *last, *[c for c in C.TECHNICAL if c in fact.columns])


def layout_of(table: str) -> tuple[dict[str, str], tuple[str, ...]]:
    if table in C.NEW_TABLES:
        return C.NUMBERS_NEW, C.MONTHS_NEW
    return (C.NUMBERS_OLD, C.MONTHS_OLD) if table in C.OLD_TABLES else (C.NUMBERS_CENSUS, ())


def build_silver(table: str, fact: DataFrame, dictionaries: dict[str, Book], full_market: bool = False) -> DataFrame:
    """The typed layer of a table. Rows outside the technology scope go before anything is joined, unless the full market
    is asked for or the table has no column to tell by."""
    scope = None if full_market else technology_scope(table, fact.columns)
    return typed(translate(fact if scope is None else fact.filter(scope), dictionaries), *layout_of(table))


def translation_report(spark: SparkSession, tables: dict[str, list[str]], sheets: set[str]) -> DataFrame:
    """(table, column, sheet, style) of what would be translated."""
    rows = [(t, c, m["aba"], m["estilo"]) for t, columns in tables.items() for c, m in translation_map(t, columns, sheets).items()]
    return spark.createDataFrame(rows, "table string, column string, sheet string, style string")
