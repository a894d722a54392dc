"""Code books: from sheets (tables of text columns col_00, col_01, ...) to dictionaries (codigo_norm, codigo, descricao)."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.columns import canonical_key, trimmed


#: What Spark says of a file that is no table of its kind.
_UNREADABLE = ("CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA")


def sheet_rows(raw: DataFrame, sheet: str, workbook: str) -> DataFrame:
    """A sheet as read, as text: without rows and columns that are all null, columns renamed col_00 and so on, the words
    nan and NaT as null, and aba_origem and planilha_origem at the end."""
    text = raw.select(*[F.when(~F.col(f"`{c}`").cast("string").isin("nan", "NaT"), F.col(f"`{c}`").cast("string")).alias(c) for c in raw.columns])
    filled = text.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in text.columns]).first()
    held = [c for c, n in zip(text.columns, filled, strict=True) if n]
    if not held:
        return text.limit(0).select(F.lit(sheet).alias("aba_origem"), F.lit(workbook).alias("planilha_origem"))
    rows = text.filter(F.coalesce(*[F.col(f"`{c}`") for c in held]).isNotNull())
    named = rows.select(*[F.col(f"`{c}`").alias(f"col_{i:02d}") for i, c in enumerate(held)])
    return named.withColumns({"aba_origem": F.lit(sheet), "planilha_origem": F.lit(workbook)})


def _listed(rows: DataFrame, code: Column, text: Column, once: bool) -> DataFrame:
    """(codigo, descricao); once: each pair one time. What goes on to unique_key() needs no such step."""
    pairs = rows.select(code.alias("codigo"), text.alias("descricao"))
    return pairs.distinct() if once else pairs


def two_columns(sheet: DataFrame, once: bool = True) -> DataFrame:
    """Code in col_00, description in col_01; header words and nulls go."""
    code, text = trimmed("col_00"), trimmed("col_01")
    return _listed(sheet.filter(~code.isin(*C.HEADERS_TWO) & text.isNotNull()), code, text, once)


def colon(sheet: DataFrame, column: str = "col_00", once: bool = True) -> DataFrame:
    """code:description in one column, split at the first colon; rows without one (titles) go."""
    at = F.instr(F.col(column), ":")
    code = trimmed(F.substring(F.col(column), F.lit(1), at - 1))
    text = trimmed(F.substring(F.col(column), at + 1, F.length(column)))
    return _listed(sheet.filter(at > 0), code, text, once)


def side_by_side(sheet: DataFrame, columns: list[str]) -> DataFrame:
    """(column, codigo, descricao) of several colon lists that stand side by side, in one pass."""
    long = sheet.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("cell")) for c in columns])).alias("x")).select("x.*")
    at = F.instr("cell", ":")
    code = trimmed(F.substring(F.col("cell"), F.lit(1), at - 1))
    text = trimmed(F.substring(F.col("cell"), at + 1, F.length("cell")))
    return long.filter(at > 0).select("column", code.alias("codigo"), text.alias("descricao")).distinct()


def forward_fill(df: DataFrame, column: str, order: list[str], by: list[str] | None = None, name: str | None = None) -> DataFrame:
    """Nulls of a column take the last value before them, in the given order. by: the sheets or series that are filled
    each for itself; it is needed for tables of any size."""
    window = W.partitionBy(*(by or [])).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(name or column, F.last(column, ignorenulls=True).over(window))


def layout_field(sheet: DataFrame, field: str, order: str = "row_index", by: list[str] | None = None) -> DataFrame:
    """A field's codes from a layout sheet, whose field name (col_00) stands on the first line only; code in col_04,
    description in col_03. order: a column with the row's place in the sheet."""
    keys = by or [c for c in ("planilha_origem", "aba_origem") if c in sheet.columns]
    filled = forward_fill(sheet, "col_00", [order], keys, "field")
    mine = filled.filter((F.upper(trimmed("field")) == field.upper()) & F.col("col_04").isNotNull() & F.col("col_03").isNotNull())
    return mine.select(trimmed("col_04").alias("codigo"), trimmed("col_03").alias("descricao")).distinct()


def title_code(sheet: DataFrame, text_column: str = "col_00", code_column: str = "col_01", once: bool = True) -> DataFrame:
    """Description and code in given columns; titles, which have no code, and header words go."""
    code, text = trimmed(code_column), trimmed(text_column)
    return _listed(sheet.filter(code.isNotNull() & text.isNotNull() & ~F.lower(code).isin(*C.HEADERS_TITLE)), code, text, once)


def bands(sheet: DataFrame) -> dict[str, DataFrame]:
    """The two lists that stand side by side on the sheet of bands."""
    pairs = {c: C.CENSUS_LINK_PAIRS[c] for c in ("faixa_etaria", "faixa_remun_media_sm")}
    return {c: title_code(sheet, text, code) for c, (_, code, text) in pairs.items()}


def unique_key(dictionary: DataFrame) -> DataFrame:
    """One row for each canonical key, so that a join can't multiply rows. Code and description are the least of
    theirs, each for itself."""
    keyed = dictionary.filter("codigo IS NOT NULL").withColumn("codigo_norm", canonical_key("codigo"))
    return keyed.groupBy("codigo_norm").agg(F.min("codigo").alias("codigo"), F.min("descricao").alias("descricao"))


_STYLES: dict[str, Callable[..., DataFrame]] = {
    "2col": lambda s, **k: two_columns(s, False),
    "colon": lambda s, **k: colon(s, once=False),
    "colon_coluna": lambda s, **k: colon(s, k["coluna"], False),
    "cagestid": lambda s, **k: layout_field(s, k["campo"]),
    "titulo_codigo": lambda s, **k: title_code(s, k.get("col_desc", "col_00"), k.get("col_cod", "col_01"), False),
}


def dictionary(sheet: DataFrame, style: str, **where: str) -> DataFrame | None:
    """The dictionary of a sheet in one of the five styles; None for an empty one, so that its column is left alone."""
    if style not in _STYLES:
        raise ValueError(f"unknown style of dictionary: {style}")
    found = unique_key(_STYLES[style](sheet, **where))
    return None if found.isEmpty() else found


def manual_map(table: str) -> dict[str, dict[str, str]]:
    """Column: style, workbook (planilha; none: any), sheet and place of its dictionary, for the tables whose sheets are not
    named like their columns."""
    if table in C.OLD_TABLES:
        found = {c: {"estilo": "colon", "aba": s} for c, s in C.OLD_SHEETS.items()}
        found |= {c: {"estilo": "colon_coluna", "aba": "outros", "coluna": k} for k, c in C.SIDE_BY_SIDE.items()}
        return found | {c: {"estilo": "cagestid", "aba": "cagestid_layout", "campo": f} for f, c in C.LAYOUT_FIELDS.items()}
    if table not in C.CENSUS_TABLES:
        return {}
    links = table == "rais_vinc"
    fields, lists, pairs = (C.CENSUS_LINK_FIELDS, C.CENSUS_LINK_LISTS, C.CENSUS_LINK_PAIRS) if links else (C.CENSUS_ESTAB_FIELDS, C.CENSUS_ESTAB_LISTS, C.CENSUS_ESTAB_PAIRS)
    book = {"planilha": C.CENSUS_WORKBOOKS[table]}
    found = {c: {"estilo": "cagestid", "aba": C.CENSUS_LAYOUT_SHEETS[table], "campo": f} | book for c, f in fields.items()}
    found |= {c: {"estilo": "colon", "aba": s} | book for c, s in lists.items()}
    return found | {c: {"estilo": "titulo_codigo", "aba": s, "col_cod": code, "col_desc": text} | book for c, (s, code, text) in pairs.items()}


def dictionaries_of(table: str, columns: list[str], load: Callable[[str | None, str], DataFrame | None]) -> dict[str, DataFrame]:
    """Dictionaries of a table's columns by its map. load gives a workbook's sheet, or None. A column whose sheet is not there, is no
    table or has no rows for it stays untranslated, with a warning; a sheet that breaks when its rows are read is an error."""
    found = {}
    for c, m in manual_map(table).items():
        if c not in columns:
            continue
        where = {k: v for k, v in m.items() if k not in ("estilo", "aba", "planilha")}
        try:
            sheet, why = load(m.get("planilha"), m["aba"]), "is not there"
        except AnalysisException:
            sheet, why = None, "is not there"
        except (Py4JJavaError, PySparkException) as e:
            if not any(x in str(e) for x in _UNREADABLE):
                raise
            sheet, why = None, "cannot be read"
        book = None if sheet is None else dictionary(sheet, m["estilo"], **where)
        if book is not None:
            found[c] = book
        else:
            warnings.warn(f"{table}.{c} stays untranslated: sheet {m['aba']} of {m.get('planilha', 'any workbook')} {why if sheet is None else 'has no rows for it'}", stacklevel=2)
    return found


def translation_map(table: str, columns: list[str], sheets: set[str]) -> dict[str, dict[str, str]]:
    """Which columns can be translated, and how: for the new layout those with a sheet of their name, else by the map;
    columns or sheets that are missing are left out."""
    if table in C.NEW_TABLES:
        return {c: {"estilo": "2col", "aba": c} for c in columns if c in sheets and c not in C.TECHNICAL and c != "layout"}
    return {c: m for c, m in manual_map(table).items() if c in columns and m["aba"] in sheets}
