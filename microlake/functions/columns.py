"""Column builders: cleaning, typing, keys, classifications and metrics. All are built-in expressions, without UDFs."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

_INTEGERS = ("tinyint", "smallint", "int", "bigint")

#: The space separators of Unicode.
SPACES = "".join(chr(i) for i in range(0x3001) if unicodedata.category(chr(i)) == "Zs")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Without spaces at the ends, those of Unicode included (but no tabs or line ends)."""
    text = _col(c)  # pure ASCII has one of them, for which there is a faster call
    return F.when(F.length(text) == F.octet_length(text), F.trim(text)).otherwise(F.btrim(text, F.lit(SPACES)))


def clean_text(c: Column | str) -> Column:
    """Trimmed text; nothing left is null."""
    return F.nullif(trimmed(c), F.lit(""))


def clean_text_columns(df: DataFrame) -> DataFrame:
    """clean_text on every column, as text."""
    return df.select(*[clean_text(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def _plain(c: Column | str, to: str) -> Column:
    """An integer that is written as Spark writes it; null for all other text. Much cheaper than a pattern."""
    whole = _col(c).try_cast(to)
    return F.when(whole.cast("string") == _col(c), whole)


def decimal_comma(c: Column | str, to: str) -> Column:
    """A number with a decimal comma as the type to; what isn't one is null. Integers round half away from zero, and are
    null out of range. One chain of calls, so that nothing is computed twice; integers in plain digits are told before it."""
    text = F.regexp_extract(F.replace(trimmed(c), F.lit(","), F.lit(".")), r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$", 0)
    if to not in _INTEGERS:
        return text.try_cast(to)
    return F.coalesce(_plain(c, "bigint").try_cast(to), F.round(text.try_cast("decimal(38,9)"), 0).try_cast(to))


def yyyymm(c: Column | str) -> Column:
    """First day of a month written YYYYMM; null where that isn't one. Six plain digits need no parser of dates."""
    part = lambda at, n: F.substring(_col(c), at, n).cast("int")
    month = _plain(c, "int")
    plain = month.between(100001, 999912) & (month % 100).between(1, 12)
    return F.coalesce(F.when(plain, F.make_date(part(1, 4), part(5, 2), F.lit(1))), F.try_to_date(F.regexp_extract(trimmed(c), r"^\d{6}$", 0), "yyyyMM"))


def canonical_key(c: Column | str) -> Column:
    """Codes for joins: whole numbers without leading zeros, other text trimmed."""
    text = trimmed(c)
    return F.coalesce(text.try_cast("bigint").cast("string"), text)


def digits(c: Column | str, width: int) -> Column:
    """The digits alone, filled with zeros on the left or cut to width."""
    return F.lpad(F.regexp_replace(_col(c), "[^0-9]", ""), width, "0")


_SECTION_OF_DIVISION = [next((n for low, high, n in C.SECTIONS if low <= d <= high), None) for d in range(100)]


def section_of(c: Column | str) -> Column:
    """Name of the section that an activity code's division lies in; null in the gaps between them. The names stand in an
    array by division, so the code is parsed once."""
    names = F.array(*[F.lit(n).cast("string") for n in _SECTION_OF_DIVISION])
    return F.get(names, F.substring(digits(c, 7), 1, 2).cast("int"))


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def area_of(c: Column | str) -> Column:
    """Area of technology work of an occupation code; single occupations come before their family."""
    code = digits(c, 6)
    families = {f: area for area, some in C.AREA_FAMILIES.items() for f in some}
    return F.coalesce(F.try_element_at(_map(C.AREA_OCCUPATIONS), code), F.try_element_at(_map(families), F.substring(code, 1, 4)), F.lit(C.AREA_OTHER))


def is_tech_sector(c: Column | str) -> Column:
    return _col(c).isin(*C.TECH_SUBCLASSES)


def is_tech_occupation(c: Column | str) -> Column:
    """By family or single code, after trimming and filling with zeros; other characters are not taken out."""
    code = F.lpad(F.trim(_col(c)), 6, "0")
    return F.substring(code, 1, 4).isin(*C.TECH_FAMILIES) | code.isin(*C.TECH_OCCUPATIONS)


def scope_columns(table: str, columns: list[str]) -> tuple[str | None, str | None]:
    """Names of the activity and occupation columns of a table, None for those it lacks."""
    sector, occupation = C.SCOPE_COLUMNS.get(table, C.SCOPE_COLUMNS["caged_mov"])
    return sector if sector in columns else None, occupation if occupation in columns else None


def technology_scope(table: str, columns: list[str]) -> Column | None:
    """Sector or occupation, by the lenses that the columns allow; None where there is neither."""
    sector, occupation = scope_columns(table, columns)
    parts = [f(c) for f, c in ((is_tech_sector, sector), (is_tech_occupation, occupation)) if c]
    return reduce(or_, parts) if parts else None


def with_lenses(df: DataFrame, sector: str = "subclasse", occupation: str = "cbo2002ocupacao") -> DataFrame:
    """Adds setor_ti and ocupacao_ti; unknown codes are false."""
    no = F.lit(False)
    return df.withColumns({"setor_ti": F.coalesce(is_tech_sector(sector), no), "ocupacao_ti": F.coalesce(is_tech_occupation(occupation), no)})


def lens_category(sector: Column, occupation: Column) -> Column:
    """Label of both lenses, for rows inside the technology scope."""
    return F.when(sector & occupation, C.LENS_BOTH).when(occupation, C.LENS_OCCUPATION).otherwise(C.LENS_OTHER)


def exact_mean(c: Column) -> Column:
    """Mean of numbers with up to six decimals, through an exact sum: the same however rows are dealt out."""
    return F.sum(c.cast("decimal(28,6)")).cast("double") / F.nullif(F.count(c), F.lit(0))


def metrics(balance: str = "saldomovimentacao", wage: str = "salario", age: str = "idade", wage_name: str = "salario_medio", age_name: str = "idade_media") -> list[Column]:
    """Admissions, separations, balance, and mean wage (given ones only) and age of those admitted; for one agg()."""
    b = F.col(balance)
    return [
        F.count_if(b == 1).alias("admissoes"),
        F.count_if(b == -1).alias("desligamentos"),
        F.sum(b).cast("long").alias("saldo"),
        F.round(exact_mean(F.when((b == 1) & (F.col(wage) > 0), F.col(wage))), 2).alias(wage_name),
        F.round(exact_mean(F.when(b == 1, F.col(age))), 1).alias(age_name),
    ]


def slug(c: Column | str) -> Column:
    """Text without accents, runs of other characters as _, in lower case; nothing left is sem_nome."""
    letters = "".join(chr(i) for i in range(0xC0, 0x180) if chr(i).isalpha() and ord(unicodedata.normalize("NFKD", chr(i))[0]) < 128)
    plain = "".join(unicodedata.normalize("NFKD", x)[0] for x in letters)
    text = F.regexp_replace(F.translate(F.regexp_replace(_col(c), r"\p{M}", ""), letters, plain), "[^0-9A-Za-z]+", "_")
    return F.coalesce(F.nullif(F.lower(F.btrim(text, F.lit("_"))), F.lit("")), F.lit("sem_nome"))


def normalized_names(names: list[str]) -> list[str]:
    """Column names from a file's header: lower case, no accents, _ for other characters, unique."""
    out: list[str] = []
    for name in names:
        plain = "".join(x for x in unicodedata.normalize("NFKD", name) if not unicodedata.combining(x))
        base = re.sub(r"[^0-9a-z]+", "_", plain.lower()).strip("_") or "coluna"
        n, unique = 1, base
        while unique in out:
            n += 1
            unique = f"{base}_{n}"
        out.append(unique)
    return out


def truncated_label(c: Column | str, width: int) -> Column:
    return F.substring(_col(c), 1, width)


def ym_label(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")
