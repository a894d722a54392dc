import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in each column, empty and long texts, ties, repeated rows.
ODD = [
    (1, None, None, None, None), (None, "a null id, with words", "en", "s1", 3), (2, "", "en", "s1", 0), (3, "word " * 30_000, "en", "s2", 5),
    (4, "same row here", "en", "s1", 4), (4, "same row here", "en", "s1", 4), (4, "same id but another text", "en", None, 4), (5, " \t\n ", "en", "s2", 1),
    (6, "ÀÉÎ Straße 日本語 ☃", "de", "s3", 6), (7, "one", "en", "s3", 3),
]


@pytest.fixture
def odd(spark):
    """A table with the odd cases, and with columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    taken = "quality_score n_lines n_dropped pass_no virtual_finish n_tokens secrets license_scan passes finish component kept score no"
    df = df.withColumns({c: F.lit("own") for c in taken.split()})
    return df.withColumns({"row": F.lit(1), "size": F.lit("x"), "_id": F.lit(2), "fp": F.lit(3), "drop": F.lit(None).cast("string"), "a.b": F.lit(4)})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def docs_of(spark):
    return lambda texts, start=0: spark.createDataFrame([(i + start, t) for i, t in enumerate(texts)], "doc_id long, text string")
