"""Layers of the given tables that are written once for each session and folder, and read again by all queries after that:
the code books and the technology silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks

_BUILT: dict[tuple[str, str, str], tuple[tuple, str]] = {}


def fingerprint(spark: SparkSession, paths: list[str]) -> tuple:
    """Of the files below the paths: how many there are, their bytes, and a digest of their names, sizes and times of change. The
    files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length", "modificationTime")
    return tuple(files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def built(spark: SparkSession, folder: str, name: str, write: Callable[[str], None], tables: tuple[str, ...] = ()) -> DataFrame:
    """The layer; write(path) makes it where it is not there yet, or not there any more, or where files of the tables have changed
    since."""
    key, now = (spark.sparkContext.applicationId, folder, name), fingerprint(spark, [f"{folder}/{t}.parquet" for t in tables]) if tables else ()
    made_of, path = _BUILT.get(key, (None, ""))
    if made_of == now:
        try:
            return spark.read.parquet(path)
        except AnalysisException:  # the shared folder has been cleared
            pass
    path = sinks.work_dir(spark, name)
    write(path)
    _BUILT[key] = (now, path)
    return spark.read.parquet(path)


#: Bytecode above which the JVM only interprets a method.
LONGEST_METHOD = 8000


def short_methods(spark: SparkSession) -> None:
    """A stage of many columns becomes one method; where it is longer than the JVM compiles, each row costs some five times as much.
    Sets the session to compile such a stage in parts, unless it has a limit of its own."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, LONGEST_METHOD)


def forget(spark: SparkSession) -> None:
    """From now on this session's layers are built anew."""
    for key in [k for k in _BUILT if k[0] == spark.sparkContext.applicationId]:
        del _BUILT[key]
