"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import work_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Everything that separates words once A-Z are lower case: ASCII that is neither a digit nor a-z.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands for a null id in join keys.
NO_ID = -(2**63)
ODD = 0x9E3779B97F4A7C15
#: Bytes of a text that WordHashes turns into numbers at once.
PIECE = 1 << 18
_MASK = 2**64 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage and survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long, so batches for Python of Spark's 10,000 rows take much memory in each task, in the JVM and in Python:
    sets the session to shorter ones, unless it has a size of its own."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, rows)


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """df marked for broadcast if it has at most most_rows rows; else df, which Spark then joins by shuffling.
    Counts, so df should be a stored table or a cheap plan."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone. lower() does just that on pure ASCII text, and much faster than translate()."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(c: Column) -> Column:
    """Array of the words of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(c, F.lit(""))), WORD_BREAK), "")


def with_key(docs: DataFrame, *more: str) -> DataFrame:
    """(_id, _dk, text, *more): a row's key is its id (null has its own value) and a hash of its text, so that rows
    that share an id but not a text stay apart, and exact repeats of a row get one answer."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(F.col("text")).alias("_dk"),
        F.col("text").cast("string").alias("text"),
        *more,
    )


def doc_id() -> Column:
    return F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id")


def held_out(modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves the remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def own_names(df: DataFrame, names: str) -> dict[str, str]:
    """For each of the space-separated names, a column name that df does not have yet: the name itself, or one with _ behind it."""
    held, out = {c.lower() for c in df.columns}, {}
    for n in names.split():
        out[n] = n
        while out[n].lower() in held:
            out[n] += "_"
        held.add(out[n].lower())
    return out


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that names beside it cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


class WordHashes:
    """64-bit hashes of the words of a text, by array operations on its bytes. Words are runs of the bytes for which is_word
    (256 booleans) holds. Texts of any length, and words of any length, are hashed whole, PIECE bytes at a time."""

    def __init__(self, is_word: np.ndarray):
        self.is_word = is_word
        self.values = np.where(is_word, np.arange(1, 257), 0).astype(np.uint64)
        self.up, self.down = self._powers(ODD), self._powers(pow(ODD, -1, 1 << 64))

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        steps = np.full(PIECE, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    def of(self, raw: bytes) -> np.ndarray:
        out, begun, size = [], 0, 0  # sum and length of a word that the piece before did not end
        for at in range(0, len(raw), PIECE):
            b = np.frombuffer(raw, np.uint8, min(PIECE, len(raw) - at), at)
            word = self.is_word.take(b)
            starts = np.flatnonzero(word[1:] > word[:-1]) + 1
            if word[0]:
                starts = np.concatenate([[0], starts])
            sums = np.add.reduceat(self.values.take(b) * self.up[: len(b)], starts) * self.down[starts] if len(starts) else np.zeros(0, np.uint64)
            if size and not word[0]:
                out.append(np.array([begun], np.uint64))
                begun = size = 0
            if size:
                sums[0] = (begun + int(sums[0]) * pow(ODD, size, 1 << 64)) & _MASK
            if word[-1]:
                last = int(starts[-1])
                size = (size if last == 0 else 0) + len(b) - last
                begun, sums = int(sums[-1]), sums[:-1]
            else:
                begun = size = 0
            out.append(sums)
        if size:
            out.append(np.array([begun], np.uint64))
        return mixed(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads what differs in some bits of a hash over all of them."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bytes_but(some: bytes) -> np.ndarray:
    """For each byte, whether it is none of these."""
    out = np.ones(256, bool)
    out[list(some)] = False
    return out


#: Bytes of words that ASCII white space separates.
NOT_SPACE = bytes_but(b" \t\n\x0b\x0c\r")
