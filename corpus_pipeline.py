"""A corpus from raw documents to a training mix, in five stages. Each stage's result is written as Parquet to the shared
folder and read again as the next one's documents, so a lost executor costs one stage's tasks at most.

Null, empty, repeated and very long texts, null ids and further columns are treated as the stages' operators say. All
stages but the last return the columns of the documents; n_chars, where there is one, follows the text. The last returns a
document as often as the mix takes it, with pass_no and virtual_finish (or these with a _ behind them, where the documents
have such columns, as the result itself has).
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microlake.llm import decontam, lines, mixing, quality, shingles
from microlake.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share, but for one that keeps them."""
    kept = lines.dedup_lines(docs)
    length = F.length("text").cast("long").alias("n_chars")
    return kept.select(*[length if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, of five-word shingles and similarity 0.8."""
    return shingles.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Classifier votes and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
