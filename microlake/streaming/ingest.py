"""Incremental ingest: each run takes the files that landed since the last one, exactly once, and can be stopped any time."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import clean_text_columns

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest_new(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str, fmt: str = "csv", **options: str) -> None:
    """Cleans new files of landing (text columns of schema) and appends them to out, with arquivo_fonte, caminho_fonte and data_ingestao."""
    query = _cleaned(spark, landing, schema, fmt, options).drop("_bytes").writeStream.format("parquet").option("path", out)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _cleaned(spark: SparkSession, landing: str, schema: T.StructType, fmt: str, options: dict[str, str]) -> DataFrame:
    raw = spark.readStream.schema(schema).options(**options).format(fmt).load(landing)
    named = raw.select("*", F.col("_metadata.file_name").alias("arquivo_fonte"), F.col("_metadata.file_path").alias("caminho_fonte"), F.col("_metadata.file_size").cast("string").alias("_bytes"))
    return clean_text_columns(named).withColumn("data_ingestao", F.current_timestamp())


def ingest_with_ledger(
    spark: SparkSession, landing: str, schema: T.StructType, out: str, ledger: str, checkpoint: str, table: str, fmt: str = "csv", files_per_batch: int | None = None, **options: str
) -> None:
    """ingest_new that also keeps the ledger: a row for each file with its rows as written, bytes and seconds. A batch writes its rows
    and then its ledger rows, both below its own name, which is the same when it runs again; so a run that is stopped in
    between changes nothing that counts, and the next one writes the same batch anew. Files that went well under another name
    (of a checkpoint that is lost) are not taken again."""
    if files_per_batch:
        options = options | {"maxFilesPerTrigger": str(files_per_batch)}
    name = uuid.uuid4().hex

    def write(batch: DataFrame, number: int) -> None:
        query = next(q for q in spark.streams.active if q.name == name)
        lot = f"{query.id}-{number}"  # the checkpoint keeps the id
        held = read_ledger(spark, ledger)
        if held is not None:
            done = held.filter((F.col("tabela") == table) & (F.col("lote") != lot) & (F.col("status") == "ok"))
            batch = batch.join(done.select("caminho_fonte"), "caminho_fonte", "left_anti")
        rows = f"{out}/lote={lot}"
        batch.write.mode("overwrite").parquet(rows)
        written = spark.read.schema(batch.schema).parquet(rows).groupBy("arquivo_fonte", "caminho_fonte").agg(
            F.count("*").alias("linhas"), F.max(F.col("_bytes").cast("long")).alias("bytes_compactado"), F.min("data_ingestao").alias("comeco")
        )
        seconds = (F.unix_micros(F.current_timestamp()) - F.unix_micros("comeco")) / 1e6
        made = written.select(F.lit(table).alias("tabela"), "arquivo_fonte", "caminho_fonte", F.lit(number).cast("long").alias("seq"), F.current_timestamp().alias("data_hora"), F.lit("ok").alias("status"), "linhas", "bytes_compactado", seconds.alias("segundos"))
        made.write.mode("overwrite").parquet(f"{ledger}/lote={lot}")

    query = _cleaned(spark, landing, schema, fmt, options).writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    try:
        return spark.read.parquet(ledger)
    except AnalysisException:  # not there yet
        return None


def ingested(spark: SparkSession, out: str, ledger: str) -> DataFrame:
    """The rows of batches that the ledger has."""
    lots = spark.read.parquet(ledger).select("lote").distinct()
    return spark.read.parquet(out).join(lots, "lote", "left_semi").drop("lote", "_bytes")


def keep_current(spark: SparkSession, ledger: str, schema: T.StructType, checkpoint: str, keys: tuple[str, ...] = ("tabela", "arquivo_fonte")) -> None:
    """Keeps the last row of each item of an append-only ledger (by data_hora, then seq) as the state of a streaming aggregate, in
    RocksDB under the checkpoint. A batch changes just the items that it has; one that is stopped runs again from the state
    before it."""
    rows = spark.readStream.schema(schema).parquet(ledger)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct("data_hora", "seq")).alias("row"))
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKSDB)
    try:
        query = last.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_STATE_STORE, before)
    query.awaitTermination()


def latest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last row of each item as of the last batch that has ended, read from the state."""
    state = spark.read.format("statestore").load(checkpoint)
    row = state.schema["value"].dataType.fieldNames()[0]
    return state.select(f"value.{row}.*")
