"""Incremental runs: the ledger as a batch anti-join, or a checkpointed stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from recordweave.operators.joins import completed, insert_or_ignore, pending
from recordweave.sources.ledger import record_key


def run_batch(files: DataFrame, done: DataFrame, allowed_types: list[str] | None = None) -> DataFrame:
    """Files of the allowed types that no earlier run has finished."""
    todo = pending(files, done, "pdf_name")
    return todo.filter(todo["pdf_type"].isin(*allowed_types)) if allowed_types else todo


def close_batch(todo: DataFrame, cache: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger with every pending file whose cache exists."""
    return insert_or_ignore(ledger, completed(todo, cache, "pdf_name"), ["pdf_name"], ["pdf_name"])


def stream_records(spark: SparkSession, folder: str, schema: str, sink: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Append records of new JSON files once: keys seen within `delay` of event time are dropped by the state store."""
    rows = spark.readStream.schema(schema).json(folder)
    keyed = rows.withColumn("record_key", record_key(rows["gna_id"], rows["lta_id"], rows["handler"], rows["pdf_name"])).withWatermark("ts", delay)
    return keyed.dropDuplicatesWithinWatermark(["record_key"]).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_once(spark: SparkSession, folder: str, schema: str, sink: str, checkpoint: str, key: list[str]) -> StreamingQuery:
    """Append the first record of each key, over all runs: a run takes the files that came since the last one.

    The state store holds every key seen (set the RocksDB provider where keys outgrow executors' memory); where keys
    repeat only within some time, stream_records drops them after it.
    """
    rows = spark.readStream.schema(schema).json(folder)
    return rows.dropDuplicates(key).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
