"""Item accuracy fed by a stream of scored files.

The original loads one scored file at start-up and answers per-item requests
from it.  Here a Structured Streaming job ingests every new scored file into
a Parquet ledger (file sink, append mode: exactly-once through the sink's
metadata log and the checkpoint in the shared folder, so a restarted driver
resumes where it stopped).  The per-item table is the batch
``item_accuracy`` over the ledger, so it always reflects every file ingested.

Only built-in sinks are used: no ``foreachBatch`` (which would need a Python
callback server on the driver) and no memory sink (which would hold the
results in the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.accuracy import item_accuracy
from shelfcast.session import scratch_dir
from shelfcast.sources.files import SCORED_SCHEMA, TEXT_DIALECT


def scored_stream(spark: SparkSession, scored_dir: str, sep: str = ";",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the scored files (typed, bad rows fail)."""
    reader = (spark.readStream.options(**TEXT_DIALECT).schema(SCORED_SCHEMA).option("sep", sep).option("header", True)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(scored_dir).withColumn("source_file", F.col("_metadata.file_path"))


def ingest_scored(spark: SparkSession, scored_dir: str, ledger_path: str,
                  checkpoint_location: str | None = None, available_now: bool = True,
                  **kw) -> StreamingQuery:
    """Start the ingest stream (append to the Parquet ledger)."""
    ckpt = checkpoint_location or scratch_dir(spark, "scored-ingest-ckpt")
    writer = (scored_stream(spark, scored_dir, **kw).writeStream.format("parquet")
              .outputMode("append").option("path", ledger_path).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def item_accuracy_stream(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The per-item accuracy table over everything ingested so far."""
    return item_accuracy(spark.read.parquet(ledger_path))


def run_item_accuracy(spark: SparkSession, scored_dir: str, ledger_path: str, **kw) -> DataFrame:
    """Ingest what is available now, wait for it, return the accuracy table."""
    q = ingest_scored(spark, scored_dir, ledger_path, **kw)
    q.awaitTermination()
    return item_accuracy_stream(spark, ledger_path)
