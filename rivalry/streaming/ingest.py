"""Incremental payload ingestion with Structured Streaming.

Each newly landed payload file is read once (the file source tracks what it
has seen in the checkpoint), flattened, reduced to one row per game key and
MERGEd into the date-partitioned fact table in ``foreachBatch``.  Every fact
row carries the request date and landing it came with, and a batch updates a
row only if its own are not older: the result is that of one load of all
documents, however they are cut into batches and whenever older ones arrive.
The upsert is idempotent, so a micro-batch replayed after a failure leaves the
same rows.  ``availableNow`` processes everything landed so far and stops,
which suits a scheduled run; a continuous deployment uses
``processingTime`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivalry.operators.quality import gate
from rivalry.plans.loads import stage_from_payloads, upsert_into
from rivalry.sources.payload import payload_report, with_landing
from rivalry.schemas import PAYLOAD


def payload_stream(spark: SparkSession, landing_dir: str, multiline: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(PAYLOAD).option("multiLine", multiline).option("mode", "FAILFAST")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_landing(r.json(landing_dir))


def ingest(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str,
           multiline: bool = True, available_now: bool = True,
           processing_time: str | None = None, max_files_per_trigger: int | None = None,
           strict: bool = True):
    """Start the ingestion query; with ``available_now`` it runs to completion.

    With ``strict`` each micro-batch passes the payload data tests before its
    MERGE; a failure stops the stream before that batch writes anything, and
    the batch is retried from the checkpoint once the files are fixed.
    """

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        if strict:
            gate(payload_report(batch))
        upsert_into(batch.sparkSession, table_path, stage_from_payloads(batch), latest=True)

    w = (payload_stream(spark, landing_dir, multiline, max_files_per_trigger)
         .writeStream.foreachBatch(upsert_batch)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
