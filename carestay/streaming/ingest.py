"""Micro-batch bronze ingestion.

The source loads generated stays in fixed-size batches, committing each and logging the
run. Here new raw CSV files landing in a folder are picked up by a file stream; each
micro-batch is schema-enforced, written to bronze (partitioned by ingestion date) and
logged. The checkpoint makes the file → batch assignment stable across restarts;
``foreachBatch`` itself is at-least-once, so every write of batch N goes to its own
``batch_id=N`` partitions in overwrite mode: a batch replayed after a failure or an executor
loss replaces its own output instead of appending it twice. ``maxFilesPerTrigger`` plays the
role of the batch size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carestay import schema as S
from carestay.sources.io import append_bronze, ingestion_log


def raw_stream(spark: SparkSession, landing_dir: str, files_per_batch: int = 1) -> DataFrame:
    return (spark.readStream.schema(S.STAY_SCHEMA).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").option("mode", "FAILFAST")
            .option("maxFilesPerTrigger", files_per_batch).csv(landing_dir))


def stream_bronze(spark: SparkSession, landing_dir: str, bronze_path: str, log_path: str,
                  checkpoint: str, files_per_batch: int = 1, available_now: bool = True) -> StreamingQuery:
    """Start the ingestion stream; with ``available_now`` it drains what has landed and stops.

    ``checkpoint`` is the stream's own lasting folder; a restart, also in another application, goes
    on from there. A malformed line fails the batch, as in the batch reader, and nothing of it is stored.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("source_fichier", F.coalesce("source_fichier", F.lit(f"batch_{batch_id}")))
        # idempotent per batch: a replay of batch N overwrites batch N only
        append_bronze(batch, bronze_path, str(batch_id))
        (ingestion_log(batch, "SUCCESS", f"micro-batch {batch_id}")
         .write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/batch_id={batch_id}"))

    w = (raw_stream(spark, landing_dir, files_per_batch).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
