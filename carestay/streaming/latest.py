"""The latest row per stay id, kept up to date as raw batches land.

A keyed state store holds the best row of each id (the greatest timestamp, ties by the other columns, as
``silver.dedup_latest`` has it). A micro-batch reads and writes the state of its own ids only and gives the rows that
replace what was known. An id's state goes when the watermark has passed its row by ``keep_days``:
a row that could still replace it would come after the watermark's allowance, and the sink, which keeps the best row
too, stays right when an expired id comes back. Rows behind the watermark are late and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from carestay.operators.silver import dedup_latest

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DAY_MS = 86_400_000


class LatestRow(StatefulProcessor):
    """State of one id: its best row so far, and a timer for the day it expires."""

    def __init__(self, schema: T.StructType, order: list[str], keep_days: int):
        self.schema, self.order, self.keep_ms = schema, order, keep_days * _DAY_MS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)

    def _rank(self, row) -> tuple:
        # nulls first, as in Spark's order of structs
        return tuple((row[c] is not None, row[c]) for c in self.order)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = self.schema.fieldNames()
        held = self.best.get() if self.best.exists() else None
        best = None if held is None else Row(**dict(zip(names, held)))
        new = None
        for row in rows:
            if best is None or self._rank(row) > self._rank(best):
                best = new = row
        if new is None:
            return
        self.best.update(tuple(new[c] for c in names))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(new["event_time"].timestamp() * 1000) + self.keep_ms)
        yield Row(**{c: new[c] for c in names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_stream(stream: DataFrame, key: str = "patient_id", ts: str = "ingestion_timestamp", lateness_days: int = 30,
                  keep_days: int = 30) -> DataFrame:
    """Streaming rows that replace what was known of their id (update mode); rows without id or timestamp are left out."""
    order = [ts, *[c for c in stream.columns if c not in (key, ts)]]
    rows = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("event_time", F.col(ts).cast("timestamp"))
    marked = rows.withWatermark("event_time", f"{lateness_days} days")
    return marked.groupBy(key).transformWithState(LatestRow(rows.schema, order, keep_days), rows.schema, "Update", "EventTime")


def start_latest(stream: DataFrame, sink_path: str, checkpoint: str, key: str = "patient_id", ts: str = "ingestion_timestamp",
                 lateness_days: int = 30, keep_days: int = 30, available_now: bool = True) -> StreamingQuery:
    """Write each micro-batch's replacing rows to its own folder; a replayed batch overwrites its own. ``read_latest`` reads them."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.drop("event_time").write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        w = (latest_stream(stream, key, ts, lateness_days, keep_days).writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint))
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)


def read_latest(spark: SparkSession, sink_path: str, key: str = "patient_id", ts: str = "ingestion_timestamp") -> DataFrame:
    """One row per id: the best of the rows that the micro-batches left."""
    return dedup_latest(spark.read.parquet(sink_path).drop("batch_id"), key, ts)
