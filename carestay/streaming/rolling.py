"""The rolling 30-day readmission measure, maintained incrementally as stays land.

Event time is the admission date. The stream keeps one state row a day: its stays and readmissions so far. A micro-batch
writes the days that it changed, with their new totals; the rolling sum of the days [d - days + 1, d] is taken over
that calendar-sized table when it is read, the same quantity as the batch ``timeintel.rolling_readmissions``. An event
thus costs one state update, not one for each of the windows that hold it. The watermark bounds the state: a day older
than the latest event by more than the allowed lateness is final, and its state is dropped; its totals stay in the sink.

``rolling_readmissions_stream`` is the sliding-window form, for sinks that take finished windows as rows: it holds
``days`` window rows for each day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carestay.operators.silver import clean_stays


def daily_counts_stream(raw_stream: DataFrame, lateness_days: int = 30) -> DataFrame:
    """Streaming DataFrame of (date, sejours, readmissions): one state row for each admission day within the lateness."""
    stays = clean_stays(raw_stream, strict=False).withColumn("event_time", F.col("date_admission").cast("timestamp"))
    agg = (stays.withWatermark("event_time", f"{lateness_days} days").groupBy(F.window("event_time", "1 day").alias("w"))
           .agg(F.count(F.lit(1)).alias("sejours"), F.count_if(F.col("readmission_30j") == 1).alias("readmissions")))
    return agg.select(F.col("w.start").cast("date").alias("date"), "sejours", "readmissions")


def rolling_readmissions_stream(raw_stream: DataFrame, days: int = 30, lateness_days: int = 30) -> DataFrame:
    """Streaming DataFrame: one row per (window end date) with stays and readmissions in the window."""
    stays = clean_stays(raw_stream, strict=False).withColumn("event_time", F.col("date_admission").cast("timestamp"))
    w = F.window("event_time", f"{days} days", "1 day")
    agg = (stays.withWatermark("event_time", f"{lateness_days} days")
           .groupBy(w.alias("w"))
           .agg(F.count(F.lit(1)).alias(f"sejours_{days}j"),
                F.count_if(F.col("readmission_30j") == 1).alias(f"readmissions_{days}j")))
    return agg.select(F.date_sub(F.col("w.end").cast("date"), 1).alias("date"),
                      f"sejours_{days}j", f"readmissions_{days}j")


def start_rolling(raw_stream: DataFrame, sink_path: str, checkpoint: str, available_now: bool = True, lateness_days: int = 30):
    """Write the totals of every day that a micro-batch changes to that batch's own folder (update mode).

    Days that the watermark has not closed yet are there as well, with what has landed so far, so a
    drained stream leaves nothing back. A replayed batch overwrites its own folder. ``read_rolling``
    gives the rolling sums.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}")

    q = (daily_counts_stream(raw_stream, lateness_days).writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint))
    return (q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")).start()


def read_daily(spark: SparkSession, sink_path: str) -> DataFrame:
    """One row per admission day: the totals that the latest micro-batch left."""
    rows = spark.read.parquet(sink_path)
    best = rows.groupBy("date").agg(F.max(F.struct("batch_id", "sejours", "readmissions")).alias("_last"))
    return best.select("date", "_last.sejours", "_last.readmissions")


def read_rolling(spark: SparkSession, sink_path: str, days: int = 30) -> DataFrame:
    """(date, sejours_<days>j, readmissions_<days>j) of each day whose window may hold a stay; days without stays count 0.

    A sink that no batch has reached gives no row.
    """
    daily = read_daily(spark, sink_path)
    ends = daily.agg(F.min("date").alias("lo"), F.date_add(F.max("date"), days - 1).alias("hi")).where("lo IS NOT NULL")
    every = ends.select(F.explode(F.sequence("lo", "hi")).alias("date"), F.lit(0).cast("long").alias("sejours"), F.lit(0).cast("long").alias("readmissions"))
    # one ordered window over the days (<= 366 rows a year), never over stays
    per_day = daily.unionByName(every).groupBy("date").agg(F.sum("sejours").alias("sejours"), F.sum("readmissions").alias("readmissions"))
    w = Window.orderBy(F.unix_date("date")).rangeBetween(-(days - 1), 0)
    return per_day.select("date", F.sum("sejours").over(w).alias(f"sejours_{days}j"), F.sum("readmissions").over(w).alias(f"readmissions_{days}j"))
