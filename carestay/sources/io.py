"""Readers and writers: raw CSV, typed bronze, run log, gold tables, score export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carestay import schema as S
from carestay.operators.silver import enforce_bronze_schema


def read_stays_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of raw stays with the fixed schema (no inference; a UTF-8 BOM is stripped)."""
    return (spark.read.schema(S.STAY_SCHEMA).option("header", True).option("encoding", "UTF-8")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").option("mode", "FAILFAST").csv(path))


def append_bronze(df: DataFrame, path: str, batch_id: str) -> None:
    """Write typed bronze partitioned by ingestion date and batch.

    Only the partitions of this batch are replaced (dynamic partition overwrite): re-running a
    batch is idempotent, and another batch of the same day is left alone.
    Each task writes its own files; a failed task is retried without partial commits. Rows are
    clustered by day first, so a task does not write a file for every day.
    """
    out = (enforce_bronze_schema(df).withColumn("ingestion_date", F.to_date("ingestion_timestamp"))
           .withColumn("batch_id", F.lit(str(batch_id))))
    (out.hint("rebalance", "ingestion_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("ingestion_date", "batch_id").parquet(path))


def ingestion_log(df: DataFrame, status: str = "SUCCESS", message: str = "", seconds: float = 0.0) -> DataFrame:
    """One-row run log: row count, mean target (4 digits), duration (2 digits), status, message."""
    return df.agg(
        F.localtimestamp().alias("run_timestamp"),
        F.count(F.lit(1)).cast("bigint").alias("nb_lignes"),
        F.round(F.avg(F.col(S.TARGET).cast("double")).cast("decimal(18,8)"), 4).cast("decimal(5,4)").alias("taux_readmission"),
        F.lit(round(seconds, 2)).cast("decimal(8,2)").alias("duree_secondes"),
        F.lit(status).alias("statut"), F.lit(message).alias("message"))


def failure_log(spark: SparkSession, message: str, seconds: float = 0.0) -> DataFrame:
    """The run-log row of a failed run: 0 rows, rate 0, the error message."""
    return spark.range(1).select(
        F.localtimestamp().alias("run_timestamp"), F.lit(0).cast("bigint").alias("nb_lignes"),
        F.lit(0).cast("decimal(5,4)").alias("taux_readmission"),
        F.lit(round(seconds, 2)).cast("decimal(8,2)").alias("duree_secondes"),
        F.lit("FAILURE").alias("statut"), F.lit(message).alias("message"))


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)


def write_gold(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full-refresh table, in folders by the values of ``partition_by`` if given.

    Rows are dealt by those values first, so a value has few files; the rebalance splits a value that holds much of the rows.
    An empty text and a null share a folder and are read back as null.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> None:
    """Full-refresh table ``name`` at ``path``, dealt into ``buckets`` files by ``key`` and sorted by it.

    Tables with the same key and bucket count join on it without a shuffle.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))


def bucket_count(spark: SparkSession, path: str, bytes_per_bucket: int = 256 << 20, least: int = 8) -> int:
    """Buckets of about ``bytes_per_bucket`` for a table with the size of the files under ``path``."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(least, -(-size // bytes_per_bucket))


def register_silver(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def read_gold(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A gold table; ``schema`` keeps the types of columns that are folders (else they are inferred from the names)."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The score table that ``export_scores`` wrote (a fixed schema, no inference)."""
    schema = ("patient_id string, pathologie string, service string, age int, tranche_age string, score_risque_modele double, "
              "categorie_risque string, readmission_30j int")
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_stays(spark: SparkSession, path: str) -> DataFrame:
    """Raw stays from a CSV file or folder (``.csv``), or from Parquet."""
    if path.rstrip("/").lower().endswith(".csv"):
        return read_stays_csv(spark, path)
    return enforce_bronze_schema(spark.read.parquet(path))


def export_scores(scored: DataFrame, path: str) -> None:
    """Score table as CSV with a header (one file per task; no BOM)."""
    from carestay.operators.model import EXPORT_COLUMNS
    scored.select(*EXPORT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)
