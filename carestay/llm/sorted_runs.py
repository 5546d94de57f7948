"""Sorted runs on disk: bucketed, sorted Parquet tables that merge joins read as they lie.

All runs of an index have one bucket count, and each bucket is one sorted file, so a join of two
runs, or of a run and rows dealt out alike, has neither exchange nor sort above the run. A run is
found again by its folder (``open_run``), also by a later session.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from carestay.llm.store import shared_path


@contextlib.contextmanager
def merge_settings(spark: SparkSession, more: Mapping[str, str] | None = None) -> Iterator[None]:
    """Settings for jobs that read runs: order of one-file buckets is trusted, a join may use a run's own
    bucketing where it is on fewer columns than the join, and shuffle files go when their job is done; and those in ``more``."""
    wanted = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
              "spark.sql.requireAllClusterKeysForCoPartition": "false",
              "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **(more or {})}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


class Run:
    """One bucketed, sorted table: its folder, its name in this session's catalog, its layout."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int, dealt: Sequence[str], order: Sequence[str]):
        self.spark, self.name, self.path = spark, name, path
        self.buckets, self.dealt, self.order = buckets, list(dealt), list(order)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Drop the table and delete its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def write_run(df: DataFrame, name: str, buckets: int, dealt: Sequence[str], order: Sequence[str], path: str | None = None) -> Run:
    """Write rows that are already dealt by ``dealt`` into ``buckets`` tasks as a run sorted by ``order``."""
    spark = df.sparkSession
    table = f"carestay_run_{uuid.uuid4().hex}"
    path = path or shared_path(spark, name)
    (df.write.format("parquet").option("parquet.enable.dictionary", "false").bucketBy(buckets, *dealt).sortBy(*order).option("path", path).saveAsTable(table))
    return Run(spark, table, path, buckets, dealt, order)


def open_run(spark: SparkSession, path: str, schema: str, buckets: int, dealt: Sequence[str], order: Sequence[str]) -> Run:
    """A run that ``write_run`` left in ``path``, with the layout it was written in."""
    table = f"carestay_run_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY ({', '.join(dealt)}) "
              f"SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return Run(spark, table, path, buckets, dealt, order)
