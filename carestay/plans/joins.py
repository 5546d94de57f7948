"""Join helpers that broadcast only sides whose size has been measured."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestay.session import ensure_checkpoint_dir

# Rough per-value widths used to turn a row count into bytes (strings assumed short).
_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
          T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
          T.DecimalType: 16, T.StringType: 32}

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def row_width(schema: T.StructType) -> int:
    return sum(_WIDTH.get(type(f.dataType), 64) for f in schema.fields) + 16


def materialize(df: DataFrame) -> DataFrame:
    """Write a small intermediate to the reliable checkpoint folder and cut its lineage.

    Used for aggregates that are joined back: they are computed once, survive executor
    loss, and the join does not recompute the aggregate's scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_rows(df: DataFrame) -> DataFrame:
    """Write whole rows once, as compressed Parquet in the checkpoint folder, and read them back.

    For tables as long as the input: ``materialize`` writes its rows uncompressed.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Materialize ``df``, count it, and mark it for broadcast only under both bounds.

    Beyond the bounds the plain DataFrame is returned and Spark plans a shuffle join
    (sort-merge, with AQE skew splitting for hot keys).
    """
    m = materialize(df)
    n = m.count()
    if n <= max_rows and n * row_width(m.schema) <= max_bytes:
        return F.broadcast(m)
    return m


def fixed_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a relation whose size is fixed by construction (e.g. the 8-row ICD-10 table)."""
    return F.broadcast(df)


def ensure_parallelism(df: DataFrame, target: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``target`` partitions (default: the cluster's parallelism).

    A large table already has far more input splits than cores, and is returned as is.
    Only a small input (e.g. one Parquet row group read by a single task) is round-robin
    repartitioned, which keeps every core busy downstream at negligible cost.
    """
    try:
        n = target or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (AttributeError, NotImplementedError):  # sessions without RDD access keep the plan as is
        return df
    return df.repartition(n) if have < n else df
