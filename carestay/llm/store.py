"""Reading the given tables, storing intermediates in the shared folder, Arrow batch helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from carestay.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder, which the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    # the schema is given so that no job is spent on inferring it
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete the files of stored intermediates that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        if "/llm-" in folder:
            p = hadoop(folder)
            p.getFileSystem(conf).delete(p, True)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Sequence], schema: str) -> DataFrame:
    """Apply ``fn`` (record batch → column arrays in the order of ``schema``) to every Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cols = [c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(fn(batch), types)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    names, types = arrow_fields(schema)
    return df.mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "binary": pa.binary(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
          "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def arrow_fields(schema: str) -> tuple[list[str], list[pa.DataType]]:
    pairs = [p.strip().split(" ", 1) for p in schema.split(",")]
    return [n for n, _ in pairs], [_ARROW[t.strip()] for _, t in pairs]


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes; null counts as the empty text."""
    return column.cast(pa.binary()).fill_null(b"").to_pylist()


def strings(column: pa.Array) -> list[str]:
    """The texts of a string column; null counts as the empty text."""
    return column.fill_null("").to_pylist()
