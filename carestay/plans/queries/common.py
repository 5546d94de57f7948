"""Shared inputs of the registered queries: the stored layers and output rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestay.functions.columns import rnd
from carestay.operators import gold, silver
from carestay.operators import measures as M

FEATURE_COLS_SQL = ", ".join(gold.FEATURE_TABLE_COLUMNS)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Typed bronze stays (the fixture projection, stored once per session)."""
    from carestay.plans.layers import bronze
    return bronze(spark, sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_stays(raw(spark, sf))


def features(spark: SparkSession, sf: str, extra=()) -> DataFrame:
    """The gold feature table (materialised once per session, then read)."""
    from carestay.plans.layers import gold_features
    return gold_features(spark, sf, extra)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[rnd(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def measure_base(spark, sf):
    return M.measure_base(features(spark, sf, extra=["sexe"]))


def unpivot_sql(cols, table="features", extra="", cast="DOUBLE") -> str:
    sel = ", ".join([extra] if extra else []) + (", " if extra else "") + ", ".join(f"CAST({c} AS {cast}) AS {c}" for c in cols)
    return f"(UNPIVOT (SELECT {sel} FROM {table}) ON {', '.join(cols)} INTO NAME feature VALUE value)"
