"""Named queries (Spark) and their DuckDB oracles.

Every query reads the whole driver tables through the fixture projection, so its work
grows with the tables. ``QUERIES[name](spark, sf_dir)`` returns a DataFrame;
``ORACLES[name]`` is the DuckDB SQL giving the same rows and column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from carestay.plans import queries  # noqa: F401
