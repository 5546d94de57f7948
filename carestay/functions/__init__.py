"""Column functions. Every one returns a JVM-side Column expression (no Python UDF)."""

from carestay.functions.columns import *  # noqa: F401,F403
