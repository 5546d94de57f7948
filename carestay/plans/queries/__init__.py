"""Registered queries, one module per area; importing the package registers them all."""

from carestay.plans.queries import (  # noqa: F401
    blocks,
    explore,
    measures,
    model,
    quality,
    security,
    silver_gold,
    stats,
    timeintel,
)
