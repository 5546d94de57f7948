"""Distributed running totals over a global order.

Ranks, exact percentiles, Mann-Whitney / AUC, ROC points and exact stratified splits all
need cumulative counts along one ordering. A window ``orderBy`` without ``partitionBy``
would pull every row into one task, so instead:

1. the rows are dealt into ranges of (group, order), and each row notes its range;
2. sums per (group, range) give exclusive offsets: a group spans neighbouring ranges, so this
   table has at most groups + ranges rows;
3. a window partitioned by (group, range) adds the running sum inside each range.

Work is linear in the rows, whatever the number of ranges. Null groups are groups like any other.
Inputs are normally pre-aggregated to one row per distinct ordered value, so a value
that holds a third of all rows is one row here and cannot skew a task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay.plans.joins import broadcast_if_small, materialize, store_rows

TARGET_ROWS_PER_RANGE = 2_000_000
#: Rows per range where whole rows are ranked, not narrow sums: a task reads tens of MB of a feature table.
RANKED_ROWS_PER_RANGE = 200_000


def choose_ranges(largest_group_rows: int, rows: int, target: int = TARGET_ROWS_PER_RANGE) -> int:
    """Ranges of about ``target`` rows each; one if no group needs more than one window task."""
    return 1 if largest_group_rows <= target else math.ceil(rows / target)


def running_totals(g: DataFrame, order_cols: Sequence[Column | str], sum_cols: Sequence[str], partition_cols: Sequence[str] = (),
                   buckets: int | None = None, prefix: str = "cum_", materialize_input: bool = True) -> DataFrame:
    """Add inclusive running sums ``{prefix}{c}`` and group totals ``tot_{c}`` for ``sum_cols``.

    With ``buckets=None`` the number of ranges follows the data: about 2M rows per window task.
    ``materialize_input=False`` skips the checkpoint when ``g`` is a cheap, deterministic
    read (a narrow projection of a stored table): re-reading two columns beats rewriting them.
    """
    part = list(partition_cols)
    # g feeds several branches: write it once to the reliable checkpoint folder
    if materialize_input:
        g = materialize(g)
    if buckets is None:
        sizes = g.groupBy(*part).agg(F.count(F.lit(1)).alias("n")) if part else g.agg(F.count(F.lit(1)).alias("n"))
        most, rows = sizes.agg(F.max("n"), F.sum("n")).first()
        buckets = choose_ranges(most or 0, rows or 0)
    if buckets <= 1:
        # no group needs more than one window task: no offsets and no join
        w_cum = Window.partitionBy(*part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        w_tot = Window.partitionBy(*part)
        return g.select("*", *[F.sum(c).over(w_cum).alias(f"{prefix}{c}") for c in sum_cols],
                        *[F.sum(c).over(w_tot).alias(f"tot_{c}") for c in sum_cols])

    # the range number is stored with the row, so every branch sees the same ranges
    dealt = materialize(g.repartitionByRange(buckets, *[F.col(c) for c in part], *[F.col(c) if isinstance(c, str) else c for c in order_cols])
                        .withColumn("_range", F.spark_partition_id()))
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(part)]
    names = [f"_k{i}" for i in range(len(part))]
    tots = dealt.groupBy(*keys, F.col("_range").alias("_r")).agg(*[F.sum(c).alias(f"_bt_{c}") for c in sum_cols])
    # windows over the table of sums (at most groups + ranges rows), never over the input rows
    before = Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    tots = tots.select(*names, "_r", *[F.coalesce(F.sum(f"_bt_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
                       *[F.sum(f"_bt_{c}").over(Window.partitionBy(*names)).alias(f"tot_{c}") for c in sum_cols])
    same = reduce(lambda a, b: a & b, [dealt[c].eqNullSafe(tots[k]) for c, k in zip(part, names)], dealt["_range"] == tots["_r"])
    within = Window.partitionBy(*part, "_range").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(tots, same).select("*", *[(F.col(f"_off_{c}") + F.sum(c).over(within)).alias(f"{prefix}{c}") for c in sum_cols])
    return out.drop("_range", "_r", *names, *[f"_off_{c}" for c in sum_cols])


def row_ranks(df: DataFrame, order: Sequence[Column], partition_cols: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Add ``rank`` (1, 2, ... by ``order`` within the group) and ``group_rows`` to whole rows, however wide.

    The rows are shuffled once, into ranges of (group, order) of about ``RANKED_ROWS_PER_RANGE`` rows, and stored with their
    place in the sorted range. A rank is the rows of the group in lower ranges plus the place, so no window
    runs over the rows; only the counts per (group, range) are summed up. Rows of equal order get neighbouring ranks.
    """
    part = list(partition_cols)
    if ranges is None:
        ranges = max(1, math.ceil(df.count() / RANKED_ROWS_PER_RANGE))
    # the order's values are computed again in the range, so they are neither shuffled nor stored
    names = [f"_o{i}" for i in range(len(order))]
    ranged = df.repartitionByRange(ranges, *[F.col(c) for c in part], *order).select("*", *[o.alias(x) for o, x in zip(order, names)])
    # the id counts up along the sorted rows of a task and has the task's number in its high bits
    dealt = store_rows(ranged.sortWithinPartitions(*part, *names).drop(*names).withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_range", F.shiftright("_at", 33))
    names = [f"_k{i}" for i in range(len(part))]
    sizes = dealt.groupBy(*[F.col(c).alias(k) for c, k in zip(part, names)], F.col("_range").alias("_r")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*names).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*names, "_r", "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                         F.sum("_c").over(Window.partitionBy(*names)).alias("group_rows"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(part, names)], F.col("_range") == F.col("_r"))
    out = dealt.join(broadcast_if_small(sizes), same).withColumn("rank", F.col("_off") + F.col("_at") - F.col("_first") + 1)
    return out.drop("_at", "_range", "_r", "_first", "_off", *names)
