"""Exploration: describe, class balance, missing counts, group rates, histograms,
correlations, summary and crosstabs — each one or two aggregate passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestay import schema as S
from carestay.functions import columns as C
from carestay.operators.measures import exact_percentiles
from carestay.plans.joins import broadcast_if_small


def long_numeric(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(extra..., feature, value) with every listed column cast to double (one row per cell)."""
    wide = df.select(*extra, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(extra), list(cols), "feature", "value")


def describe_numeric(df: DataFrame, cols: Sequence[str] = S.DESCRIBE_COLS, digits: int = 2) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max per column."""
    lg = long_numeric(df, cols)
    mom = lg.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                    F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                    F.max("value").alias("max"))
    q = exact_percentiles(lg, "value", [0.25, 0.5, 0.75], ["feature"])
    # both sides hold one row per described column (a bound fixed by the call)
    j = mom.join(F.broadcast(q), "feature", "left")
    return j.select("feature", "count", *[C.rnd(c, digits).alias(c) for c in ["mean", "std", "min"]],
                    C.rnd("p25", digits).alias("p25"), C.rnd("p50", digits).alias("p50"),
                    C.rnd("p75", digits).alias("p75"), C.rnd("max", digits).alias("max"))


def class_balance(df: DataFrame, col: str = S.TARGET, digits: int = 3) -> DataFrame:
    # rows without a level count neither as a level nor in the shares
    c = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # the window spans the per-level counts (one row per class), not the stays
    return c.select(col, "n", C.rnd(F.col("n") / F.sum("n").over(Window.partitionBy()), digits).alias("share"))


def missing_counts(df: DataFrame) -> DataFrame:
    """Null count per column, listing only columns with at least one null."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return agg.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column, missing)").where(F.col("missing") > 0)


def group_rates(df: DataFrame, dims: Sequence[str], target: str = S.TARGET) -> DataFrame:
    """(dimension, level, n, rate, global_rate): target mean per level of each dimension next to the global mean.

    One scan: GROUPING SETS over the dimensions, then window sums over the small table of levels.
    """
    flags = [F.grouping(d).alias(f"_g{i}") for i, d in enumerate(dims)]
    y = F.col(target).cast("double")
    per = df.groupingSets([[d] for d in dims], *dims).agg(F.count(F.lit(1)).alias("n"), F.count(y).alias("_m"), F.sum(y).alias("_s"), *flags)
    name, level = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, d in enumerate(dims):
        mine = F.col(f"_g{i}") == 0
        name, level = F.when(mine, F.lit(d)).otherwise(name), F.when(mine, F.col(d).cast("string")).otherwise(level)
    w = Window.partitionBy("dimension")  # over the table of levels
    return per.select(name.alias("dimension"), level.alias("level"), "n", "_m", "_s").select(
        "dimension", "level", "n", F.try_divide("_s", "_m").alias("rate"), F.try_divide(F.sum("_s").over(w), F.sum("_m").over(w)).alias("global_rate"))


def histogram_by_class(df: DataFrame, col: str, target: str = S.TARGET, bins: int = 30) -> DataFrame:
    """Equal-width bins over each class's own min-max range, last bin closed."""
    rng = df.groupBy(target).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    j = df.where(F.col(col).isNotNull()).select(target, col).join(broadcast_if_small(rng), target)
    b = F.when(F.col("_hi") > F.col("_lo"),
               F.least(F.floor((F.col(col) - F.col("_lo")) * F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))),
                       F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    h = j.groupBy(target, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"),
                                               F.first("_hi").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return h.select(target, "bin", "n", (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = S.CORRELATION_COLS, digits: int | None = 4) -> DataFrame:
    """Pearson correlation of every pair (lower triangle), pairwise-complete; NaN counts as null. Null if a column is constant.

    One aggregate over all pairs of built-in covariances and variances, which keep centred sums, so shifted columns lose no
    digits. (``corr`` itself raises on constant columns under ANSI rules.) ``digits=None`` leaves the value unrounded.
    """
    wide = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    there = lambda x, y: F.when(F.col(y).isNotNull(), F.col(x))
    sums = wide.agg(*[c for i, (a, b) in enumerate(pairs)
                      for c in (F.covar_pop(a, b).alias(f"c{i}"), F.var_pop(there(a, b)).alias(f"a{i}"), F.var_pop(there(b, a)).alias(f"b{i}"))],
                    *[F.max(F.abs(F.col(c))).alias(f"m{i}") for i, c in enumerate(cols)])
    at = {c: i for i, c in enumerate(cols)}
    # merged means of a constant column may differ by a rounding: so little spread, next to the values, is none
    spread = lambda v, c: F.when(F.col(v) > 1e-28 * F.col(f"m{at[c]}") * F.col(f"m{at[c]}"), F.sqrt(F.col(v)))
    value = lambda i: F.try_divide(F.col(f"c{i}"), spread(f"a{i}", pairs[i][0]) * spread(f"b{i}", pairs[i][1]))
    entries = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), value(i).alias("corr")) for i, (a, b) in enumerate(pairs)]
    out = sums.select(F.explode(F.array(*entries)).alias("e")).select("e.col_a", "e.col_b", "e.corr")
    return out if digits is None else out.withColumn("corr", C.rnd("corr", digits))


def dataset_summary(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_stays"),
                  C.rnd(F.avg(F.col(target).cast("double")), 3).alias("readmission_rate"),
                  C.rnd(F.avg("age"), 1).alias("mean_age"), C.rnd(F.avg("duree_sejour"), 1).alias("mean_los"),
                  C.rnd(F.avg("nb_medicaments"), 1).alias("mean_medications"),
                  C.rnd(F.avg("nb_hospitalisations_precedentes"), 2).alias("mean_prior_hosp"))


def crosstab(df: DataFrame, x: str, y: str) -> DataFrame:
    """Contingency counts in long form (rows with a null in x or y are left out)."""
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(x, y).agg(F.count(F.lit(1)).alias("n")))
