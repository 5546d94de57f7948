"""Statistical feature tests as aggregates.

Every test reduces the stays to a small table first — moments per feature, counts per
(feature, level, class), counts per (feature, value, class) — and finishes with
column arithmetic on that table. Tail probabilities are the only Python: a pandas UDF
over a handful of rows (one per feature), using closed forms of the normal and χ²
tails (integer degrees of freedom).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestay import schema as S
from carestay.functions import columns as C
from carestay.operators.explore import correlation_matrix, long_numeric
from carestay.plans.ranking import running_totals


# ----------------------------------------------------------------- tail probabilities

def chi2_sf_scalar(x: float, k: int) -> float:
    """Upper tail of χ² with integer k degrees of freedom (finite closed form)."""
    if x is None or k is None or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if k <= 0:
        return 1.0
    if x <= 0:
        return 1.0
    h = x / 2.0
    if k % 2 == 0:
        term, total = 1.0, 1.0
        for i in range(1, k // 2):
            term *= h / i
            total += term
        return min(1.0, math.exp(-h) * total)
    total = math.erfc(math.sqrt(h))
    # Σ_{i=1}^{(k-1)/2} h^{i-1/2} / Γ(i + 1/2), accumulated in log space
    for i in range(1, (k - 1) // 2 + 1):
        total += math.exp(-h + (i - 0.5) * math.log(h) - math.lgamma(i + 0.5))
    return min(1.0, total)


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf_scalar(float(a), int(b)) if pd.notna(a) and pd.notna(b) else float("nan")
                      for a, b in zip(x, k)])


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return pd.Series([min(1.0, math.erfc(abs(float(v)) / math.sqrt(2.0))) if pd.notna(v) else float("nan") for v in z])


# ----------------------------------------------------------------- J1 normality

def _dagostino(n: Column, g1: Column, b2: Column) -> tuple[Column, Column]:
    """Skewness and kurtosis z-scores of the D'Agostino-Pearson test (population moments)."""
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2.0 * (beta2 - 1)) - 1
    delta = 1.0 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    z1 = delta * F.asinh(y / alpha)
    e = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(var)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1 + 4.0 / (sb1 * sb1)))
    t1 = 1 - 2.0 / (9.0 * a)
    d = 1 + x * F.sqrt(2.0 / (a - 4.0))
    t2 = F.signum(d) * F.pow((1 - 2.0 / a) / F.abs(d), F.lit(1.0 / 3.0))
    z2 = (t1 - t2) / F.sqrt(2.0 / (9.0 * a))
    return z1, z2


def normality_test(df: DataFrame, cols: Sequence[str] = S.SCREEN_NUMERICAL) -> DataFrame:
    """D'Agostino-Pearson K² per column; ``normal`` = Yes when p > 0.05. One aggregate pass."""
    lg = long_numeric(df, cols).where(F.col("value").isNotNull())
    m = lg.groupBy("feature").agg(F.count("value").cast("double").alias("n"), F.skewness("value").alias("g1"),
                                  (F.kurtosis("value") + 3).alias("b2"))
    # the test needs at least 8 values; below that n is null and every term stays null
    z1, z2 = _dagostino(F.when(F.col("n") >= 8, F.col("n")), F.col("g1"), F.col("b2"))
    k2 = z1 * z1 + z2 * z2
    out = m.select("feature", k2.alias("statistic"))
    p = F.exp(-F.col("statistic") / 2)
    return out.select("feature", C.rnd("statistic", 4).alias("statistic"), C.rnd(p, 6).alias("p_value"),
                      F.when(p > 0.05, "Yes").otherwise("No").alias("normal"))


# ----------------------------------------------------------------- J2 chi-square

def contingency(df: DataFrame, cols: Sequence[str], target: str = S.TARGET) -> DataFrame:
    """Full contingency grid per feature (zero cells included): feature, level, class, observed."""
    wide = df.select(F.col(target).cast("string").alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols])
    lg = wide.unpivot(["_y"], list(cols), "feature", "level").where(F.col("level").isNotNull() & F.col("_y").isNotNull())
    obs = lg.groupBy("feature", "level", "_y").agg(F.count(F.lit(1)).alias("observed"))
    levels = obs.select("feature", "level").distinct()
    classes = obs.select("feature", "_y").distinct()
    # grid size = Σ levels × classes per feature: the contingency table itself
    grid = levels.join(classes, "feature")
    return grid.join(obs, ["feature", "level", "_y"], "left").select(
        "feature", "level", F.col("_y").alias("class"), F.coalesce("observed", F.lit(0)).alias("observed"))


def chi_square_stat(df: DataFrame, cols: Sequence[str] = S.SCREEN_CATEGORICAL, target: str = S.TARGET) -> DataFrame:
    """χ² (Yates-corrected when dof = 1), dof and Cramér's V per feature (no p-value)."""
    t = contingency(df, cols, target)
    # windows over the grid (levels × classes per feature): each cell sees its margins
    by_level, by_class = Window.partitionBy("feature", "level"), Window.partitionBy("feature", "class")
    t = t.select("*", F.sum("observed").over(by_level).alias("_row"), F.sum("observed").over(by_class).alias("_col"),
                 F.sum("observed").over(Window.partitionBy("feature")).alias("_n"),
                 F.count(F.lit(1)).over(by_class).alias("_r"), F.count(F.lit(1)).over(by_level).alias("_c"))
    e = F.col("_row").cast("double") * F.col("_col") / F.col("_n")
    dof = (F.col("_r") - 1) * (F.col("_c") - 1)
    dev = F.abs(F.col("observed") - e)
    yates = F.when(dof == 1, F.least(F.lit(0.5), dev)).otherwise(F.lit(0.0))
    cell = F.pow(dev - yates, 2) / e
    per = t.groupBy("feature").agg(F.sum(cell).alias("chi2"), F.first(dof).alias("dof"), F.first("_n").alias("n"),
                                   F.first(F.least("_r", "_c") - 1).alias("_k"))
    v = F.when(F.col("_k") > 0, F.sqrt(F.col("chi2") / (F.col("n") * F.col("_k")))).otherwise(F.lit(0.0))
    return per.select("feature", C.rnd("chi2", 2).alias("chi2"), F.col("dof").cast("int").alias("dof"),
                      C.rnd(v, 4).alias("cramers_v"), F.col("chi2").alias("_chi2_raw"))


def chi_square(df: DataFrame, cols: Sequence[str] = S.SCREEN_CATEGORICAL, target: str = S.TARGET) -> DataFrame:
    s = chi_square_stat(df, cols, target)
    p = chi2_sf(F.col("_chi2_raw"), F.col("dof"))
    out = s.select("feature", "chi2", p.alias("p_value"), "dof", "cramers_v",
                   F.when(p < 0.001, "Yes").otherwise("No").alias("significant"))
    # strongest association first; one row per feature
    return out.orderBy(F.desc("cramers_v"), "feature")


# ----------------------------------------------------------------- rank tables (J3, J4, K7)

def value_class_counts(df: DataFrame, cols: Sequence[str], target: str = S.TARGET) -> DataFrame:
    """(feature, value, n0, n1): one row per distinct value per feature."""
    lg = long_numeric(df, cols, [target]).where(F.col("value").isNotNull())
    y = F.col(target)
    return lg.groupBy("feature", "value").agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))


def mann_whitney_u(df: DataFrame, cols: Sequence[str] = S.SCREEN_NUMERICAL, target: str = S.TARGET,
                   buckets: int | None = None) -> DataFrame:
    """U of class 0 against class 1, tie-corrected z, effect U/(n0·n1), class means."""
    vc = value_class_counts(df, cols, target)
    r = running_totals(vc, ["value"], ["n0", "n1"], ["feature"], buckets)
    below1 = F.col("cum_n1") - F.col("n1")
    t = F.col("n0") + F.col("n1")
    per = r.groupBy("feature").agg(
        F.sum(F.col("n0").cast("double") * (below1 + 0.5 * F.col("n1"))).alias("u"),
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"),
        F.sum(t.cast("double") * t * t - t).alias("ties"),
        F.try_divide(F.sum(F.col("value") * F.col("n0")), F.sum("n0")).alias("mean0"),
        F.try_divide(F.sum(F.col("value") * F.col("n1")), F.sum("n1")).alias("mean1"))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    n = n0 + n1
    mu = n0 * n1 / 2
    # an empty class or an all-tied feature has no defined z: null instead of a failed job
    sd = F.sqrt(n0 * n1 / 12.0 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(F.col("u"), n0 * n1 - F.col("u")) - mu - 0.5, sd)
    return per.select("feature", F.col("u").alias("u_statistic"), z.alias("z"),
                      F.try_divide(F.col("u"), n0 * n1).alias("effect_r"), "mean0", "mean1", "n0", "n1")


def mann_whitney(df: DataFrame, cols: Sequence[str] = S.SCREEN_NUMERICAL, target: str = S.TARGET) -> DataFrame:
    m = mann_whitney_u(df, cols, target)
    p = normal_two_sided_p(F.col("z"))
    # U is often a .5 value: round half to even, as numpy does when the report rounds it
    return m.select("feature", F.bround("u_statistic", 0).alias("U_statistic"), C.rnd(p, 8).alias("p_value"),
                    C.rnd("effect_r", 4).alias("effect_r"), C.rnd("mean0", 3).alias("mean_readmit0"),
                    C.rnd("mean1", 3).alias("mean_readmit1"),
                    F.when(p < 0.001, "Yes").otherwise("No").alias("significant")).orderBy("p_value", "feature")


def kruskal_h(df: DataFrame, value: str = "age", group: str = "pathologie", buckets: int | None = None) -> DataFrame:
    """Kruskal-Wallis H with tie correction and its degrees of freedom."""
    base = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(
        F.col(value).cast("double").alias("v"), F.col(group).alias("g"))
    vg = base.groupBy("v", "g").agg(F.count(F.lit(1)).alias("n"))
    vv = vg.groupBy("v").agg(F.sum("n").alias("t"))
    r = running_totals(vv, ["v"], ["t"], (), buckets)
    ranks = r.select("v", "t", (F.col("cum_t") - F.col("t") + (F.col("t") + 1) / 2.0).alias("rank"))
    j = vg.join(ranks, "v")
    per = j.groupBy("g").agg(F.sum(F.col("n") * F.col("rank")).alias("R"), F.sum("n").alias("nj"))
    tot = per.agg(F.sum(F.col("R") * F.col("R") / F.col("nj")).alias("s"), F.sum("nj").cast("double").alias("N"),
                  F.count(F.lit(1)).alias("k"))
    ties = ranks.agg(F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("tie"))
    nn = F.col("N")
    h = F.try_divide(12.0 / (nn * (nn + 1)) * F.col("s") - 3 * (nn + 1),
                     1 - F.try_divide(ties.scalar(), nn * nn * nn - nn))
    return tot.select(h.alias("h"), (F.col("k") - 1).cast("int").alias("dof"), F.col("N").cast("bigint").alias("n"))


def kruskal_wallis(df: DataFrame, value: str = "age", group: str = "pathologie") -> DataFrame:
    k = kruskal_h(df, value, group)
    return k.select("h", "dof", chi2_sf(F.col("h"), F.col("dof")).alias("p_value"))


# ----------------------------------------------------------------- J5 VIF

def vif(df: DataFrame, cols: Sequence[str] = S.SCREEN_NUMERICAL) -> DataFrame:
    """VIF_j = (R⁻¹)_jj over complete cases; R comes from one correlation aggregate.

    Only the k×k correlation matrix (k = number of features) reaches the driver.
    """
    complete = df.where(F.lit(True) if not cols else F.expr(" AND ".join(f"{c} IS NOT NULL" for c in cols)))
    pairs = correlation_matrix(complete.select(*cols), list(cols), digits=None).collect()
    idx = {c: i for i, c in enumerate(cols)}
    r = np.eye(len(cols))
    for row in pairs:
        i, j = idx[row["col_a"]], idx[row["col_b"]]
        r[i, j] = r[j, i] = np.nan if row["corr"] is None else row["corr"]
    rows = list(zip(cols, vif_of_correlations(r)))
    return df.sparkSession.createDataFrame(rows, "feature string, vif double").orderBy(F.desc("vif"))


def vif_of_correlations(r: np.ndarray, tol: float = 1e-8) -> list[float | None]:
    """1 / (1 - R²) of each column on the others; infinity for a column that they determine, None for a constant one.

    A constant column has no correlation with anything; it is left out of the others' regressions.
    """
    k = len(r)
    constant = [k > 1 and all(np.isnan(r[i, j]) for j in range(k) if j != i) for i in range(k)]
    out: list[float | None] = []
    for i in range(k):
        others = [j for j in range(k) if j != i and not constant[j]]
        if constant[i]:
            out.append(None)
            continue
        beta = np.linalg.lstsq(r[np.ix_(others, others)], r[others, i], rcond=tol)[0] if others else np.zeros(0)
        left = 1.0 - float(r[i, others] @ beta)
        out.append(math.inf if left < tol else float(round(1.0 / min(left, 1.0), 2)))
    return out


def feature_screen(df: DataFrame) -> DataFrame:
    """All tests in one long table: test, feature, statistic, p_value."""
    n = normality_test(df).select(F.lit("normality").alias("test"), "feature", "statistic", "p_value")
    c = chi_square(df).select(F.lit("chi_square").alias("test"), "feature", F.col("chi2").alias("statistic"), "p_value")
    m = mann_whitney(df).select(F.lit("mann_whitney").alias("test"), "feature",
                                F.col("U_statistic").cast("double").alias("statistic"), "p_value")
    k = kruskal_wallis(df).select(F.lit("kruskal_wallis").alias("test"), F.lit("age~pathologie").alias("feature"),
                                  F.col("h").alias("statistic"), "p_value")
    v = vif(df).select(F.lit("vif").alias("test"), "feature", F.col("vif").alias("statistic"),
                       F.lit(None).cast("double").alias("p_value"))
    return n.unionByName(c).unionByName(m).unionByName(k).unionByName(v)
