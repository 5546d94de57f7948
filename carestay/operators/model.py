"""Readmission risk model: split, preprocessing, weighted logistic regression,
cross-validation, exact metrics, bootstrap intervals, importances and export.

The model queries fit all folds and the whole training set together by Newton steps
(``operators/newton.py``). ``fit_logistic`` fits one model on Spark ML (L-BFGS over
``treeAggregate``); both have the objective of an L2 logistic regression with inverse strength C and
balanced class weights n / (2·n_c): Spark ML minimises the weighted mean loss plus
λ/2·‖β‖², so λ = 1 / (C·Σw). Scaling uses the population standard deviation, one-hot
keeps every level and maps unseen levels to all zeros.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay import schema as S
from carestay.functions import columns as C
from carestay.operators import newton
from carestay.operators.newton import LogisticFit
from carestay.plans.joins import materialize
from carestay.plans.ranking import row_ranks, running_totals

PROB = "score_risque_modele"


# ------------------------------------------------------------------ K1 split and folds

def hash_order(key: str, seed: int) -> Column:
    """md5 hex of key-seed: a deterministic row order."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit("-"), F.lit(str(seed))))


def stratified_split(df: DataFrame, label: str = S.TARGET, key: str = S.KEY, test: float = 0.2,
                     seed: int = 42, folds: int = 5, buckets: int | None = None) -> DataFrame:
    """Exact per-class split and stratified folds.

    Rows are ranked within their class by md5(key-seed); the first round(test·n_c) ranks
    form the test set, the remaining rows are dealt into ``folds`` folds by rank. The rows, all
    columns of them, are shuffled once, into ``buckets`` ranges (by default as many as the rows ask for), so no class is sorted in one task.
    """
    r = row_ranks(df, [hash_order(key, seed), F.col(key)], [label], buckets)
    n_test = F.floor(F.col("group_rows") * F.lit(test) + 0.5)
    rank = F.col("rank")
    return r.select(*df.columns, F.when(rank <= n_test, "test").otherwise("train").alias("split"),
                    F.when(rank > n_test, ((rank - n_test - 1) % folds).cast("int")).alias("fold"))


# ------------------------------------------------------------------ K2-K4 fit

@dataclass
class RiskModel:
    pipeline: PipelineModel
    means: dict
    stds: dict
    numeric: list
    binary: list
    categorical: list

    def feature_names(self) -> list[str]:
        names = [f"{c}" for c in self.numeric] + list(self.binary)
        stages = self.pipeline.stages
        for c in self.categorical:
            idx = next(s for s in stages if hasattr(s, "labels") and s.getOutputCol() == f"{c}_idx")
            names += [f"{c}_{lvl}" for lvl in idx.labels]
        return names

    @property
    def coefficients(self) -> list[float]:
        return [float(x) for x in self.pipeline.stages[-1].coefficients]


def _scaled(means: dict, stds: dict) -> list[Column]:
    return [((F.col(c).cast("double") - F.lit(means[c])) /
             F.lit(stds[c] if stds[c] and stds[c] > 0 else 1.0)).alias(f"{c}_z") for c in means]


def _class_weights(n: int, n1: int) -> tuple[float, float]:
    n0 = n - n1
    return (n / (2.0 * n0) if n0 else 0.0, n / (2.0 * n1) if n1 else 0.0)


def balanced_weights(train: DataFrame, label: str = S.TARGET) -> Column:
    """n / (2·n_c) per class, from one aggregate of the training rows."""
    c = train.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n1")).first()
    w0, w1 = _class_weights(c["n"], c["n1"])
    return F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0))


def fit_logistic(train: DataFrame, c: float = 1.0, max_iter: int = 1000, label: str = S.TARGET,
                 numeric: Sequence[str] = S.NUMERICAL_FEATURES, binary: Sequence[str] = S.BINARY_FEATURES,
                 categorical: Sequence[str] = S.CATEGORICAL_FEATURES, tol: float = 1e-6) -> RiskModel:
    # the training rows are read by several passes (moments, indexers): checkpoint them once
    train = materialize(train.select(*numeric, *binary, *categorical, label))
    stats = train.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(label) == 1).alias("_n1"),
                      *[F.avg(x).alias(f"m_{x}") for x in numeric],
                      *[F.stddev_pop(x).alias(f"s_{x}") for x in numeric]).first()
    means = {x: float(stats[f"m_{x}"]) for x in numeric}
    stds = {x: float(stats[f"s_{x}"] or 0.0) for x in numeric}
    n = stats["_n"]
    w0, w1 = _class_weights(n, stats["_n1"])
    w = F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0))
    prepared = train.select("*", *_scaled(means, stds), w.alias("_w"))
    idx = [StringIndexer(inputCol=x, outputCol=f"{x}_idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for x in categorical]
    ohe = OneHotEncoder(inputCols=[f"{x}_idx" for x in categorical], outputCols=[f"{x}_ohe" for x in categorical],
                        dropLast=True)
    asm = VectorAssembler(inputCols=[f"{x}_z" for x in numeric] + list(binary) + [f"{x}_ohe" for x in categorical],
                          outputCol="features_vec")
    prep = Pipeline(stages=[*idx, ohe, asm]).fit(prepared)
    # every L-BFGS step is a pass over the assembled vectors: checkpoint those, not the rows
    vectors = materialize(prep.transform(prepared)
                          .select("features_vec", F.col(label).cast("double").alias(label), "_w"))
    # Σw = n with balanced weights, so λ = 1 / (C·n)
    lr = LogisticRegression(featuresCol="features_vec", labelCol=label, weightCol="_w", regParam=1.0 / (c * n),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol,
                            probabilityCol="_prob", rawPredictionCol="_raw", predictionCol="_pred")
    model = PipelineModel(stages=[*prep.stages, lr.fit(vectors)])
    return RiskModel(model, means, stds, list(numeric), list(binary), list(categorical))


def score(df: DataFrame, model: RiskModel | LogisticFit, threshold: float = 0.5) -> DataFrame:
    """Probability of class 1 and the predicted class (1 when the probability is above ``threshold``)."""
    if isinstance(model, LogisticFit):
        p = model.probability()
        return df.select("*", p.alias(PROB), (p > threshold).cast("int").alias("prediction"))
    prepared = df.select("*", *_scaled(model.means, model.stds))
    out = model.pipeline.transform(prepared)
    p = vector_to_array(F.col("_prob"))[1]
    keep = [c for c in df.columns]
    return out.select(*keep, p.alias(PROB), (p > threshold).cast("int").alias("prediction"))


# ------------------------------------------------------------------ K7-K9 metrics

def score_label_counts(df: DataFrame, score: str, label: str = S.TARGET, group_by: Sequence[str] = ()) -> DataFrame:
    y = F.col(label)
    return (df.where(F.col(score).isNotNull() & y.isNotNull())
            .groupBy(*group_by, score).agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")))


def exact_auc(df: DataFrame, score: str = PROB, label: str = S.TARGET, group_by: Sequence[str] = (),
              buckets: int | None = None, weights: tuple[str, str] | None = None) -> DataFrame:
    """Tie-aware AUC = P(score of a positive > score of a negative) + ½·P(tie)."""
    g = score_label_counts(df, score, label, group_by) if weights is None else df
    n0, n1 = weights or ("n0", "n1")
    r = running_totals(g, [score], [n0, n1], group_by, buckets)
    below0 = F.col(f"cum_{n0}") - F.col(n0)
    agg = [F.sum(F.col(n1).cast("double") * (below0 + 0.5 * F.col(n0))).alias("_u"), F.sum(n0).alias("_n0"), F.sum(n1).alias("_n1")]
    per = r.groupBy(*group_by).agg(*agg) if group_by else r.agg(*agg)
    auc = F.when((F.col("_n0") > 0) & (F.col("_n1") > 0), F.col("_u") / (F.col("_n0").cast("double") * F.col("_n1")))
    return per.select(*group_by, auc.alias("auc"), F.col("_n0").cast("double").alias("n0"),
                      F.col("_n1").cast("double").alias("n1"))


def roc_points(df: DataFrame, score: str = PROB, label: str = S.TARGET, buckets: int | None = None) -> DataFrame:
    """One point per distinct score t: rates of scores ≥ t (no intermediate points dropped)."""
    g = score_label_counts(df, score, label)
    r = running_totals(g, [score], ["n0", "n1"], (), buckets)
    tp = F.col("tot_n1") - F.col("cum_n1") + F.col("n1")
    fp = F.col("tot_n0") - F.col("cum_n0") + F.col("n0")
    return r.select(F.col(score).alias("threshold"), F.try_divide(fp, F.col("tot_n0")).alias("fpr"),
                    F.try_divide(tp, F.col("tot_n1")).alias("tpr"), tp.alias("tp"), fp.alias("fp"))


def ks_statistic(df: DataFrame, score: str = PROB, label: str = S.TARGET) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic of the scores of both classes: max(TPR - FPR)
    over all thresholds (one aggregate over the ROC points)."""
    roc = roc_points(df, score, label).withColumn("_gap", F.col("tpr") - F.col("fpr"))
    best = roc.agg(F.max("_gap")).scalar()
    # ties: the highest threshold reaching the maximum gap
    return roc.agg(F.greatest(F.max("_gap"), F.lit(0.0)).alias("ks"),
                   F.max(F.when(F.col("_gap") == best, F.col("threshold"))).alias("ks_threshold"))


def pr_points(df: DataFrame, score: str = PROB, label: str = S.TARGET, buckets: int | None = None) -> DataFrame:
    roc = roc_points(df, score, label, buckets)
    return roc.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                      F.col("tpr").alias("recall"))


def classification_report(df: DataFrame, pred: str = "prediction", label: str = S.TARGET) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy, macro and weighted averages."""
    y, p = F.col(label), F.col(pred)
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ["tp", "fp", "fn", "tn"])
    pr1, rc1 = C.safe_ratio(tp, tp + fp), C.safe_ratio(tp, tp + fn)
    pr0, rc0 = C.safe_ratio(tn, tn + fn), C.safe_ratio(tn, tn + fp)
    f1 = lambda a, b: C.safe_ratio(2 * a * b, a + b)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    m = c.select(pr0.alias("p0"), rc0.alias("r0"), f1(pr0, rc0).alias("f0"), s0.alias("s0"),
                 pr1.alias("p1"), rc1.alias("r1"), f1(pr1, rc1).alias("f1"), s1.alias("s1"),
                 C.safe_ratio(tp + tn, n).alias("acc"), n.alias("n"))
    return m.selectExpr(
        "stack(5,"
        " 'No readmission', p0, r0, f0, s0,"
        " 'Readmitted', p1, r1, f1, s1,"
        " 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,"
        " 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n,"
        " 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n)"
        " AS (class, precision, recall, f1_score, support)")


def f1_at(df: DataFrame, pred: str = "prediction", label: str = S.TARGET) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    tp, fp, fn = F.count_if((y == 1) & (p == 1)), F.count_if((y == 0) & (p == 1)), F.count_if((y == 1) & (p == 0))
    return df.agg(C.safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


# ------------------------------------------------------------------ K5 cross-validation

def cross_validate(train: DataFrame, folds: int = 5, c: float = 1.0, label: str = S.TARGET,
                   fits: Sequence[LogisticFit] | None = None) -> DataFrame:
    """Fold AUC and F1 (the preprocessing is refit inside every fold), then mean and population std.

    ``train`` must carry the ``fold`` column of ``stratified_split``. The models of all folds are fitted
    together (``newton.fit_together``), or given as ``fits``; one pass scores every row by the model that has not seen it.
    """
    scored = materialize(newton.fold_scores(train, fits or newton.fit_together(train, folds, c, label), label))
    auc = exact_auc(scored, PROB, label, ["fold"])
    y, p = F.col(label), F.col("prediction")
    tp, fp, fn = F.count_if((y == 1) & (p == 1)), F.count_if((y == 0) & (p == 1)), F.count_if((y == 1) & (p == 0))
    f1 = scored.groupBy("fold").agg(C.safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
    rows = materialize(auc.join(f1, "fold").select(F.col("fold").cast("int").alias("fold"), "auc", "f1"))  # one row a fold
    summary = rows.agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"),
                       F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"))
    stats = ["auc_mean", "auc_std", "f1_mean", "f1_std"]
    return rows.select("*", *[summary.select(name).scalar().alias(name) for name in stats])


# ------------------------------------------------------------------ K10 bootstrap

def poisson1_cdf() -> np.ndarray:
    """Cumulative Poisson(1) probabilities, on until no 53-bit uniform lies above the last one."""
    out, term, k = [math.exp(-1.0)], math.exp(-1.0), 0
    while out[-1] <= 1.0 - 2.0 ** -53 and term > 2.0 ** -56:
        k += 1
        term /= k
        out.append(out[-1] + term)
    return np.array(out)


def replicate_weights(hashes: np.ndarray, n: int, cdf: np.ndarray) -> np.ndarray:
    """(rows × n) Poisson(1) weights drawn from the rows' 64-bit hashes; a row's weights do not depend on its partition."""
    z = hashes.astype(np.uint64)[:, None] + (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(cdf, u, side="right").astype(np.float64)


_SUMS = ("w0", "w1", "u", "tp", "fp", "fn")


def _range_sums(batches, n: int, chunk: int = 4096):
    """For one range of rows sorted by score, sums per replicate: class weights, the U statistic within, tp, fp, fn.

    The range's first and last scores may go on in other ranges, so their weights come as rows of their own (``part`` 0, no
    U yet); all scores strictly between them are one row (``part`` 1, at the first score), with the U of its own pairs.
    """
    cdf = poisson1_cdf()
    inner = {k: np.zeros(n) for k in _SUMS}
    edges: list[tuple[float, dict]] = []  # the first score's sums, and at the end the last one's
    last, group = None, None

    def close(final: bool):
        if not edges or final:
            edges.append((last, group))
            return
        inner["u"] += group["w1"] * (inner["w0"] + 0.5 * group["w0"])
        for k in ("w0", "w1", "tp", "fp", "fn"):
            inner[k] += group[k]

    for batch in batches:
        for at in range(0, batch.num_rows, chunk):
            h, sc, y, p = (c.to_numpy(zero_copy_only=False) for c in batch.slice(at, chunk).columns)
            w = replicate_weights(h, n, cdf)
            masks = {"w0": y == 0, "w1": y == 1, "tp": (y == 1) & (p == 1), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0)}
            starts = np.concatenate(([0], np.flatnonzero(sc[1:] != sc[:-1]) + 1))
            sums = {k: np.add.reduceat(w * m[:, None], starts, axis=0) for k, m in masks.items()}
            for i, score in enumerate(sc[starts].tolist()):
                mine = {k: v[i] for k, v in sums.items()}
                if score == last:
                    group = {k: group[k] + mine[k] for k in mine}
                    continue
                if group is not None:
                    close(False)
                last, group = score, mine
    if group is None:
        return
    close(True)
    rows = [(s, 0, {**g, "u": np.zeros(n)}) for s, g in edges] + [(edges[0][0], 1, inner)]
    for s, part, g in rows:
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, s)), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                                          *[pa.array(g[k]) for k in _SUMS]], names=["s", "part", "rep", *_SUMS])


def bootstrap_ci(df: DataFrame, key: str = S.KEY, score: str = PROB, pred: str = "prediction",
                 label: str = S.TARGET, n: int = 200, seed: int = 42, ranges: int | None = None) -> DataFrame:
    """2.5 / 97.5 % intervals of AUC, F1, precision and recall over ``n`` Poisson-bootstrap replicates.

    Each row gets an independent Poisson(1) weight per replicate from a hash of (key, seed). The rows are
    shuffled once, into ranges of (score, hash), so that rows of one score, however many, are spread over tasks. A
    range draws the weights of all replicates and gives at most three rows of sums per replicate: its first
    score, its last, and what lies between. Sums of a score that several ranges hold are added up before they are paired, so
    ties and the AUC are exact for any ranges. Rows without score or label take no part. Replicates holding
    one class only are skipped.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1)).select(
        F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.col(score).cast("double").alias("s"),
        F.col(label).cast("int").alias("y"), F.coalesce(F.col(pred).cast("int"), F.lit(-1)).alias("p"))
    dealt = (rows.repartitionByRange(ranges, "s", "h") if ranges else rows.repartitionByRange("s", "h")).sortWithinPartitions("s")
    sums = dealt.mapInArrow(lambda it: _range_sums(it, n), "s double, part int, rep int, " + ", ".join(f"{c} double" for c in _SUMS))
    # at most three rows a range and replicate
    whole = materialize(sums.groupBy("rep", "s", "part").agg(*[F.sum(c).alias(c) for c in _SUMS]))
    lower = Window.partitionBy("rep").orderBy("s", "part").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("part") == 0, 0.5 * F.col("w0") * F.col("w1")).otherwise(F.col("u"))
    per = whole.withColumn("below", F.coalesce(F.sum("w0").over(lower), F.lit(0.0))).groupBy("rep").agg(
        F.sum(own + F.col("w1") * F.col("below")).alias("u"), *[F.sum(c).alias(c) for c in ("w0", "w1", "tp", "fp", "fn")])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per = per.where((F.col("w0") > 0) & (F.col("w1") > 0)).select(
        (F.col("u") / (F.col("w0") * F.col("w1"))).alias("auc"), C.safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        C.safe_ratio(tp, tp + fp).alias("precision"), C.safe_ratio(tp, tp + fn).alias("recall"))
    return per.agg(*[F.percentile(c, q).alias(f"{c}_{end}") for c in ("auc", "f1", "precision", "recall") for end, q in (("lo", 0.025), ("hi", 0.975))],
                   F.count(F.lit(1)).alias("replicates"))


# ------------------------------------------------------------------ K11-K12

def feature_importance(model: RiskModel | LogisticFit, k: int = 15) -> DataFrame:
    """Top-k coefficients by magnitude with odds ratios (the model vector is driver-side by nature)."""
    from pyspark.sql import SparkSession
    ss = SparkSession.getActiveSession()
    rows = list(zip(model.feature_names(), model.coefficients))
    df = ss.createDataFrame(rows, "feature string, coefficient double")
    return (df.select("feature", C.rnd("coefficient", 3).alias("coefficient"),
                      C.rnd(C.odds_ratio("coefficient"), 3).alias("odds_ratio"), F.abs("coefficient").alias("_a"))
            .orderBy(F.desc("_a"), "feature").limit(k).drop("_a"))


EXPORT_COLUMNS = ["patient_id", "pathologie", "service", "age", "tranche_age", PROB, "categorie_risque", S.TARGET]


def score_export(scored: DataFrame) -> DataFrame:
    """The 8-column score table: score rounded to 4, right-closed risk tier."""
    return scored.select("patient_id", "pathologie", "service", "age", "tranche_age",
                         C.rnd(PROB, 4).alias(PROB), C.risk_tier_cut(PROB).alias("categorie_risque"), S.TARGET)


def tier_shares(export: DataFrame) -> DataFrame:
    from carestay.operators.explore import class_balance
    return class_balance(export, "categorie_risque", 3)
