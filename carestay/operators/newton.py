"""Weighted logistic regressions of all folds and of the whole training set, fitted together by Newton steps.

The objective is that of ``model.fit_logistic``: balanced class weights n / (2 n_c), L2 penalty with inverse
strength C, no penalty on the intercept, numbers scaled by the population standard deviation, one-hot
levels, and all of this refit for each fold. A step is one pass over the rows: every task adds up gradient and
Hessian blocks of all models, Spark sums the tasks' rows, and models x k x k numbers reach the driver.

A pass works in one common design (numbers scaled by the moments of all rows, every level a column).
A fold's own scaling is an affine map of it, so its gradient and Hessian follow from the common sums, and a
level that a fold's rows lack has an all-zero column and a zero coefficient.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestay import schema as S

PROB = "score_risque_modele"


@dataclass
class LogisticFit:
    """One fitted model: raw scaling, intercept, coefficients of the scaled features, levels seen, rows used."""

    means: dict[str, float]
    stds: dict[str, float]
    binary: list[str]
    levels: dict[str, list[str]]
    intercept: float = 0.0
    coefficients: list[float] = field(default_factory=list)
    n: int = 0
    n1: int = 0
    inverse_strength: float = 1.0
    steps: int = 0

    def feature_names(self) -> list[str]:
        return [*self.means, *self.binary, *[f"{c}_{x}" for c, levels in self.levels.items() for x in levels]]

    def class_weights(self) -> tuple[float, float]:
        n0 = self.n - self.n1
        return (self.n / (2.0 * n0) if n0 else 0.0, self.n / (2.0 * self.n1) if self.n1 else 0.0)

    def features(self) -> list[Column]:
        """The design of this model, one column a feature; a null or unseen level is all zeros."""
        out = [(F.col(c).cast("double") - F.lit(m)) / F.lit(_scale(self.stds[c])) for c, m in self.means.items()]
        out += [F.col(c).cast("double") for c in self.binary]
        return out + [F.coalesce((F.col(c) == F.lit(x)).cast("double"), F.lit(0.0)) for c, levels in self.levels.items() for x in levels]

    def probability(self) -> Column:
        beta = dict(zip(self.feature_names(), self.coefficients))
        eta = F.lit(self.intercept)
        for c, m in self.means.items():
            eta = eta + F.lit(beta[c] / _scale(self.stds[c])) * (F.col(c).cast("double") - F.lit(m))
        for c in self.binary:
            eta = eta + F.lit(beta[c]) * F.col(c).cast("double")
        for c, levels in self.levels.items():
            if levels:
                table = F.create_map(*[F.lit(v) for x in levels for v in (x, beta[f"{c}_{x}"])])
                eta = eta + F.coalesce(F.try_element_at(table, F.col(c)), F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-eta))


def _scale(std: float) -> float:
    return std if std and std > 0 else 1.0


def _moments(rows: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """Counts, means, variances and levels of each fold: one aggregate, one row a fold."""
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n1")]
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"), F.count_if(x.isNull() | F.isnan(x)).alias(f"z{i}")]
    aggs += [F.collect_set(F.col(c).cast("string")).alias(f"l{i}") for i, c in enumerate(categorical)]
    got = rows.groupBy("_fold").agg(*aggs).collect()
    bad = [c for i, c in enumerate(numeric) if any(r[f"z{i}"] for r in got)]
    if bad:
        raise ValueError(f"rows without a number in {', '.join(bad)} cannot be fitted")
    return got


def _merged(parts: list, i: int) -> tuple[float, float]:
    """(mean, population standard deviation) of number ``i`` over the given folds."""
    n = sum(r["n"] for r in parts)
    mean = sum(r["n"] * r[f"m{i}"] for r in parts) / n
    return mean, float(np.sqrt(sum(r["n"] * (r[f"v{i}"] + (r[f"m{i}"] - mean) ** 2) for r in parts) / n))


def fit_together(train: DataFrame, folds: int = 5, c: float = 1.0, label: str = S.TARGET, numeric: Sequence[str] = S.NUMERICAL_FEATURES,
                 binary: Sequence[str] = S.BINARY_FEATURES, categorical: Sequence[str] = S.CATEGORICAL_FEATURES,
                 max_steps: int = 50, tol: float = 1e-9) -> list[LogisticFit]:
    """[fit of all rows, fit without fold 0, ..., fit without fold ``folds - 1``].

    ``train`` is read once a step and should be a stored table; it has a ``fold`` column if ``folds`` is not 0.
    A step that does not lower the objective is halved. Ends when the largest gradient entry is below ``tol`` a row.
    """
    names = [*numeric, *binary, *categorical]
    rows = train.where(F.col(label).isin(0, 1)).select(
        (F.coalesce(F.col("fold"), F.lit(-1)) if folds else F.lit(-1)).cast("int").alias("_fold"), F.col(label).cast("int").alias(label),
        *[F.col(x).cast("double").alias(x) for x in numeric], *[F.col(x).cast("double").alias(x) for x in binary],
        *[F.col(x).cast("string").alias(x) for x in categorical])
    parts = _moments(rows, label, numeric, categorical)
    if not parts:
        raise ValueError("no labelled rows to fit")

    def described(used: list) -> LogisticFit:
        moments = [_merged(used, i) for i in range(len(numeric))] if used else [(0.0, 1.0)] * len(numeric)
        return LogisticFit({x: m for x, (m, _) in zip(numeric, moments)}, {x: s for x, (_, s) in zip(numeric, moments)}, list(binary),
                           {x: sorted(set().union(*[r[f"l{i}"] for r in used])) for i, x in enumerate(categorical)},
                           n=sum(r["n"] for r in used), n1=sum(r["n1"] for r in used), inverse_strength=c)

    fits = [described(parts), *[described([r for r in parts if r["_fold"] != k]) for k in range(folds)]]
    common = fits[0]
    k = 1 + len(common.feature_names())
    maps = [_affine(f, common, k) for f in fits]
    weights = np.array([f.class_weights() for f in fits])
    shift = np.array(list(common.means.values()))
    scale = np.array([_scale(s) for s in common.stds.values()])
    levels = [common.levels[x] for x in categorical]

    def blocks(gammas: np.ndarray):
        """A task's sums: one row a model and number, loss first, then gradient, then the Hessian's upper triangle."""
        upper = np.triu_indices(k)

        def run(batches: Iterator[pa.RecordBatch]):
            total = np.zeros((len(fits), 1 + k + len(upper[0])))
            for batch in batches:
                for at in range(0, batch.num_rows, 8192):
                    cols = dict(zip(["_fold", label, *names], batch.slice(at, 8192).columns))
                    z = _design(cols, numeric, binary, categorical, levels, shift, scale, k)
                    fold, y = cols["_fold"].to_numpy(), cols[label].to_numpy().astype(float)
                    eta = z @ gammas
                    p = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
                    for m in range(len(fits)):
                        w = np.where(y == 1, weights[m, 1], weights[m, 0]) * (fold != m - 1 if m else 1.0)
                        total[m, 0] += (w * (np.logaddexp(0.0, eta[:, m]) - y * eta[:, m])).sum()
                        total[m, 1:1 + k] += z.T @ (w * (p[:, m] - y))
                        total[m, 1 + k:] += ((z * (w * p[:, m] * (1 - p[:, m]))[:, None]).T @ z)[upper]
            each = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(fits), dtype=np.int32), each)), pa.array(np.tile(np.arange(each, dtype=np.int32), len(fits))),
                 pa.array(total.ravel())], names=["model", "i", "v"])

        sums = np.zeros((len(fits), 1 + k + len(upper[0])))
        out = rows.mapInArrow(run, "model int, i int, v double").groupBy("model", "i").agg(F.sum("v").alias("v")).toArrow()
        sums[out["model"].to_numpy(), out["i"].to_numpy()] = out["v"].to_numpy()
        hessians = np.zeros((len(fits), k, k))
        hessians[:, upper[0], upper[1]] = sums[:, 1 + k:]
        hessians[:, upper[1], upper[0]] = sums[:, 1 + k:]
        return sums[:, 0], sums[:, 1:1 + k], hessians

    ridge = np.full(k, 1.0 / c)
    ridge[0] = 0.0
    betas = np.zeros((len(fits), k))
    trial, best = betas.copy(), np.full(len(fits), np.inf)
    move = np.zeros_like(betas)
    done = np.zeros(len(fits), bool)
    for step in range(max_steps):
        loss, grad, hess = blocks(np.stack([a.T @ b for a, b in zip(maps, trial)], axis=1))
        for m, a in enumerate(maps):
            if done[m]:
                continue
            value = loss[m] + 0.5 * (ridge * trial[m] ** 2).sum()
            if value > best[m] * (1 + 1e-12) + 1e-12:
                move[m] *= 0.5  # too far: back half way
            else:
                betas[m], best[m] = trial[m], value
                g = a @ grad[m] + ridge * betas[m]
                fits[m].steps = step
                if np.abs(g).max() <= tol * max(fits[m].n, 1):
                    done[m] = True
                    continue
                # levels that a fold lacks have a zero row and column: the ridge keeps the system regular
                move[m] = np.linalg.lstsq(a @ hess[m] @ a.T + np.diag(ridge), -g, rcond=None)[0]
            trial[m] = betas[m] + move[m]
        if done.all():
            break
    else:
        raise RuntimeError(f"{int((~done).sum())} of {len(fits)} fits did not settle in {max_steps} steps")
    for f, beta in zip(fits, betas):
        by = dict(zip(common.feature_names(), beta[1:]))
        f.intercept, f.coefficients = float(beta[0]), [float(by[x]) for x in f.feature_names()]
    return fits


def _affine(f: LogisticFit, common: LogisticFit, k: int) -> np.ndarray:
    """The matrix that takes a row of the common design (1 first) to the fit's own; a level it lacks goes to zero."""
    a = np.eye(k)
    for j, x in enumerate(common.means, start=1):
        a[j, j] = _scale(common.stds[x]) / _scale(f.stds[x])
        a[j, 0] = (common.means[x] - f.means[x]) / _scale(f.stds[x])
    own = set(f.feature_names())
    for j, x in enumerate(common.feature_names(), start=1):
        if x not in own:
            a[j, j] = 0.0
    return a


def _design(cols: dict, numeric, binary, categorical, levels, shift, scale, k: int) -> np.ndarray:
    n = len(cols["_fold"])
    z = np.zeros((n, k))
    z[:, 0] = 1.0
    at = 1
    for j, x in enumerate(numeric):
        z[:, at] = (cols[x].to_numpy(zero_copy_only=False) - shift[j]) / scale[j]
        at += 1
    for x in binary:
        z[:, at] = cols[x].fill_null(0.0).to_numpy(zero_copy_only=False)
        at += 1
    for x, known in zip(categorical, levels):
        if known:
            code = pa.compute.index_in(cols[x], pa.array(known, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
            there = np.flatnonzero(code >= 0)
            z[there, at + code[there]] = 1.0
        at += len(known)
    return z


def fold_scores(train: DataFrame, fits: Sequence[LogisticFit], label: str = S.TARGET, threshold: float = 0.5) -> DataFrame:
    """(fold, label, score, prediction): every row scored by the fit that has not seen its fold."""
    p = None
    for fold, f in enumerate(fits[1:]):
        mine = F.col("fold") == fold
        p = F.when(mine, f.probability()) if p is None else p.when(mine, f.probability())
    return train.where(F.col("fold").isNotNull()).select("fold", label, p.alias(PROB)).withColumn("prediction", (F.col(PROB) > threshold).cast("int"))


def stationarity(rows: DataFrame, f: LogisticFit, label: str = S.TARGET) -> DataFrame:
    """(feature, n, n1, gradient): the mean objective's gradient at the fit over the rows it was fitted on, in one aggregate.

    Computed from the scored rows by Column functions, apart from the passes that made the fit. Zero at a right fit.
    """
    w0, w1 = f.class_weights()
    y = F.col(label).cast("double")
    pull = F.when(y == 1, F.lit(w1)).otherwise(F.lit(w0)) * (f.probability() - y)
    names = ["(intercept)", *f.feature_names()]
    design = [F.lit(1.0), *f.features()]
    penalty = [0.0, *[b / f.inverse_strength for b in f.coefficients]]
    used = rows.where(F.col(label).isin(0, 1)).withColumn("_pull", pull)
    sums = used.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n1"), *[F.sum(F.col("_pull") * x).alias(f"g{i}") for i, x in enumerate(design)])
    entries = [F.struct(F.lit(x).alias("feature"), ((F.col(f"g{i}") + F.lit(b)) / F.col("n")).alias("gradient"))
               for i, (x, b) in enumerate(zip(names, penalty))]
    return sums.select("n", "n1", F.explode(F.array(*entries)).alias("e")).select("e.feature", "n", "n1", "e.gradient")
