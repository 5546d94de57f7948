"""Registered queries: exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from carestay import schema as S
from carestay.functions.columns import rnd
from carestay.operators import explore as X
from carestay.plans import oracle_sql as O
from carestay.plans.registry import register
from carestay.plans.queries.common import features, raw, round_doubles, unpivot_sql


@register("describe", O.with_ctes(O.BASE, f"""
SELECT feature, count(value) AS count, {O.R('avg(value)', 2)} AS mean, {O.R('stddev_samp(value)', 2)} AS std,
  {O.R('min(value)', 2)} AS min, {O.R('quantile_cont(value, 0.25)', 2)} AS p25, {O.R('quantile_cont(value, 0.5)', 2)} AS p50,
  {O.R('quantile_cont(value, 0.75)', 2)} AS p75, {O.R('max(value)', 2)} AS max
FROM {unpivot_sql(S.DESCRIBE_COLS)} GROUP BY feature"""))
def q_describe(spark, sf):
    return X.describe_numeric(features(spark, sf))


@register("class_balance", O.with_ctes(O.BASE, f"""
SELECT readmission_30j, count(*) AS n, {O.R('count(*) / sum(count(*)) OVER ()', 3)} AS share FROM features WHERE readmission_30j IS NOT NULL GROUP BY 1"""))
def q_class_balance(spark, sf):
    return X.class_balance(features(spark, sf))


def _missing_sql():
    from carestay.schema import BRONZE_COLUMNS
    parts = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM stays_raw"
                               for c in BRONZE_COLUMNS)
    return f"SELECT * FROM ({parts}) WHERE missing > 0"


@register("missing_counts", O.with_ctes([], _missing_sql()))
def q_missing_counts(spark, sf):
    return X.missing_counts(raw(spark, sf))


_RATE_DIMS = ["tranche_age", "service", "mode_sortie", "groupe_clinique"]


@register("group_rates", O.with_ctes(O.BASE, " UNION ALL ".join(f"""
SELECT '{d}' AS dimension, {d} AS level, count(*) AS n, {O.R('avg(CAST(readmission_30j AS DOUBLE))', 6)} AS rate,
  {O.R('(SELECT avg(CAST(readmission_30j AS DOUBLE)) FROM features)', 6)} AS global_rate FROM features GROUP BY {d}""" for d in _RATE_DIMS)))
def q_group_rates(spark, sf):
    return round_doubles(X.group_rates(features(spark, sf), _RATE_DIMS))


def _hist_sql(col: str, bins: int = 30) -> str:
    return O.with_ctes(O.BASE + [f"""rng AS (SELECT readmission_30j AS y, min({col}) AS lo, max({col}) AS hi FROM features GROUP BY 1),
hb AS (SELECT f.readmission_30j, r.lo, r.hi,
  CAST(CASE WHEN r.hi > r.lo THEN LEAST(floor((f.{col} - r.lo) * {float(bins)} / (r.hi - r.lo)), {bins - 1}) ELSE 0 END AS INTEGER) AS bin
  FROM features f JOIN rng r ON f.readmission_30j = r.y WHERE f.{col} IS NOT NULL)"""], f"""
SELECT readmission_30j, bin, count(*) AS n, {O.R(f'any_value(lo) + bin * (any_value(hi) - any_value(lo)) / {float(bins)}', 6)} AS bin_lo,
  {O.R(f'any_value(lo) + (bin + 1) * (any_value(hi) - any_value(lo)) / {float(bins)}', 6)} AS bin_hi
FROM hb GROUP BY readmission_30j, bin""")


for _hc in ["age", "nb_hospitalisations_precedentes", "nb_medicaments", "duree_sejour", "indice_complexite", "ratio_meds_duree"]:
    def _mkh(col):
        def q(spark, sf):
            h = X.histogram_by_class(features(spark, sf), col)
            return round_doubles(h)
        return q
    register(f"histogram_{_hc}", _hist_sql(_hc))(_mkh(_hc))


def _corr_sql():
    cols = S.CORRELATION_COLS
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {O.R(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 4)} AS corr FROM features"
        for a, b in pairs)


@register("correlation", O.with_ctes(O.BASE, _corr_sql()))
def q_correlation(spark, sf):
    return X.correlation_matrix(features(spark, sf))


@register("dataset_summary", O.with_ctes(O.BASE, f"""
SELECT count(*) AS n_stays, {O.R('avg(CAST(readmission_30j AS DOUBLE))', 3)} AS readmission_rate,
  {O.R('avg(age)', 1)} AS mean_age, {O.R('avg(duree_sejour)', 1)} AS mean_los, {O.R('avg(nb_medicaments)', 1)} AS mean_medications,
  {O.R('avg(nb_hospitalisations_precedentes)', 2)} AS mean_prior_hosp FROM features"""))
def q_dataset_summary(spark, sf):
    return X.dataset_summary(features(spark, sf))


@register("crosstab", O.with_ctes(O.BASE, """
SELECT mode_sortie, readmission_30j, count(*) AS n FROM features
WHERE mode_sortie IS NOT NULL AND readmission_30j IS NOT NULL GROUP BY 1, 2"""))
def q_crosstab(spark, sf):
    return X.crosstab(features(spark, sf), "mode_sortie", "readmission_30j")
