"""Registered queries: time intelligence."""

from __future__ import annotations

from carestay.operators import timeintel as TI
from carestay.plans import oracle_sql as O
from carestay.plans.registry import register
from carestay.plans.queries.common import features, round_doubles


MONTHLY_SQL = """monthly AS (
  SELECT CAST(year(date_admission) AS INTEGER) AS year, CAST(month(date_admission) AS INTEGER) AS month,
    count(*) AS sejours, count(*) FILTER (WHERE readmission_30j = 1) AS readmissions,
    CAST(year(date_admission) AS INTEGER) * 12 + CAST(month(date_admission) AS INTEGER) AS month_index
  FROM features GROUP BY 1, 2)"""


def trend_sql(d: str) -> str:
    a = f"printf('%.1f', CAST(ROUND(CAST(abs({d}) AS DECIMAL(38,8)), 1) AS DOUBLE))"
    sgn = f"printf('%+.1f', CAST(ROUND(CAST({d} AS DECIMAL(38,8)), 1) AS DOUBLE))"
    return (f"CASE WHEN {d} IS NULL THEN 'N/A' WHEN {d} > 0.5 THEN 'up +' || {a} || 'pp' "
            f"WHEN {d} < -0.5 THEN 'down ' || {a} || 'pp' ELSE 'stable ' || {sgn} || 'pp' END")


_PY = """py AS (
  SELECT p.year, p.month, p.sejours, p.month_index,
    CASE WHEN p.sejours = 0 THEN 0.0 ELSE CAST(p.readmissions AS DOUBLE) / p.sejours END AS rate,
    CASE WHEN COALESCE(q.sejours, 0) = 0 THEN 0.0 ELSE CAST(q.readmissions AS DOUBLE) / q.sejours END AS prev,
    COALESCE(q.sejours, 0) AS sejours_prev
  FROM monthly p LEFT JOIN monthly q ON p.month_index = q.month_index + 12)"""


@register("prior_year", O.with_ctes(O.BASE + [MONTHLY_SQL, _PY], f"""
SELECT year, month, sejours, {O.R('rate', 6)} AS taux_readmission, {O.R('prev', 6)} AS taux_annee_precedente,
  {O.R('(rate - prev) * 100', 6)} AS delta_pp, {trend_sql('(rate - prev) * 100')} AS tendance,
  sejours_prev AS sejours_annee_precedente
FROM py"""))
def q_prior_year(spark, sf):
    return round_doubles(TI.prior_year(features(spark, sf)))


@register("prior_month", O.with_ctes(O.BASE + [MONTHLY_SQL, """pm AS (
  SELECT p.year, p.month,
    CASE WHEN p.sejours = 0 THEN 0.0 ELSE CAST(p.readmissions AS DOUBLE) / p.sejours END AS rate,
    CASE WHEN COALESCE(q.sejours, 0) = 0 THEN 0.0 ELSE CAST(q.readmissions AS DOUBLE) / q.sejours END AS prev
  FROM monthly p LEFT JOIN monthly q ON p.month_index = q.month_index + 1)"""], f"""
SELECT year, month, {O.R('rate', 6)} AS taux_readmission, {O.R('prev', 6)} AS taux_mois_precedent,
  {O.R('rate - prev', 6)} AS delta_mois FROM pm"""))
def q_prior_month(spark, sf):
    return round_doubles(TI.prior_month(features(spark, sf)))


@register("ytd", O.with_ctes(O.BASE + [MONTHLY_SQL, """y AS (
  SELECT year, month,
    sum(sejours) OVER (PARTITION BY year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs,
    sum(readmissions) OVER (PARTITION BY year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cr
  FROM monthly)"""], f"""
SELECT year, month, CAST(cs AS BIGINT) AS sejours_ytd, CAST(cr AS BIGINT) AS readmissions_ytd,
  {O.R('CASE WHEN cs = 0 THEN 0.0 ELSE CAST(cr AS DOUBLE) / cs END', 6)} AS taux_readmission_ytd FROM y"""))
def q_ytd(spark, sf):
    return round_doubles(TI.ytd_rate(features(spark, sf)))


_CAL = """bounds AS (SELECT min(date_admission) AS lo, max(date_admission) AS hi FROM features),
cal AS (
  SELECT CAST(d AS DATE) AS date FROM bounds,
    unnest(generate_series(make_date(CAST(year(lo) AS INTEGER), 1, 1), make_date(CAST(year(hi) AS INTEGER), 12, 31), INTERVAL 1 DAY)) AS t(d)),
daily AS (SELECT date_admission AS date, count(*) AS sejours, count(*) FILTER (WHERE readmission_30j = 1) AS readmissions
  FROM features GROUP BY 1),
cd AS (SELECT c.date, date_diff('day', DATE '1970-01-01', c.date) AS day_number,
  COALESCE(d.sejours, 0) AS sejours, COALESCE(d.readmissions, 0) AS readmissions
  FROM cal c LEFT JOIN daily d ON c.date = d.date)"""


@register("rolling_30d", O.with_ctes(O.BASE + [_CAL], """
SELECT date,
  CAST(sum(readmissions) OVER (ORDER BY day_number RANGE BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS readmissions_30j,
  CAST(sum(sejours) OVER (ORDER BY day_number RANGE BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS sejours_30j
FROM cd"""))
def q_rolling_30d(spark, sf):
    return TI.rolling_readmissions(features(spark, sf), 30)


@register("rolling_30d_as_of", O.with_ctes(O.BASE, """
SELECT count(*) FILTER (WHERE readmission_30j = 1 AND date_admission BETWEEN (SELECT max(date_admission) FROM features) - 29
  AND (SELECT max(date_admission) FROM features)) AS readmissions_30j FROM features"""))
def q_rolling_as_of(spark, sf):
    return TI.rolling_as_of(features(spark, sf), None, 30)


@register("prior_year_by_service", O.with_ctes(O.BASE + ["""ms AS (
  SELECT service, CAST(year(date_admission) AS INTEGER) AS year, CAST(month(date_admission) AS INTEGER) AS month,
    count(*) AS sejours, count(*) FILTER (WHERE readmission_30j = 1) AS readmissions,
    CAST(year(date_admission) AS INTEGER) * 12 + CAST(month(date_admission) AS INTEGER) AS month_index
  FROM features GROUP BY 1, 2, 3)""", """pys AS (
  SELECT p.service, p.year, p.month, p.sejours,
    CASE WHEN p.sejours = 0 THEN 0.0 ELSE CAST(p.readmissions AS DOUBLE) / p.sejours END AS rate,
    CASE WHEN COALESCE(q.sejours, 0) = 0 THEN 0.0 ELSE CAST(q.readmissions AS DOUBLE) / q.sejours END AS prev,
    COALESCE(q.sejours, 0) AS sejours_prev
  FROM ms p LEFT JOIN ms q ON p.service = q.service AND p.month_index = q.month_index + 12)"""], f"""
SELECT service, year, month, sejours, {O.R('rate', 6)} AS taux_readmission, {O.R('prev', 6)} AS taux_annee_precedente,
  {O.R('(rate - prev) * 100', 6)} AS delta_pp, {trend_sql('(rate - prev) * 100')} AS tendance,
  sejours_prev AS sejours_annee_precedente
FROM pys"""))
def q_prior_year_by_service(spark, sf):
    return round_doubles(TI.prior_year(features(spark, sf), ["service"]))
