"""Registered queries: statistical tests."""

from __future__ import annotations

from carestay import schema as S
from carestay.functions.columns import rnd
from carestay.operators import stats as ST
from carestay.plans import oracle_sql as O
from carestay.plans.registry import ORACLES, register
from carestay.plans.queries.common import features, round_doubles, unpivot_sql


def _normality_sql() -> str:
    lg = unpivot_sql(S.SCREEN_NUMERICAL)
    n = "n"
    y0 = "g1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))"
    beta2 = "3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))"
    return O.with_ctes(O.BASE + [
        f"lg AS (SELECT * FROM {lg} WHERE value IS NOT NULL)",
        "mu AS (SELECT feature, avg(value) AS m, CAST(count(*) AS DOUBLE) AS n FROM lg GROUP BY feature)",
        """mo AS (SELECT l.feature, any_value(mu.n) AS n, avg(power(value - mu.m, 2)) AS m2, avg(power(value - mu.m, 3)) AS m3,
          avg(power(value - mu.m, 4)) AS m4 FROM lg l JOIN mu ON l.feature = mu.feature GROUP BY l.feature)""",
        "mm AS (SELECT feature, n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM mo)",
        f"""s1 AS (SELECT *, CASE WHEN {y0} = 0 THEN 1.0 ELSE {y0} END AS y, sqrt(2.0 * ({beta2} - 1)) - 1 AS w2,
          3.0 * (n - 1) / (n + 1) AS e, 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5)) AS var,
          6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb1 FROM mm)""",
        """s2 AS (SELECT *, 1.0 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2.0 / (w2 - 1)) AS alpha, (b2 - e) / sqrt(var) AS x,
          6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / (sb1 * sb1))) AS a FROM s1)""",
        """s3 AS (SELECT feature, delta * asinh(y / alpha) AS z1,
          ((1 - 2.0 / (9.0 * a)) - sign(1 + x * sqrt(2.0 / (a - 4.0))) * power((1 - 2.0 / a) / abs(1 + x * sqrt(2.0 / (a - 4.0))), 1.0 / 3.0))
            / sqrt(2.0 / (9.0 * a)) AS z2 FROM s2)"""],
        f"""SELECT feature, {O.R('z1 * z1 + z2 * z2', 4)} AS statistic, {O.R('exp(-(z1 * z1 + z2 * z2) / 2)', 6)} AS p_value,
  CASE WHEN exp(-(z1 * z1 + z2 * z2) / 2) > 0.05 THEN 'Yes' ELSE 'No' END AS normal FROM s3""")


@register("normality_test", _normality_sql())
def q_normality(spark, sf):
    return ST.normality_test(features(spark, sf, extra=["sexe"]))


def _chi_sql(select: str | None = None) -> str:
    cols = S.SCREEN_CATEGORICAL
    lg = unpivot_sql(cols, extra="CAST(readmission_30j AS VARCHAR) AS y", cast="VARCHAR").replace("INTO NAME feature VALUE value", "INTO NAME feature VALUE level")
    return O.with_ctes(O.BASE + [
        f"lg AS (SELECT * FROM {lg} WHERE level IS NOT NULL AND y IS NOT NULL)",
        "obs AS (SELECT feature, level, y, count(*) AS o FROM lg GROUP BY ALL)",
        """grid AS (SELECT l.feature, l.level, c.y, COALESCE(obs.o, 0) AS o
          FROM (SELECT DISTINCT feature, level FROM obs) l JOIN (SELECT DISTINCT feature, y FROM obs) c ON l.feature = c.feature
          LEFT JOIN obs ON obs.feature = l.feature AND obs.level = l.level AND obs.y = c.y)""",
        """m AS (SELECT *, sum(o) OVER (PARTITION BY feature, level) AS rw, sum(o) OVER (PARTITION BY feature, y) AS cl,
          sum(o) OVER (PARTITION BY feature) AS n, count(*) OVER (PARTITION BY feature, y) AS r, count(*) OVER (PARTITION BY feature, level) AS c FROM grid)""",
        """e AS (SELECT *, CAST(rw AS DOUBLE) * cl / n AS ex, (r - 1) * (c - 1) AS dof FROM m)""",
        """per AS (SELECT feature, sum(power(abs(o - ex) - CASE WHEN dof = 1 THEN LEAST(0.5, abs(o - ex)) ELSE 0.0 END, 2) / ex) AS chi2,
          any_value(dof) AS dof, any_value(n) AS n, any_value(LEAST(r, c) - 1) AS k FROM e GROUP BY feature)"""],
        select or f"""SELECT feature, {O.R('chi2', 2)} AS chi2, CAST(dof AS INTEGER) AS dof,
  {O.R('CASE WHEN k > 0 THEN sqrt(chi2 / (n * k)) ELSE 0.0 END', 4)} AS cramers_v FROM per""")


@register("chi_square_stat", _chi_sql())
def q_chi_square_stat(spark, sf):
    return ST.chi_square_stat(features(spark, sf, extra=["sexe"])).drop("_chi2_raw")


def _mw_sql(select: str | None = None) -> str:
    lg = unpivot_sql(S.SCREEN_NUMERICAL, extra="readmission_30j AS y")
    return O.with_ctes(O.BASE + [
        f"vc AS (SELECT feature, value, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1 FROM {lg} WHERE value IS NOT NULL GROUP BY ALL)",
        """cw AS (SELECT *, COALESCE(sum(n1) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below1 FROM vc)""",
        """per AS (SELECT feature, sum(n0 * (below1 + 0.5 * n1)) AS u, CAST(sum(n0) AS DOUBLE) AS n0, CAST(sum(n1) AS DOUBLE) AS n1,
          sum(CAST(n0 + n1 AS DOUBLE) * (n0 + n1) * (n0 + n1) - (n0 + n1)) AS ties,
          sum(value * n0) / sum(n0) AS mean0, sum(value * n1) / sum(n1) AS mean1 FROM cw GROUP BY feature)"""],
        select or f"""SELECT feature, {O.R('u', 2)} AS u_statistic,
  {O.R('(GREATEST(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1))))', 6)} AS z,
  {O.R('u / (n0 * n1)', 6)} AS effect_r, {O.R('mean0', 6)} AS mean0, {O.R('mean1', 6)} AS mean1,
  CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1 FROM per""")


@register("mann_whitney_u", _mw_sql())
def q_mann_whitney_u(spark, sf):
    m = ST.mann_whitney_u(features(spark, sf))
    return round_doubles(m.withColumn("u_statistic", rnd("u_statistic", 2)))


_KRUSKAL = O.BASE + [
    "vg AS (SELECT CAST(age AS DOUBLE) AS v, pathologie AS g, count(*) AS n FROM features WHERE age IS NOT NULL AND pathologie IS NOT NULL GROUP BY ALL)",
    "vv AS (SELECT v, sum(n) AS t FROM vg GROUP BY v)",
    "rk AS (SELECT v, t, sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t + (t + 1) / 2.0 AS rank FROM vv)",
    "per AS (SELECT g, sum(n * rank) AS r, sum(n) AS nj FROM vg JOIN rk USING (v) GROUP BY g)",
    "tot AS (SELECT sum(r * r / nj) AS s, CAST(sum(nj) AS DOUBLE) AS nn, count(*) AS k FROM per)",
    "tie AS (SELECT sum(power(CAST(t AS DOUBLE), 3) - t) AS tie FROM vv)"]


@register("kruskal_h", O.with_ctes(_KRUSKAL, f"""
SELECT {O.R('(12.0 / (nn * (nn + 1)) * s - 3 * (nn + 1)) / (1 - tie / (nn * nn * nn - nn))', 6)} AS h,
  CAST(k - 1 AS INTEGER) AS dof, CAST(nn AS BIGINT) AS n FROM tot, tie"""))
def q_kruskal_h(spark, sf):
    return round_doubles(ST.kruskal_h(features(spark, sf)))


def _tail(a: str, x: str) -> str:
    """Upper tail of the gamma distribution Q(a, x) by the series of its complement, whose terms are all positive."""
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 1.0 WHEN {x} > 700 THEN 0.0 ELSE 1 - (SELECT sum(exp(-({x}) + (({a}) + t.i) * ln({x}) "
            f"- lgamma(({a}) + t.i + 1))) FROM range(0, 2000) t(i)) END)")


_CHI_P = _tail("dof / 2.0", "chi2 / 2.0")


@register("chi_square", _chi_sql(f"""SELECT feature, {O.R('chi2', 2)} AS chi2, {O.R(_CHI_P, 8)} AS p_value, CAST(dof AS INTEGER) AS dof,
  {O.R('CASE WHEN k > 0 THEN sqrt(chi2 / (n * k)) ELSE 0.0 END', 4)} AS cramers_v,
  CASE WHEN {_CHI_P} < 0.001 THEN 'Yes' ELSE 'No' END AS significant FROM per"""))
def q_chi_square(spark, sf):
    out = ST.chi_square(features(spark, sf, extra=["sexe"]))
    return out.withColumn("p_value", rnd("p_value", 8))


_MW_Z = "(GREATEST(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1))))"
_MW_P = _tail("0.5", "z * z / 2.0")


@register("mann_whitney", _mw_sql(f"""SELECT feature, CAST(round_even(u, 0) AS DOUBLE) AS "U_statistic", {O.R(_MW_P, 8)} AS p_value,
  {O.R('u / (n0 * n1)', 4)} AS effect_r, {O.R('mean0', 3)} AS mean_readmit0, {O.R('mean1', 3)} AS mean_readmit1,
  CASE WHEN {_MW_P} < 0.001 THEN 'Yes' ELSE 'No' END AS significant FROM (SELECT *, {_MW_Z} AS z FROM per)"""))
def q_mann_whitney(spark, sf):
    return ST.mann_whitney(features(spark, sf))


@register("kruskal_wallis", O.with_ctes(_KRUSKAL + ["kw AS (SELECT (12.0 / (nn * (nn + 1)) * s - 3 * (nn + 1)) / (1 - tie / (nn * nn * nn - nn)) AS h, "
                                                    "k - 1 AS dof FROM tot, tie)"], f"""
SELECT {O.R('h', 6)} AS h, CAST(dof AS INTEGER) AS dof, {O.R(_tail('dof / 2.0', 'h / 2.0'), 6)} AS p_value FROM kw"""))
def q_kruskal_wallis(spark, sf):
    return round_doubles(ST.kruskal_wallis(features(spark, sf)))


def _vif_sql() -> str:
    """Diagonal of the inverse correlation matrix: Gauss-Jordan elimination, one step a CTE, one column an entry."""
    cols = S.SCREEN_NUMERICAL
    k = len(cols)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    entry = lambda i, j: "1.0" if i == j else f"corr(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE))"
    steps = [f"e0 AS (SELECT {', '.join(f'{entry(i, j)} AS r{i}_{j}' for i in range(k) for j in range(k))} FROM features WHERE {complete})"]
    for p in range(k):
        def swept(i, j):
            if i == p:
                return f"1 / r{p}_{p}" if j == p else f"r{p}_{j} / r{p}_{p}"
            return f"-r{i}_{p} / r{p}_{p}" if j == p else f"r{i}_{j} - r{i}_{p} * r{p}_{j} / r{p}_{p}"
        steps.append(f"e{p + 1} AS (SELECT {', '.join(f'{swept(i, j)} AS r{i}_{j}' for i in range(k) for j in range(k))} FROM e{p})")
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, {O.R(f'r{i}_{i}', 2)} AS vif FROM e{k}" for i, c in enumerate(cols))
    return O.with_ctes(O.BASE + steps, rows)


@register("vif", _vif_sql())
def q_vif(spark, sf):
    return ST.vif(features(spark, sf))


def _screen_sql() -> str:
    part = lambda test, name, stat, p, feature="feature": (
        f"SELECT '{test}' AS test, {feature} AS feature, {O.R(stat, 6)} AS statistic, {O.R(p, 6)} AS p_value FROM ({ORACLES[name]})")
    return " UNION ALL ".join([part("normality", "normality_test", "statistic", "p_value"), part("chi_square", "chi_square", "chi2", "p_value"),
                               part("mann_whitney", "mann_whitney", '"U_statistic"', "p_value"),
                               part("kruskal_wallis", "kruskal_wallis", "h", "p_value", "'age~pathologie'"),
                               part("vif", "vif", "vif", "NULL")])


@register("feature_screen", _screen_sql())
def q_feature_screen(spark, sf):
    # p-values as in the queries of the single tests
    out = ST.feature_screen(features(spark, sf, extra=["sexe"]))
    return out.withColumns({"statistic": rnd("statistic", 6), "p_value": rnd("p_value", 6)})
