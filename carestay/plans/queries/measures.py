"""Registered queries: BI measures, dashboards, labels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from carestay.functions.columns import rnd
from carestay.operators import dashboards as DB
from carestay.operators import measure_registry as R
from carestay.operators import measures as M
from carestay.plans import oracle_sql as O
from carestay.plans.layers import bucketed, features_by_stay, silver_by_stay
from carestay.plans.registry import register
from carestay.sources.reference import LABELS_FR_EN, label_dictionary
from carestay.plans.queries.common import features, measure_base, round_doubles
from carestay.plans.queries.timeintel import trend_sql


_MEASURE_QUERIES = {
    "measures_global": (None, "global"),
    "measures_by_pathology": ("pathologie", "global"),
    "measures_risk": ("service", "risk"),
    "measures_demographics": ("hopital_region", "demographics"),
    "measures_alerts": ("service", "alerts"),
    "measures_confusion": (None, "confusion"),
    "measures_confusion_by_group": ("groupe_clinique", "confusion"),
}

for _qname, (_grp, _set) in _MEASURE_QUERIES.items():
    def _mkm(grp, names):
        def q(spark, sf):
            return round_doubles(M.measures(measure_base(spark, sf), [grp] if grp else [], names))
        return q
    register(_qname, O.measures_sql(_grp, M.MEASURE_GROUPS[_set]))(_mkm(_grp, M.MEASURE_GROUPS[_set]))


@register("scorecard", O.with_ctes(O.BASE + [O.MB], """
SELECT patient_id, score_risque_modele FROM mb"""))
def q_scorecard(spark, sf):
    return measure_base(spark, sf).select("patient_id", "score_risque_modele")


_ATTACHED = [n for n in M.MEASURE_GROUPS["risk"] if n.startswith(("score", "patients"))] + M.MEASURE_GROUPS["confusion"]


@register("measures_attached_scores", O.measures_sql("service", _ATTACHED))
def q_measures_attached_scores(spark, sf):
    """The measures on a score table attached by stay key, as an exported score file is."""
    # all three tables are stored by stay key: they join as they lie
    scores = bucketed(spark, sf, "scores", lambda: measure_base(spark, sf).select("patient_id", "score_risque_modele"))
    base = M.stay_measures_base(features_by_stay(spark, sf), scores, silver_by_stay(spark, sf))
    return round_doubles(M.measures(base, ["service"], _ATTACHED))


_TIERS_LEFT = """CASE WHEN {s} >= 0.70 THEN 'Eleve' WHEN {s} >= 0.40 THEN 'Modere' WHEN {s} >= 0.20 THEN 'Faible' ELSE 'Tres faible' END"""
_TIERS_RIGHT = """CASE WHEN {s} > 0 AND {s} <= 0.20 THEN 'Tres faible' WHEN {s} > 0.20 AND {s} <= 0.40 THEN 'Faible'
  WHEN {s} > 0.40 AND {s} <= 0.70 THEN 'Modere' WHEN {s} > 0.70 AND {s} <= 1.0 THEN 'Eleve' END"""


@register("risk_tiers_left", O.with_ctes(O.BASE + [O.MB], f"""
SELECT {_TIERS_LEFT.format(s='score_risque_modele')} AS categorie_risque, count(*) AS nb_sejours
FROM mb GROUP BY 1"""))
def q_risk_tiers_left(spark, sf):
    from carestay.functions.columns import classify_risk
    return (measure_base(spark, sf).groupBy(classify_risk("score_risque_modele").alias("categorie_risque"))
            .agg(F.count(F.lit(1)).alias("nb_sejours")))


@register("risk_tiers_right", O.with_ctes(O.BASE + [O.MB], f"""
SELECT {_TIERS_RIGHT.format(s='score_risque_modele')} AS categorie_risque, count(*) AS nb_sejours,
  {O.R('count(*) / sum(count(*)) OVER ()', 6)} AS part
FROM mb GROUP BY 1"""))
def q_risk_tiers_right(spark, sf):
    from pyspark.sql import Window
    from carestay.functions.columns import risk_tier_cut
    t = (measure_base(spark, sf).groupBy(risk_tier_cut("score_risque_modele").alias("categorie_risque"))
         .agg(F.count(F.lit(1)).alias("nb_sejours")))
    # a window over the 4 tier rows (plus the null tier), not over stays
    return t.withColumn("part", rnd(F.col("nb_sejours") / F.sum("nb_sejours").over(Window.partitionBy()), 6))


@register("pathology_rank", O.with_ctes(O.BASE + [O.MB, """
per AS (SELECT pathologie, count(*) AS n, count(*) FILTER (WHERE readmission_30j = 1) AS n_readm,
  avg(indice_complexite) AS icm FROM mb GROUP BY pathologie),
pr AS (SELECT pathologie, n, CAST(n_readm AS DOUBLE) / n AS rate,
  (CAST(n_readm AS DOUBLE) / n - CAST(sum(n_readm) OVER () AS DOUBLE) / sum(n) OVER ()) * 100 AS dev, icm FROM per)"""], f"""
SELECT pathologie, n AS total_sejours, {O.R('rate', 6)} AS taux_readmission_pathologie,
  {O.R('dev', 6)} AS ecart_vs_moyenne_globale_pp, {O.R('icm', 6)} AS indice_complexite_moy,
  CAST(dense_rank() OVER (ORDER BY rate DESC) AS INTEGER) AS rang_pathologie
FROM pr"""))
def q_pathology_rank(spark, sf):
    return round_doubles(M.pathology_ranking(measure_base(spark, sf)))


@register("top_pathology", O.with_ctes(O.BASE + [O.MB, """
per AS (SELECT pathologie, CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) AS rate
  FROM mb GROUP BY pathologie)"""], f"""
SELECT pathologie, {O.R('rate', 6)} AS taux_readmission_pathologie FROM per WHERE rate = (SELECT max(rate) FROM per)"""))
def q_top_pathology(spark, sf):
    return round_doubles(M.top_pathology(measure_base(spark, sf)))


@register("services_above_threshold", O.with_ctes(O.BASE + [O.MB, """
per AS (SELECT service, CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) AS rate
  FROM mb GROUP BY service)"""], """
SELECT count(*) FILTER (WHERE rate >= 0.20) AS services_au_dessus_seuil FROM per"""))
def q_services_above(spark, sf):
    return M.services_above_threshold(measure_base(spark, sf))


@register("ks_approx", O.with_ctes(O.BASE + [O.MB, """
q AS (SELECT quantile_cont(score_risque_modele, 0.9) FILTER (WHERE readmission_30j = 1) AS p90,
  quantile_cont(score_risque_modele, 0.1) FILTER (WHERE readmission_30j = 0) AS p10 FROM mb)"""], f"""
SELECT {O.R('p90', 6)} AS p90, {O.R('p10', 6)} AS p10, {O.R('p90 - p10', 6)} AS ks_approx,
  printf('%.3f', ROUND(CAST(p90 - p10 AS DECIMAL(38,8)), 3)) AS ks_approx_label FROM q"""))
def q_ks_approx(spark, sf):
    return round_doubles(M.ks_approx(measure_base(spark, sf)))


@register("percentiles_by_pathology", O.with_ctes(O.BASE, f"""
SELECT pathologie, {O.R('quantile_cont(indice_complexite, 0.25)', 6)} AS p25,
  {O.R('quantile_cont(indice_complexite, 0.5)', 6)} AS p50, {O.R('quantile_cont(indice_complexite, 0.9)', 6)} AS p90
FROM features GROUP BY pathologie"""))
def q_percentiles_by_pathology(spark, sf):
    return round_doubles(M.exact_percentiles(features(spark, sf), "indice_complexite", [0.25, 0.5, 0.9], ["pathologie"]))


for _dname in DB.DASHBOARDS:
    def _mkd(name):
        def q(spark, sf):
            return round_doubles(DB.dashboard(measure_base(spark, sf), name))
        return q
    register(f"dashboard_{_dname}", O.dashboard_sql(_dname))(_mkd(_dname))


def _labels_values_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in LABELS_FR_EN)
    return f"labels(label_fr, label_en) AS (VALUES {rows})"


@register("labels_en_by_pathology", O.with_ctes(O.BASE + [_labels_values_sql()], """
SELECT f.pathologie, COALESCE(l.label_en, f.pathologie) AS pathologie_en, count(*) AS total_sejours
FROM features f LEFT JOIN labels l ON f.pathologie = l.label_fr GROUP BY 1, 2"""))
def q_labels_en(spark, sf):
    per = features(spark, sf).groupBy("pathologie").agg(F.count(F.lit(1)).alias("total_sejours"))
    return DB.translate_labels(per, label_dictionary(spark), "pathologie").select("pathologie", "pathologie_en", "total_sejours")


@register("pathology_rate_allexcept", O.with_ctes(O.BASE, f"""
SELECT s.pathologie, s.n AS total_sejours, {O.R('s.rate', 6)} AS taux_readmission, {O.R('a.rate', 6)} AS taux_readmission_sans_filtre
FROM (SELECT pathologie, count(*) AS n, CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) AS rate
      FROM features WHERE service = 'Cardiologie' GROUP BY 1) s
LEFT JOIN (SELECT pathologie, CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) AS rate
      FROM features GROUP BY 1) a ON s.pathologie = a.pathologie"""))
def q_rate_allexcept(spark, sf):
    f = features(spark, sf)
    return round_doubles(DB.rate_ignoring_filters(f.where(F.col("service") == "Cardiologie"), f))


@register("top_services_by_rate", O.with_ctes(O.BASE, f"""
SELECT service, {O.R('CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*)', 6)} AS taux_readmission
FROM features GROUP BY service ORDER BY taux_readmission DESC, service LIMIT 3"""))
def q_top_services(spark, sf):
    per = features(spark, sf).groupBy("service").agg(rnd(DB._rate(), 6).alias("taux_readmission"))
    return per.orderBy(F.desc("taux_readmission"), "service").limit(3)

_MULTI_SETS = [[], ["service"], ["pathologie"]]
_MULTI_NAMES = ["total_sejours", "taux_readmission", "score_risque_moyen", "patients_risque_eleve", "precision_modele",
                "statut_performance"]


def _multi_sql() -> str:
    ex = O.measure_exprs()
    cols = ", ".join((O.R(ex[n][0], 6) if ex[n][1] else ex[n][0]) + f" AS {n}" for n in _MULTI_NAMES)
    ctes, sel = [O.MB], []
    for s in _MULTI_SETS:
        label = "+".join(s) if s else "all"
        ctes.append(O.base_counts_sql(s[0] if s else None).replace("b AS (", f"b_{label} AS (", 1))
        key = lambda c: c if c in s else f"CAST(NULL AS VARCHAR) AS {c}"
        sel.append(f"SELECT '{label}' AS group_set, {key('service')}, {key('pathologie')}, {cols} FROM b_{label}")
    return O.with_ctes(O.BASE + ctes, " UNION ALL ".join(sel))


@register("measures_multi_sets", _multi_sql())
def q_measures_multi(spark, sf):
    return round_doubles(M.measures_grouping_sets(measure_base(spark, sf), _MULTI_SETS, _MULTI_NAMES))


_ROW_DOUBLES = {n for n, (_, is_double) in O.measure_exprs().items() if is_double}


def _all_measures_sql(group: list[str]) -> str:
    """All 51 measures restated: every period is a pair of dates that stays are held against, one by one."""
    month = "mois_admission" in group
    other = [c for c in group if c not in ("annee_admission", "mois_admission")]
    same = lambda cols, a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols) or "TRUE"
    rate = lambda t: f"(CASE WHEN count({t}.patient_id) = 0 THEN 0.0 ELSE CAST(count({t}.patient_id) FILTER (WHERE {t}.readmission_30j = 1) AS DOUBLE) / count({t}.patient_id) END)"
    keys = ", ".join(group)
    ctes = [O.MB, O.base_counts_sql(keys or None)]
    if month:
        ctes.append("ctx AS (SELECT *, make_date(annee_admission, mois_admission, 1) AS lo, last_day(make_date(annee_admission, mois_admission, 1)) AS hi FROM b)")
        year_back = "x.date_admission BETWEEN lo - INTERVAL 1 YEAR AND last_day(CAST(lo - INTERVAL 1 YEAR AS DATE))"
        month_back = "x.date_admission BETWEEN lo - INTERVAL 1 MONTH AND lo - INTERVAL 1 DAY"
    else:
        ctes.append("ctx AS (SELECT *, (SELECT max(date_admission) FROM mb) AS hi FROM b)")
        year_back = "x.date_admission <= hi - INTERVAL 1 YEAR"
        month_back = "x.date_admission <= hi - INTERVAL 1 MONTH"
    to_date = "x.date_admission BETWEEN make_date(CAST(year(hi) AS INTEGER), 1, 1) AND hi"
    held = lambda cond: f"FROM mb x WHERE {same(other, 'x', 'ctx')} AND {cond}"
    alone = "(SELECT pathologie, CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) AS rate FROM mb GROUP BY 1)"
    by_path = f"(SELECT {', '.join([*[c for c in group if c != 'pathologie'], 'pathologie'])}, CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) AS rate FROM mb GROUP BY ALL)"
    among = same([c for c in group if c != "pathologie"], "q", "ctx")
    now = "CAST(n_readm AS DOUBLE) / n"
    if "pathologie" in group:
        path = f"(SELECT rate FROM {alone} q WHERE q.pathologie = ctx.pathologie)"
        worst = "ctx.pathologie"
    else:
        path = "(SELECT CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) FROM mb)"
        visible = f"(SELECT DISTINCT a.pathologie, a.rate FROM {alone} a JOIN {by_path} q ON q.pathologie = a.pathologie WHERE {among})"
        worst = f"(SELECT string_agg(v.pathologie, ', ' ORDER BY v.pathologie) FROM {visible} v WHERE v.rate = (SELECT max(w.rate) FROM {visible} w))"
    ctes.append(f"""a AS (SELECT *, {now} AS now, {path} AS path,
  ({now} - (SELECT CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*) FROM mb)) * 100 AS dev,
  (SELECT count(DISTINCT q.rate) FROM {by_path} q WHERE {among} AND q.rate > {now}) + 1 AS rang, {worst} AS worst,
  (SELECT {rate('x')} {held(year_back)}) AS py, (SELECT count(*) {held(year_back)}) AS pyn, (SELECT {rate('x')} {held(month_back)}) AS pm,
  (SELECT {rate('x')} {held(to_date)}) AS ytd,
  (SELECT count(*) {held("x.readmission_30j = 1 AND x.date_admission BETWEEN hi - INTERVAL 29 DAY AND hi")}) AS roll,
  (SELECT count(*) FROM (SELECT s.service, CAST(count(*) FILTER (WHERE s.readmission_30j = 1) AS DOUBLE) / count(*) AS rate FROM mb s
    WHERE {same(group, 's', 'ctx')} GROUP BY 1) WHERE rate >= 0.20) AS above,
  (SELECT quantile_cont(x.score_risque_modele, 0.9) FILTER (WHERE x.readmission_30j = 1) - quantile_cont(x.score_risque_modele, 0.1)
    FILTER (WHERE x.readmission_30j = 0) FROM mb x WHERE {same(group, 'x', 'ctx')}) AS ks
  FROM ctx)""")
    ex = O.measure_exprs()
    cols = [f"{O.R(ex[n][0], 6) if n in _ROW_DOUBLES else ex[n][0]} AS {n}" for n in R.row_names()]
    cols += [f"{O.R('path', 6)} AS taux_readmission_pathologie", f"{O.R('dev', 6)} AS ecart_vs_moyenne_globale_pp",
             "CAST(rang AS INTEGER) AS rang_pathologie", "worst AS pathologie_plus_risquee", f"{O.R('py', 6)} AS taux_readmission_annee_precedente",
             f"{O.R('(now - py) * 100', 6)} AS delta_taux_vs_annee_precedente_pp", f"{trend_sql('(now - py) * 100')} AS icone_tendance_annee",
             f"{O.R('ytd', 6)} AS taux_readmission_ytd", "roll AS readmissions_30j_glissants", "pyn AS sejours_annee_precedente",
             f"{O.R('pm', 6)} AS taux_readmission_mois_precedent", f"{O.R('now - pm', 6)} AS delta_taux_vs_mois_precedent",
             "above AS services_au_dessus_seuil", "printf('%.3f', ROUND(CAST(ks AS DECIMAL(38,8)), 3)) AS separation_scores_ks_approx"]
    return O.with_ctes(O.BASE + ctes, f"SELECT {', '.join([*group, *cols])} FROM a")


for _suffix, _keys in {"global": [], "by_service": ["service"], "by_pathology": ["pathologie"],
                       "by_service_month": ["service", "annee_admission", "mois_admission"]}.items():
    def _mka(keys):
        def q(spark, sf):
            return round_doubles(M.measures(measure_base(spark, sf), keys, R.all_names()))
        return q
    register(f"measures_all_{_suffix}", _all_measures_sql(_keys))(_mka(_keys))
