"""DuckDB SQL for every registered query (the correctness oracle).

Each oracle starts from the same fixture CTEs as the Spark side, then restates the
operator in plain SQL. Rounding uses the shared rule: ``round(cast(x as decimal(38,8)), k)``
cast back to double.
"""

from __future__ import annotations

from carestay.sources.fixture import STAYS_RAW_CTES
from carestay.sources.reference import icd10_values_sql


def R(x: str, k: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {k}) AS DOUBLE)"


def INITCAP(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)', 1), "
            f"lambda w: concat(upper(substring(w, 1, 1)), lower(substring(w, 2)))), '')")


def SAFE(num: str, den: str, default: str = "0") -> str:
    return f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN CAST({default} AS DOUBLE) ELSE CAST({num} AS DOUBLE) / ({den}) END)"


CLEAN = f"""
clean AS (
  SELECT lower(patient_id) AS patient_id,
    CAST(age AS SMALLINT) AS age,
    upper(trim(sexe)) AS sexe,
    CASE WHEN age BETWEEN 18 AND 44 THEN '18-44' WHEN age BETWEEN 45 AND 64 THEN '45-64'
         WHEN age BETWEEN 65 AND 74 THEN '65-74' WHEN age BETWEEN 75 AND 84 THEN '75-84'
         WHEN age >= 85 THEN '85+' ELSE 'Inconnu' END AS tranche_age,
    trim(pathologie) AS pathologie,
    upper(trim(diagnostic_principal)) AS diagnostic_principal,
    {INITCAP('trim(service)')} AS service,
    {INITCAP('trim(hopital_region)')} AS hopital_region,
    duree_sejour,
    CASE WHEN duree_sejour BETWEEN 1 AND 3 THEN 'Courte (1-3j)' WHEN duree_sejour BETWEEN 4 AND 7 THEN 'Moyenne (4-7j)'
         WHEN duree_sejour BETWEEN 8 AND 14 THEN 'Longue (8-14j)' WHEN duree_sejour > 14 THEN 'Tres longue (>14j)'
         ELSE 'Inconnu' END AS categorie_duree_sejour,
    nb_hospitalisations_precedentes,
    nb_medicaments,
    COALESCE(nb_medicaments >= 5, FALSE) AS flag_polymedication,
    date_admission,
    date_sortie,
    CAST(year(date_admission) AS INTEGER) AS annee_admission,
    CAST(month(date_admission) AS INTEGER) AS mois_admission,
    CAST(dayofweek(date_admission) AS INTEGER) AS jour_semaine_admission,
    {INITCAP('trim(mode_sortie)')} AS mode_sortie,
    COALESCE(trim(mode_sortie) IN ('SSR', 'EHPAD', 'Transfert'), FALSE) AS flag_sortie_complexe,
    readmission_30j,
    ingestion_timestamp,
    source_fichier
  FROM stays_raw
  WHERE patient_id IS NOT NULL AND age IS NOT NULL AND age BETWEEN 18 AND 95 AND readmission_30j IN (0, 1))"""

PATHO_STATS = """
pstats AS (
  SELECT pathologie,
    avg(duree_sejour) AS duree_moy_patho,
    stddev_samp(duree_sejour) AS duree_std_patho,
    avg(nb_medicaments) AS meds_moy_patho,
    count(*) AS nb_sejours_patho,
    avg(CAST(readmission_30j AS DOUBLE)) AS taux_readmission_patho
  FROM clean GROUP BY pathologie)"""

ICD10 = icd10_values_sql()

SEJOUR_COLS = f"""
    CASE WHEN s.duree_std_patho > 0 THEN {R('(p.duree_sejour - s.duree_moy_patho) / s.duree_std_patho', 4)} ELSE 0.0 END AS duree_zscore_patho,
    {R('s.taux_readmission_patho', 4)} AS taux_readmission_patho,
    LEAST(10.0, {R('CAST(LEAST(p.duree_sejour, 30) AS DOUBLE) / 30.0E0 * 3.5E0 + CAST(LEAST(p.nb_medicaments, 15) AS DOUBLE) / 15.0E0 * 3.0E0 + CAST(LEAST(p.nb_hospitalisations_precedentes, 5) AS DOUBLE) / 5.0E0 * 3.5E0', 2)}) AS indice_complexite,
    COALESCE(p.nb_hospitalisations_precedentes >= 3, FALSE) AS flag_antecedents_lourds,
    COALESCE(p.nb_hospitalisations_precedentes >= 1, FALSE) AS flag_deja_hospitalise,
    COALESCE(p.duree_sejour >= 14, FALSE) AS flag_long_sejour,
    CASE WHEN p.duree_sejour > 0 THEN {R('CAST(p.nb_medicaments AS DOUBLE) / p.duree_sejour', 4)} ELSE 0.0 END AS ratio_meds_duree"""

DIAG_COLS = f"""
    COALESCE(m.libelle_complet, 'Autre') AS libelle_diagnostic,
    COALESCE(m.groupe_clinique, 'AUTRE') AS groupe_clinique,
    COALESCE(m.severite_relative, 2) AS severite_relative,
    COALESCE(m.risque_readmission, 'Faible') AS risque_readmission_patho,
    {R('CAST(COALESCE(m.severite_relative, 2) AS DOUBLE) / 5.0E0', 2)} AS severite_normalisee,
    COALESCE(m.groupe_clinique IN ('CARDIO', 'NEPHRO', 'METABOL', 'PULMO'), FALSE) AS flag_pathologie_chronique,
    COALESCE(m.severite_relative, 2) >= 4 AS flag_pathologie_critique"""

FEATURES = f"""
wide AS (
  SELECT p.*, {SEJOUR_COLS}, {DIAG_COLS}
  FROM clean p LEFT JOIN pstats s ON p.pathologie = s.pathologie
  LEFT JOIN icd10 m ON p.diagnostic_principal = m.code_cim10),
features AS (
  SELECT patient_id, age, nb_hospitalisations_precedentes, nb_medicaments, duree_sejour, duree_zscore_patho,
    indice_complexite, ratio_meds_duree, severite_normalisee, taux_readmission_patho,
    CAST(flag_polymedication AS INTEGER) AS flag_polymedication,
    CAST(flag_sortie_complexe AS INTEGER) AS flag_sortie_complexe,
    CAST(flag_deja_hospitalise AS INTEGER) AS flag_deja_hospitalise,
    CAST(flag_antecedents_lourds AS INTEGER) AS flag_antecedents_lourds,
    CAST(flag_long_sejour AS INTEGER) AS flag_long_sejour,
    CAST(flag_pathologie_chronique AS INTEGER) AS flag_pathologie_chronique,
    CAST(flag_pathologie_critique AS INTEGER) AS flag_pathologie_critique,
    tranche_age, mode_sortie, service, groupe_clinique,
    annee_admission, mois_admission,
    CASE WHEN mois_admission IN (12, 1, 2) THEN 'Hiver' WHEN mois_admission IN (3, 4, 5) THEN 'Printemps'
         WHEN mois_admission IN (6, 7, 8) THEN 'Ete' WHEN mois_admission IN (9, 10, 11) THEN 'Automne' END AS saison_admission,
    readmission_30j,
    pathologie, diagnostic_principal, hopital_region, date_admission, date_sortie, risque_readmission_patho,
    ingestion_timestamp, sexe
  FROM wide)"""

BASE = [CLEAN, PATHO_STATS, ICD10, FEATURES]


def with_ctes(ctes: list[str], final: str) -> str:
    parts = [STAYS_RAW_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final


def KPI_AGGS() -> str:
    return f"""count(*) AS nb_sejours,
    CAST(sum(readmission_30j) AS BIGINT) AS nb_readmissions,
    {R('avg(CAST(readmission_30j AS DOUBLE))', 4)} AS taux_readmission,
    {R('avg(duree_sejour)', 2)} AS duree_sejour_moy,
    {R('avg(nb_medicaments)', 2)} AS nb_medicaments_moy,
    {R('avg(indice_complexite)', 2)} AS indice_complexite_moy,
    {R('avg(CAST(flag_polymedication AS DOUBLE))', 4)} AS taux_polymedication,
    {R('avg(CAST(flag_sortie_complexe AS DOUBLE))', 4)} AS taux_sortie_complexe,
    {R('avg(age)', 1)} AS age_moyen"""


KPI_DIM_SQL = {
    "pathologie": ("pathologie", "groupe_clinique", "pathologie, groupe_clinique"),
    "service": ("service", "CAST(NULL AS VARCHAR)", "service"),
    "region": ("hopital_region", "CAST(NULL AS VARCHAR)", "hopital_region"),
    "tranche_age": ("tranche_age", "CAST(NULL AS VARCHAR)", "tranche_age"),
    "mois": ("concat_ws('', CAST(annee_admission AS VARCHAR), '-', lpad(CAST(mois_admission AS VARCHAR), 2, '0'))",
             "saison_admission", "annee_admission, mois_admission, saison_admission"),
}


def kpi_by_sql(dim: str) -> str:
    v, sg, grp = KPI_DIM_SQL[dim]
    return f"SELECT '{dim}' AS dimension, {v} AS valeur, {sg} AS sous_groupe, {KPI_AGGS()} FROM features GROUP BY {grp}"


# ------------------------------------------------------------------ measures

SCORECARD = f"""{R('''CAST(LEAST(85, GREATEST(5, 10
    + CASE WHEN age > 70 THEN 12 ELSE 0 END + CASE WHEN age > 80 THEN 8 ELSE 0 END
    + CASE WHEN nb_hospitalisations_precedentes >= 2 THEN 15 ELSE 0 END
    + CASE WHEN nb_hospitalisations_precedentes >= 4 THEN 10 ELSE 0 END
    + CASE WHEN nb_medicaments >= 8 THEN 8 ELSE 0 END + CASE WHEN duree_sejour >= 10 THEN 6 ELSE 0 END
    + CASE WHEN upper(mode_sortie) IN ('SSR', 'EHPAD') THEN 7 ELSE 0 END
    + CASE WHEN pathologie = 'Sepsis' THEN 12 ELSE 0 END
    + CASE WHEN pathologie = 'Insuffisance cardiaque' THEN 8 ELSE 0 END)) AS DOUBLE) / 100.0E0''', 4)}"""

MB = f"mb AS (SELECT *, {SCORECARD} AS score_risque_modele FROM features)"


def CNT(cond: str | None = None) -> str:
    return "count(*)" if cond is None else f"count(*) FILTER (WHERE {cond})"


def base_counts_sql(group: str | None) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    rd = "readmission_30j = 1"
    return f"""b AS (SELECT {g}{CNT()} AS n, {CNT(rd)} AS n_readm,
  avg(duree_sejour) AS avg_los, avg(age) AS avg_age, avg(nb_medicaments) AS avg_meds, avg(indice_complexite) AS avg_complexity,
  {CNT('flag_polymedication = 1')} AS n_poly, {CNT('flag_sortie_complexe = 1')} AS n_complex,
  avg(score_risque_modele) AS avg_score, max(score_risque_modele) AS max_score,
  {CNT('score_risque_modele >= 0.7')} AS n_high, {CNT('score_risque_modele >= 0.4 AND score_risque_modele < 0.7')} AS n_moderate,
  {CNT('score_risque_modele < 0.4')} AS n_low,
  {CNT('age >= 75')} AS n_senior, {CNT('age >= 75 AND ' + rd)} AS n_senior_readm,
  {CNT('flag_antecedents_lourds = 1')} AS n_heavy, {CNT('flag_antecedents_lourds = 1 AND ' + rd)} AS n_heavy_readm,
  {CNT("sexe = 'M'")} AS n_m, {CNT("sexe = 'M' AND " + rd)} AS n_m_readm,
  {CNT("sexe = 'F'")} AS n_f, {CNT("sexe = 'F' AND " + rd)} AS n_f_readm,
  {CNT('score_risque_modele < 0.5 AND ' + rd)} AS n_missed,
  {CNT('score_risque_modele >= 0.5 AND ' + rd)} AS tp,
  {CNT('score_risque_modele >= 0.5 AND readmission_30j = 0')} AS fp,
  {CNT('score_risque_modele < 0.5 AND ' + rd)} AS fn,
  {CNT('score_risque_modele < 0.5 AND readmission_30j = 0')} AS tn
FROM mb{gb})"""


def _band(x: str, bands, default: str, strict: bool = False) -> str:
    op = ">" if strict else ">="
    whens = " ".join(f"WHEN {x} {op} {b} THEN '{l}'" for b, l in bands)
    return f"CASE {whens} ELSE '{default}' END"


def measure_exprs() -> dict[str, tuple[str, bool]]:
    """measure name → (SQL over the base-count CTE, is_double)."""
    from carestay.operators.measures import (ALERT_COLOURS, ALERT_COLOUR_DEFAULT, FALSE_ALERT_COST,
                                             FALSE_ALERT_COST_DEFAULT, STATUS_DEFAULT, STATUS_LABELS)
    rate = SAFE("n_readm", "n")
    prec = SAFE("tp", "tp + fp")
    rec = SAFE("tp", "tp + fn")
    return {
        "total_sejours": ("n", False),
        "total_readmissions": ("n_readm", False),
        "taux_readmission": (rate, True),
        "taux_readmission_label": (f"printf('%.1f%%', ROUND(CAST({rate} * 100 AS DECIMAL(38,8)), 1))", False),
        "duree_moyenne_sejour": ("COALESCE(avg_los, 0.0)", True),
        "age_moyen": ("COALESCE(avg_age, 0.0)", True),
        "medicaments_moyen": ("COALESCE(avg_meds, 0.0)", True),
        "taux_polymedication": (SAFE("n_poly", "n"), True),
        "taux_sortie_complexe": (SAFE("n_complex", "n"), True),
        "score_risque_moyen": ("avg_score", True),
        "score_risque_maximum": ("max_score", True),
        "patients_risque_eleve": ("n_high", False),
        "patients_risque_modere": ("n_moderate", False),
        "patients_risque_faible": ("n_low", False),
        "pct_risque_eleve": (SAFE("n_high", "n"), True),
        "pct_risque_modere": (SAFE("n_moderate", "n"), True),
        "pct_risque_faible": (SAFE("n_low", "n"), True),
        "indice_complexite_moyen": ("avg_complexity", True),
        "taux_seniors_75": (SAFE("n_senior_readm", "n_senior"), True),
        "pct_seniors_75": (SAFE("n_senior", "n"), True),
        "taux_antecedents_lourds": (SAFE("n_heavy_readm", "n_heavy"), True),
        "taux_sexe_m": (SAFE("n_m_readm", "n_m"), True),
        "taux_sexe_f": (SAFE("n_f_readm", "n_f"), True),
        "delta_h_vs_f": (f"{SAFE('n_m_readm', 'n_m')} - {SAFE('n_f_readm', 'n_f')}", True),
        "couleur_alerte": (_band(rate, ALERT_COLOURS, ALERT_COLOUR_DEFAULT), False),
        "statut_performance": (_band(rate, STATUS_LABELS, STATUS_DEFAULT), False),
        "non_alertes_rehospitalises": (SAFE("n_missed", "n_readm"), True),
        "vrais_positifs": ("tp", False),
        "faux_positifs": ("fp", False),
        "faux_negatifs": ("fn", False),
        "vrais_negatifs": ("tn", False),
        "precision_modele": (prec, True),
        "rappel_modele": (rec, True),
        "f1_modele": (SAFE(f"2 * {prec} * {rec}", f"{prec} + {rec}"), True),
        "accuracy_modele": (SAFE("tp + tn", "n"), True),
        "specificite_modele": (SAFE("tn", "tn + fp"), True),
        "cout_fausses_alertes": (_band(SAFE("fp", "n"), FALSE_ALERT_COST, FALSE_ALERT_COST_DEFAULT, True), False),
    }


def measures_sql(group: str | None, names: list[str], digits: int = 6) -> str:
    ex = measure_exprs()
    cols = ", ".join((R(ex[n][0], digits) if ex[n][1] else ex[n][0]) + f" AS {n}" for n in names)
    g = f"{group}, " if group else ""
    return with_ctes(BASE + [MB, base_counts_sql(group)], f"SELECT {g}{cols} FROM b")


# ------------------------------------------------------------------ quality

def expectation_sql(e, table: str, model: str) -> str:
    c = e.column
    if e.kind == "unique":
        body = f"(SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
    elif e.kind == "not_null":
        body = f"(SELECT count(*) FROM {table} WHERE {c} IS NULL)"
    elif e.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in e.values)
        body = f"(SELECT count(*) FROM {table} WHERE NOT ({c} IN ({vals})))"
    elif e.kind == "range":
        conds = []
        if e.min_value is not None:
            conds.append(f"{c} >= {e.min_value}")
        if e.max_value is not None:
            conds.append(f"{c} <= {e.max_value}")
        body = f"(SELECT count(*) FROM {table} WHERE NOT ({' AND '.join(conds)}))"
    elif e.kind == "date_order":
        body = f"(SELECT count(*) FROM {table} WHERE {c} < {e.other})"
    elif e.kind == "positive":
        body = f"(SELECT count(*) FROM {table} WHERE {c} <= 0)"
    elif e.kind == "rate_within":
        body = (f"(SELECT CASE WHEN avg(CAST({c} AS DOUBLE)) < {e.min_value} OR avg(CAST({c} AS DOUBLE)) > {e.max_value} "
                f"THEN 1 ELSE 0 END FROM {table})")
    else:
        raise ValueError(e.kind)
    return (f"SELECT '{model}' AS model, '{e.kind}' AS \"check\", '{c}' AS \"column\", CAST({body} AS BIGINT) AS failing_rows")


def quality_report_sql(suites: list[tuple[str, str, list]]) -> str:
    parts = [expectation_sql(e, t, m) for m, t, suite in suites for e in suite]
    return ("SELECT model, \"check\", \"column\", failing_rows, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + "\nUNION ALL\n".join(parts) + ")")


DASHBOARD_SQL = {
    "readmissions_by_date": ("date_admission", "count(*) FILTER (WHERE readmission_30j = 1) AS total_readmissions"),
    "stays_by_tier": ("CASE WHEN score_risque_modele >= 0.70 THEN 'Eleve' WHEN score_risque_modele >= 0.40 THEN 'Modere' "
                      "WHEN score_risque_modele >= 0.20 THEN 'Faible' ELSE 'Tres faible' END AS categorie_risque",
                      "count(*) AS total_sejours"),
    "stays_by_season": ("saison_admission", "count(*) AS total_sejours"),
    "stays_by_discharge": ("mode_sortie", "count(*) AS total_sejours"),
    "pathology_rate_score": ("pathologie", f"{R('CAST(count(*) FILTER (WHERE readmission_30j = 1) AS DOUBLE) / count(*)', 6)} AS taux_readmission, "
                                           f"{R('avg(score_risque_modele)', 6)} AS score_risque_moyen"),
    "age_complexity_by_pathology": ("pathologie", f"{R('avg(age)', 6)} AS age_moyen, {R('avg(indice_complexite)', 6)} AS indice_complexite_moyen"),
    "prior_by_group": ("groupe_clinique", f"{R('avg(nb_hospitalisations_precedentes)', 6)} AS hospitalisations_precedentes_moy"),
    "meds_by_pathology": ("pathologie", f"{R('avg(nb_medicaments)', 6)} AS medicaments_moyen"),
    "complexity_by_service": ("service", f"{R('avg(indice_complexite)', 6)} AS indice_complexite_moyen"),
}


def dashboard_sql(name: str) -> str:
    key, aggs = DASHBOARD_SQL[name]
    return with_ctes(BASE + [MB], f"SELECT {key}, {aggs} FROM mb GROUP BY 1")
