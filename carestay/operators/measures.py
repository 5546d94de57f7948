"""BI measures evaluated per group set, plus pathology ranking and exact percentiles.

``measures(df, group_by)`` computes every base count in ONE aggregate (conditional
``count_if``/``avg``/``max``) and derives the 37 measures of one grain as ratios and labels of those
counts. Empty counts and ratios are 0 (``null_on_empty=True`` gives null instead). The other 14 (pathology,
calendar, services, percentiles) have grains of their own in ``measure_registry``; ``measures`` takes all 51 by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.plans.joins import broadcast_if_small
from carestay.plans.ranking import running_totals

SCORE = "score_risque_modele"
HIGH, MODERATE, ALERT = 0.70, 0.40, 0.50

# Alert colours and status labels by readmission-rate band.
ALERT_COLOURS = [(0.30, "#F44336"), (0.20, "#FF9800"), (0.15, "#FFC107")]
ALERT_COLOUR_DEFAULT = "#4CAF50"
STATUS_LABELS = [(0.30, "CRITIQUE"), (0.20, "ATTENTION"), (0.15, "SURVEILLANCE")]
STATUS_DEFAULT = "NORMAL"
FALSE_ALERT_COST = [(0.25, "HIGH"), (0.15, "MEDIUM")]
FALSE_ALERT_COST_DEFAULT = "LOW"


def measure_base(features: DataFrame, score: Column | None = None) -> DataFrame:
    """Feature rows with a ``score_risque_modele`` column.

    Without a model score the scorecard score stands in (same rules as the source's
    generator), so measures need no model fit.
    """
    s = C.additive_scorecard() if score is None else score
    return features.withColumn(SCORE, s)


def stay_measures_base(features: DataFrame, scores: DataFrame, clean: DataFrame | None = None) -> DataFrame:
    """Feature rows with the model's ``score_risque_modele`` attached by stay key (left join: a stay without a score keeps null).

    ``scores`` is the score table of ``model.score_export`` or its CSV (``io.read_scores``). ``clean`` adds the
    columns that only silver has (``sexe``) where ``features`` lacks them. Keys are stay ids, so the joins
    are plain shuffle joins on an even key.
    """
    key = scores.select(F.col("patient_id").alias("_scored"), F.col(SCORE).cast("double").alias(SCORE))
    base = features.drop(SCORE)
    if clean is not None and "sexe" not in base.columns:
        extra = clean.select(F.col("patient_id").alias("_stay"), "sexe")
        base = base.join(extra, base["patient_id"] == extra["_stay"], "left").drop("_stay")
    return base.join(key, base["patient_id"] == key["_scored"], "left").drop("_scored")


def _readm(cond: Column | None = None) -> Column:
    c = F.col("readmission_30j") == 1
    return F.count_if(c if cond is None else (c & cond))


def _n(cond: Column | None = None) -> Column:
    return F.count(F.lit(1)) if cond is None else F.count_if(cond)


def _base_aggs() -> list[Column]:
    sc, age = F.col(SCORE), F.col("age")
    sexe = F.col("sexe")
    aggs = [
        _n().alias("n"), _readm().alias("n_readm"),
        F.avg("duree_sejour").alias("avg_los"), F.avg("age").alias("avg_age"),
        F.avg("nb_medicaments").alias("avg_meds"), F.avg("indice_complexite").alias("avg_complexity"),
        _n(F.col("flag_polymedication") == 1).alias("n_poly"),
        _n(F.col("flag_sortie_complexe") == 1).alias("n_complex"),
        F.avg(sc).alias("avg_score"), F.max(sc).alias("max_score"),
        _n(sc >= HIGH).alias("n_high"), _n((sc >= MODERATE) & (sc < HIGH)).alias("n_moderate"),
        _n(sc < MODERATE).alias("n_low"),
        _n(age >= 75).alias("n_senior"), _readm(age >= 75).alias("n_senior_readm"),
        _n(F.col("flag_antecedents_lourds") == 1).alias("n_heavy"),
        _readm(F.col("flag_antecedents_lourds") == 1).alias("n_heavy_readm"),
        _n(sexe == "M").alias("n_m"), _readm(sexe == "M").alias("n_m_readm"),
        _n(sexe == "F").alias("n_f"), _readm(sexe == "F").alias("n_f_readm"),
        _readm(sc < ALERT).alias("n_missed"),
        _readm(sc >= ALERT).alias("tp"),
        _n((sc >= ALERT) & (F.col("readmission_30j") == 0)).alias("fp"),
        _readm(sc < ALERT).alias("fn"),
        _n((sc < ALERT) & (F.col("readmission_30j") == 0)).alias("tn"),
    ]
    return aggs


def base_counts(df: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    aggs = _base_aggs()
    return df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)


def ratio(num: str | Column, den: str | Column, null_on_empty: bool) -> Column:
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    if null_on_empty:
        return F.when(den > 0, num.cast("double") / den)
    return C.safe_ratio(num, den, 0)


def derive_measures(b: DataFrame, group_by: Sequence[str] = (), null_on_empty: bool = False) -> DataFrame:
    r = lambda n, d: ratio(n, d, null_on_empty)
    rate = r("n_readm", "n")
    prec = r("tp", F.col("tp") + F.col("fp"))
    rec = r("tp", F.col("tp") + F.col("fn"))
    # one rule for every average and maximum over no rows: null where asked for, else 0
    z = F.lit(0.0) if not null_on_empty else F.lit(None).cast("double")
    cols = {
        "total_sejours": F.col("n"),
        "total_readmissions": F.col("n_readm"),
        "taux_readmission": rate,
        "taux_readmission_label": C.pct_label(rate, 1),
        "duree_moyenne_sejour": F.coalesce(F.col("avg_los"), z),
        "age_moyen": F.coalesce(F.col("avg_age"), z),
        "medicaments_moyen": F.coalesce(F.col("avg_meds"), z),
        "taux_polymedication": r("n_poly", "n"),
        "taux_sortie_complexe": r("n_complex", "n"),
        "score_risque_moyen": F.coalesce(F.col("avg_score"), z),
        "score_risque_maximum": F.coalesce(F.col("max_score"), z),
        "patients_risque_eleve": F.col("n_high"),
        "patients_risque_modere": F.col("n_moderate"),
        "patients_risque_faible": F.col("n_low"),
        "pct_risque_eleve": r("n_high", "n"),
        "pct_risque_modere": r("n_moderate", "n"),
        "pct_risque_faible": r("n_low", "n"),
        "indice_complexite_moyen": F.coalesce(F.col("avg_complexity"), z),
        "taux_seniors_75": r("n_senior_readm", "n_senior"),
        "pct_seniors_75": r("n_senior", "n"),
        "taux_antecedents_lourds": r("n_heavy_readm", "n_heavy"),
        "taux_sexe_m": r("n_m_readm", "n_m"),
        "taux_sexe_f": r("n_f_readm", "n_f"),
        "delta_h_vs_f": r("n_m_readm", "n_m") - r("n_f_readm", "n_f"),
        "couleur_alerte": C.threshold_label(rate, ALERT_COLOURS, ALERT_COLOUR_DEFAULT),
        "statut_performance": C.threshold_label(rate, STATUS_LABELS, STATUS_DEFAULT),
        "non_alertes_rehospitalises": r("n_missed", "n_readm"),
        "vrais_positifs": F.col("tp"),
        "faux_positifs": F.col("fp"),
        "faux_negatifs": F.col("fn"),
        "vrais_negatifs": F.col("tn"),
        "precision_modele": prec,
        "rappel_modele": rec,
        "f1_modele": ratio(2 * prec * rec, prec + rec, null_on_empty),
        "accuracy_modele": r(F.col("tp") + F.col("tn"), "n"),
        "specificite_modele": r("tn", F.col("tn") + F.col("fp")),
        "cout_fausses_alertes": C.threshold_label(C.safe_ratio("fp", "n"), FALSE_ALERT_COST,
                                                  FALSE_ALERT_COST_DEFAULT, strict=True),
    }
    return b.select(*group_by, *[v.alias(k) for k, v in cols.items()])


MEASURE_GROUPS = {
    "global": ["total_sejours", "total_readmissions", "taux_readmission", "taux_readmission_label",
               "duree_moyenne_sejour", "age_moyen", "medicaments_moyen", "taux_polymedication",
               "taux_sortie_complexe"],
    "risk": ["score_risque_moyen", "score_risque_maximum", "patients_risque_eleve", "patients_risque_modere",
             "patients_risque_faible", "pct_risque_eleve", "pct_risque_modere", "pct_risque_faible"],
    "demographics": ["taux_seniors_75", "pct_seniors_75", "taux_antecedents_lourds", "delta_h_vs_f",
                     "taux_sexe_m", "taux_sexe_f"],
    "alerts": ["taux_readmission", "couleur_alerte", "statut_performance", "non_alertes_rehospitalises"],
    "confusion": ["vrais_positifs", "faux_positifs", "faux_negatifs", "vrais_negatifs", "precision_modele",
                  "rappel_modele", "f1_modele", "accuracy_modele", "specificite_modele", "cout_fausses_alertes"],
}


#: The measures of the row grain, in their order.
MEASURE_COLUMNS = [
    "total_sejours", "total_readmissions", "taux_readmission", "taux_readmission_label", "duree_moyenne_sejour", "age_moyen",
    "medicaments_moyen", "taux_polymedication", "taux_sortie_complexe", "score_risque_moyen", "score_risque_maximum",
    "patients_risque_eleve", "patients_risque_modere", "patients_risque_faible", "pct_risque_eleve", "pct_risque_modere",
    "pct_risque_faible", "indice_complexite_moyen", "taux_seniors_75", "pct_seniors_75", "taux_antecedents_lourds", "taux_sexe_m",
    "taux_sexe_f", "delta_h_vs_f", "couleur_alerte", "statut_performance", "non_alertes_rehospitalises", "vrais_positifs",
    "faux_positifs", "faux_negatifs", "vrais_negatifs", "precision_modele", "rappel_modele", "f1_modele", "accuracy_modele",
    "specificite_modele", "cout_fausses_alertes"]


def measures(df: DataFrame, group_by: Sequence[str] = (), names: Sequence[str] | None = None,
             null_on_empty: bool = False) -> DataFrame:
    """Measures per group of ``group_by``: one aggregate pass over ``df`` for the 37 of the row grain (all of them by
    default), and one more for each further grain that ``names`` asks for."""
    if names and not set(names) <= set(MEASURE_COLUMNS):
        from carestay.operators.measure_registry import by_name
        return by_name(df, group_by, names, null_on_empty)
    out = derive_measures(base_counts(df, group_by), group_by, null_on_empty)
    return out.select(*group_by, *names) if names else out


# ------------------------------------------------------------ pathology analysis

def pathology_ranking(df: DataFrame, key: str = "pathologie") -> DataFrame:
    """Rate per pathology, deviation from the all-rows rate in pp, and dense rank (desc).

    The per-pathology table is small; the global rate comes from window sums over it,
    so the raw rows are aggregated once.
    """
    per = df.groupBy(key).agg(_n().alias("n"), _readm().alias("n_readm"),
                              F.avg("indice_complexite").alias("indice_complexite_moy"))
    # unpartitioned windows run over the per-pathology table (one row per pathology), not over stays
    w_all = Window.partitionBy()
    rate = C.safe_ratio("n_readm", "n")
    glob = C.safe_ratio(F.sum("n_readm").over(w_all), F.sum("n").over(w_all))
    ranked = per.select(key, F.col("n").alias("total_sejours"), rate.alias("taux_readmission_pathologie"),
                        ((rate - glob) * 100).alias("ecart_vs_moyenne_globale_pp"),
                        "indice_complexite_moy")
    return ranked.withColumn("rang_pathologie",
                             F.dense_rank().over(Window.orderBy(F.desc("taux_readmission_pathologie"))))


def top_pathology(df: DataFrame, key: str = "pathologie") -> DataFrame:
    """The highest-rate pathology; ties are all kept."""
    return pathology_ranking(df, key).where(F.col("rang_pathologie") == 1).select(key, "taux_readmission_pathologie")


def services_above_threshold(df: DataFrame, threshold: float = 0.20, key: str = "service") -> DataFrame:
    per = df.groupBy(key).agg(C.safe_ratio(_readm(), _n()).alias("rate"))
    return per.agg(F.count_if(F.col("rate") >= threshold).alias("services_au_dessus_seuil"))


# ------------------------------------------------------------ exact percentiles

def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float], group_by: Sequence[str] = (),
                      buckets: int | None = None, prefix: str = "p") -> DataFrame:
    """Exact percentiles with linear interpolation (inclusive definition), distributed.

    Values are counted per distinct value, ranked with bucketed running totals and the
    two neighbouring order statistics are read off; no group is ever held in one task.
    """
    part = list(group_by)
    g = df.where(F.col(value).isNotNull()).groupBy(*part, value).agg(F.count(F.lit(1)).alias("_n"))
    r = running_totals(g, [value], ["_n"], part, buckets)
    aggs = []
    for p in probs:
        h = (F.col("tot__n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        first = F.col("cum__n") - F.col("_n")
        at_lo = (first <= lo) & (lo < F.col("cum__n"))
        at_hi = (first <= hi) & (hi < F.col("cum__n"))
        tag = f"{prefix}{int(round(p * 100))}"
        aggs += [F.max(F.when(at_lo, F.col(value))).alias(f"_{tag}_lo"),
                 F.max(F.when(at_hi, F.col(value))).alias(f"_{tag}_hi"),
                 F.max(h - lo).alias(f"_{tag}_f")]
    res = r.groupBy(*part).agg(*aggs) if part else r.agg(*aggs)
    outs = []
    for p in probs:
        tag = f"{prefix}{int(round(p * 100))}"
        lo_v, hi_v, f = F.col(f"_{tag}_lo"), F.col(f"_{tag}_hi"), F.col(f"_{tag}_f")
        outs.append((lo_v + f * (hi_v - lo_v)).alias(tag))
    return res.select(*part, *outs)


def exact_percentile(df: DataFrame, value: str, p: float, group_by: Sequence[str] = ()) -> DataFrame:
    return exact_percentiles(df, value, [p], group_by)


def ks_approx(df: DataFrame, score: str = SCORE, group_by: Sequence[str] = ()) -> DataFrame:
    """P90 of the positives' scores minus P10 of the negatives', with its ``0.000`` label."""
    y = F.col("readmission_30j")
    # one ranking for both classes; a null group is a group like any other
    per = exact_percentiles(df.where(y.isin(0, 1)), score, [0.1, 0.9], [*group_by, "readmission_30j"])
    ends = [F.max(F.when(y == 1, F.col("p90"))).alias("p90"), F.max(F.when(y == 0, F.col("p10"))).alias("p10")]
    j = per.groupBy(*group_by).agg(*ends) if group_by else per.agg(*ends)
    sep = F.col("p90") - F.col("p10")
    return j.select(*group_by, "p90", "p10", sep.alias("ks_approx"), C.number_label(sep, 3).alias("ks_approx_label"))


def measures_grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], names: Sequence[str] | None = None,
                           null_on_empty: bool = False) -> DataFrame:
    """Measures for several group sets (e.g. overall, by service, by pathology) in ONE scan.

    One GROUPING SETS aggregate computes the base counts of every set; ``grouping()`` flags
    label each row with its set (``group_set``), so a real null member is never confused
    with a rolled-up one. Columns not in a row's set are null.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    flags = [F.grouping(c).alias(f"_g_{c}") for c in cols]
    b = df.groupingSets([list(s) for s in sets], *cols).agg(*_base_aggs(), *flags)
    label = None
    for s in sets:
        cond = F.lit(True)
        for c in cols:
            cond = cond & (F.col(f"_g_{c}") == (0 if c in s else 1))
        name = "+".join(s) if s else "all"
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    b = b.withColumn("group_set", label)
    out = derive_measures(b, ["group_set", *cols], null_on_empty)
    return out.select("group_set", *cols, *names) if names else out
