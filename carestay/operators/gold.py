"""Gold layer: the one-row-per-stay feature table and the long-format KPI mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.operators import silver
from carestay.plans.joins import broadcast_if_small

FEATURE_TABLE_COLUMNS = [
    "patient_id",
    # numeric
    "age", "nb_hospitalisations_precedentes", "nb_medicaments", "duree_sejour", "duree_zscore_patho",
    "indice_complexite", "ratio_meds_duree", "severite_normalisee", "taux_readmission_patho",
    # binary (0/1)
    "flag_polymedication", "flag_sortie_complexe", "flag_deja_hospitalise", "flag_antecedents_lourds",
    "flag_long_sejour", "flag_pathologie_chronique", "flag_pathologie_critique",
    # categorical
    "tranche_age", "mode_sortie", "service", "groupe_clinique",
    # temporal
    "annee_admission", "mois_admission", "saison_admission",
    # target
    "readmission_30j",
    # metadata
    "pathologie", "diagnostic_principal", "hopital_region", "date_admission", "date_sortie",
    "risque_readmission_patho", "ingestion_timestamp",
]
_FLAGS = ["flag_polymedication", "flag_sortie_complexe", "flag_deja_hospitalise", "flag_antecedents_lourds",
          "flag_long_sejour", "flag_pathologie_chronique", "flag_pathologie_critique"]


def _feature_select(extra: Sequence[str] = ()) -> list[Column]:
    out = []
    for c in FEATURE_TABLE_COLUMNS:
        if c in _FLAGS:
            out.append(C.flag_to_int(c).alias(c))
        elif c == "saison_admission":
            out.append(C.season("mois_admission").alias(c))
        else:
            out.append(F.col(c))
    return out + [F.col(c) for c in extra]


def with_features(clean: DataFrame, reference: DataFrame | None = None, stats: DataFrame | None = None,
                  extra: Sequence[str] = ()) -> DataFrame:
    """Feature table in one pass: clean ⋈ pathology stats ⋈ ICD-10, then one projection.

    Equal to the three-way join on ``patient_id`` whenever ids are unique, without its
    two shuffles. ``extra`` keeps further clean columns (e.g. ``sexe``) for measures.
    """
    return silver.silver_wide(clean, reference, stats).select(*_feature_select(extra))


def with_features_train_stats(clean: DataFrame, split: DataFrame, reference: DataFrame | None = None,
                              extra: Sequence[str] = ()) -> DataFrame:
    """Feature table whose per-pathology statistics (incl. the target mean) come from the
    training rows only, so the target-mean feature does not leak the test labels.

    ``split`` carries ``patient_id`` and ``split`` ('train'/'test') for the clean rows.
    """
    train = clean.join(split.where(F.col("split") == "train").select("patient_id"), "patient_id", "left_semi")
    return with_features(clean, reference, silver.pathology_stats(train), extra)


def feature_store_join(clean: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Strict form: inner join of the patient, stay and diagnostic views on ``patient_id``.

    Keys are unique by contract (checked by the quality suite); prefer ``with_features``,
    which needs no join on the stay key.
    """
    p = clean
    s = silver.stay_metrics(clean).select(
        "patient_id", "duree_zscore_patho", "indice_complexite", "ratio_meds_duree", "taux_readmission_patho",
        "flag_deja_hospitalise", "flag_antecedents_lourds", "flag_long_sejour")
    d = silver.enrich_diagnostics(clean, reference).select(
        "patient_id", "severite_normalisee", "flag_pathologie_chronique", "flag_pathologie_critique",
        "groupe_clinique", "risque_readmission_patho")
    return p.join(s, "patient_id", "inner").join(d, "patient_id", "inner").select(*_feature_select())


# ---------------------------------------------------------------------------- KPI mart

def _kpi_aggs() -> list[Column]:
    avg_d = lambda c: F.avg(F.col(c).cast("double"))
    return [
        F.count(F.lit(1)).alias("nb_sejours"),
        F.sum("readmission_30j").cast("bigint").alias("nb_readmissions"),
        C.rnd(avg_d("readmission_30j"), 4).alias("taux_readmission"),
        C.rnd(F.avg("duree_sejour"), 2).alias("duree_sejour_moy"),
        C.rnd(F.avg("nb_medicaments"), 2).alias("nb_medicaments_moy"),
        C.rnd(F.avg("indice_complexite"), 2).alias("indice_complexite_moy"),
        C.rnd(avg_d("flag_polymedication"), 4).alias("taux_polymedication"),
        C.rnd(avg_d("flag_sortie_complexe"), 4).alias("taux_sortie_complexe"),
        C.rnd(F.avg("age"), 1).alias("age_moyen"),
    ]


KPI_METRICS = ["nb_sejours", "nb_readmissions", "taux_readmission", "duree_sejour_moy", "nb_medicaments_moy",
               "indice_complexite_moy", "taux_polymedication", "taux_sortie_complexe", "age_moyen"]

def _none() -> Column:
    return F.lit(None).cast("string")


# dimension name → (grouping columns, value expression, sub-group expression); expressions are
# built lazily because Columns need a live session
KPI_DIMENSIONS = {
    "pathologie": (["pathologie", "groupe_clinique"], lambda: F.col("pathologie"), lambda: F.col("groupe_clinique")),
    "service": (["service"], lambda: F.col("service"), _none),
    "region": (["hopital_region"], lambda: F.col("hopital_region"), _none),
    "tranche_age": (["tranche_age"], lambda: F.col("tranche_age"), _none),
    "mois": (["annee_admission", "mois_admission", "saison_admission"],
             lambda: C.month_key("annee_admission", "mois_admission"), lambda: F.col("saison_admission")),
}


def kpi_by(features: DataFrame, dimension: str) -> DataFrame:
    """KPIs of one dimension: one group-by with map-side partial aggregation."""
    cols, value, sub = KPI_DIMENSIONS[dimension]
    agg = features.groupBy(*cols).agg(*_kpi_aggs())
    return agg.select(F.lit(dimension).alias("dimension"), value().alias("valeur"), sub().alias("sous_groupe"),
                      *KPI_METRICS)


def deviation_from_dimension_mean(kpis: DataFrame) -> DataFrame:
    """Rate minus the unweighted mean rate of its dimension (window over the small KPI table)."""
    w = Window.partitionBy("dimension")
    return kpis.withColumn("ecart_vs_moyenne_dimension",
                           C.rnd(F.col("taux_readmission") - F.avg("taux_readmission").over(w), 4))


def union_kpis(dfs: Sequence[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def kpi_mart(features: DataFrame, dimensions: Sequence[str] = tuple(KPI_DIMENSIONS), ordered: bool = True) -> DataFrame:
    """The long-format KPI mart in a single scan.

    One GROUPING SETS aggregate (Expand then partial hash aggregate) replaces five
    scans of the feature table; ``grouping()`` labels each set, so a real null
    value is never mistaken for a rolled-up one.
    """
    sets = [KPI_DIMENSIONS[d][0] for d in dimensions]
    all_cols = list(dict.fromkeys(c for s in sets for c in s))
    label = None
    for d in dimensions:
        first = KPI_DIMENSIONS[d][0][0]
        cond = F.col("_g_" + first) == 0
        label = F.when(cond, F.lit(d)) if label is None else label.when(cond, F.lit(d))
    agg = features.groupingSets(sets, *all_cols).agg(
        *_kpi_aggs(), *[F.grouping(KPI_DIMENSIONS[d][0][0]).alias("_g_" + KPI_DIMENSIONS[d][0][0]) for d in dimensions])
    agg = agg.withColumn("dimension", label)
    value = sub = None
    for d in dimensions:
        _, v, s = KPI_DIMENSIONS[d]
        cond = F.col("dimension") == d
        value = F.when(cond, v()) if value is None else value.when(cond, v())
        sub = F.when(cond, s()) if sub is None else sub.when(cond, s())
    out = deviation_from_dimension_mean(
        agg.select("dimension", value.alias("valeur"), sub.alias("sous_groupe"), *KPI_METRICS))
    return out.orderBy("dimension", F.desc("taux_readmission")) if ordered else out


def group_stat_attach(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left-join a per-group statistics table after a size check (C1 in general form)."""
    return df.join(broadcast_if_small(stats), key, "left")
