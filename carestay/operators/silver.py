"""Silver layer: cleaning, quarantine, deduplication, per-pathology statistics,
stay metrics and diagnostic enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay import schema as S
from carestay.functions import columns as C
from carestay.plans.joins import broadcast_if_small, fixed_broadcast
from carestay.sources.reference import icd10_reference

CLEAN_COLUMNS = [
    "patient_id", "age", "sexe", "tranche_age", "pathologie", "diagnostic_principal", "service",
    "hopital_region", "duree_sejour", "categorie_duree_sejour", "nb_hospitalisations_precedentes",
    "nb_medicaments", "flag_polymedication", "date_admission", "date_sortie", "annee_admission",
    "mois_admission", "jour_semaine_admission", "mode_sortie", "flag_sortie_complexe",
    "readmission_30j", "ingestion_timestamp", "source_fichier",
]


def enforce_bronze_schema(df: DataFrame) -> DataFrame:
    """Fixed column list, order and types of the raw stay table (casts fail hard under ANSI)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.STAY_SCHEMA.fields])


def quality_predicate():
    age = F.col("age").cast("smallint")
    return (F.col("patient_id").isNotNull() & F.col("age").isNotNull() & age.between(18, 95)
            & F.col("readmission_30j").cast("smallint").isin(0, 1))


def _project_clean(df: DataFrame, strict: bool) -> DataFrame:
    # one spelling of an id, with hyphens, as a UUID cast gives
    pid = F.lower(F.col("patient_id"))
    pid = F.when(F.length(pid) == 32, F.regexp_replace(pid, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")).otherwise(pid)
    if strict:
        # an id that is not a UUID fails the job, as a UUID cast would
        pid = F.when(C.is_uuid(F.col("patient_id")), pid).otherwise(
            F.raise_error(F.concat(F.lit("invalid uuid: "), F.col("patient_id"))).cast("string"))
    age = F.col("age").cast("smallint")
    los = F.col("duree_sejour").cast("smallint")
    meds = F.col("nb_medicaments").cast("smallint")
    adm = F.col("date_admission").cast("date")
    mode = F.trim(F.col("mode_sortie"))
    return df.select(
        pid.alias("patient_id"),
        age.alias("age"),
        C.norm_upper("sexe").alias("sexe"),
        C.age_bracket(age).alias("tranche_age"),
        F.trim("pathologie").alias("pathologie"),
        C.norm_upper("diagnostic_principal").alias("diagnostic_principal"),
        C.pg_initcap(F.trim("service")).alias("service"),
        C.pg_initcap(F.trim("hopital_region")).alias("hopital_region"),
        los.alias("duree_sejour"),
        C.stay_length_bucket(los).alias("categorie_duree_sejour"),
        F.col("nb_hospitalisations_precedentes").cast("smallint").alias("nb_hospitalisations_precedentes"),
        meds.alias("nb_medicaments"),
        C.coalesce_false(meds >= 5).alias("flag_polymedication"),
        adm.alias("date_admission"),
        F.col("date_sortie").cast("date").alias("date_sortie"),
        F.year(adm).alias("annee_admission"),
        F.month(adm).alias("mois_admission"),
        C.day_of_week_sun0(adm).alias("jour_semaine_admission"),
        C.pg_initcap(mode).alias("mode_sortie"),
        C.coalesce_false(mode.isin(*S.COMPLEX_DISCHARGE_MODES)).alias("flag_sortie_complexe"),
        F.col("readmission_30j").cast("smallint").alias("readmission_30j"),
        F.col("ingestion_timestamp").cast("timestamp_ntz").alias("ingestion_timestamp"),
        F.col("source_fichier"),
    )


def clean_stays(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed, normalised stays that pass the quality filter (one row per input row).

    The filter sits on raw columns first so it is pushed into the Parquet scan.
    """
    return _project_clean(df.where(quality_predicate()), strict)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (clean rows, rejected raw rows with a ``reject_reason``).

    Besides the quality filter, a malformed UUID is rejected here instead of failing the
    job (as the strict cleaning does).
    """
    age = F.col("age").cast("smallint")
    ok = quality_predicate() & C.is_uuid(F.col("patient_id"))
    reason = (F.when(F.col("patient_id").isNull(), "patient_id null")
              .when(~C.is_uuid(F.col("patient_id")), "patient_id not a uuid")
              .when(F.col("age").isNull(), "age null")
              .when(~age.between(18, 95), "age out of range")
              .when(F.col("readmission_30j").isNull(), "target null")
              .when(~F.col("readmission_30j").cast("smallint").isin(0, 1), "target not 0/1"))
    good = _project_clean(df.where(ok), strict=False)
    bad = df.where(~F.coalesce(ok, F.lit(False))).withColumn("reject_reason", reason)
    return good, bad


def dedup_latest(df: DataFrame, key: str = "patient_id", ts: str = "ingestion_timestamp") -> DataFrame:
    """Keep one row per key: the latest ``ts`` (ties broken by the remaining columns).

    A ``max`` over a struct led by ``ts`` is aggregated partially (by sorting within the task, as its
    buffer has no fixed width), so a key that holds a large share of rows is reduced map-side instead
    of landing whole in one task (as a ``row_number`` window would).
    """
    others = [c for c in df.columns if c not in (key, ts)]
    best = F.max(F.struct(F.col(ts).alias(ts), *[F.col(c) for c in others])).alias("_best")
    return df.groupBy(key).agg(best).select(key, f"_best.{ts}", *[f"_best.{c}" for c in others]).select(*df.columns)


def pathology_stats(clean: DataFrame) -> DataFrame:
    """Per pathology: mean and sample stddev of stay, mean medications, stays, target mean."""
    return clean.groupBy("pathologie").agg(
        F.avg("duree_sejour").alias("duree_moy_patho"),
        F.stddev_samp("duree_sejour").alias("duree_std_patho"),
        F.avg("nb_medicaments").alias("meds_moy_patho"),
        F.count(F.lit(1)).alias("nb_sejours_patho"),
        F.avg(F.col("readmission_30j").cast("double")).alias("taux_readmission_patho"),
    )


def target_mean(df: DataFrame, group: str, target: str = S.TARGET, digits: int = 4) -> DataFrame:
    return df.groupBy(group).agg(C.rnd(F.avg(F.col(target).cast("double")), digits).alias(f"{target}_mean"))


def zscore_by_group(df: DataFrame, value: str, group: str, digits: int = 4, out: str | None = None) -> DataFrame:
    """(x - group mean) / group sample stddev, rounded; 0 when the stddev is null or 0.

    The group statistics are aggregated, size-checked and joined back; a null group
    never matches, so its rows get 0.
    """
    st = df.groupBy(group).agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    j = df.join(broadcast_if_small(st), group, "left")
    z = F.when(F.col("_s") > 0, C.rnd((F.col(value) - F.col("_m")) / F.col("_s"), digits)).otherwise(F.lit(0.0))
    return j.withColumn(out or f"{value}_zscore", z).drop("_m", "_s")


def _sejour_columns():
    los, meds, prior = F.col("duree_sejour"), F.col("nb_medicaments"), F.col("nb_hospitalisations_precedentes")
    return [
        F.when(F.col("duree_std_patho") > 0,
               C.rnd((los - F.col("duree_moy_patho")) / F.col("duree_std_patho"), 4))
         .otherwise(F.lit(0.0)).alias("duree_zscore_patho"),
        C.rnd(F.col("taux_readmission_patho"), 4).alias("taux_readmission_patho"),
        C.complexity_index(los, meds, prior).alias("indice_complexite"),
        *C.prior_flags(prior, los),
        C.meds_per_day(meds, los).alias("ratio_meds_duree"),
    ]


def attach_pathology_stats(clean: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """clean LEFT JOIN stats on pathology; the stats side is broadcast after a size check."""
    stats = pathology_stats(clean) if stats is None else stats
    return clean.join(broadcast_if_small(stats), "pathologie", "left")


def stay_metrics(clean: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """The per-stay metric view: z-score, complexity, flags, medication intensity."""
    j = attach_pathology_stats(clean, stats)
    return j.select(
        "patient_id", "pathologie", "service", "hopital_region", "duree_sejour",
        "nb_hospitalisations_precedentes", "nb_medicaments", "mode_sortie", "readmission_30j",
        *_sejour_columns(),
        "nb_sejours_patho", F.col("duree_moy_patho").alias("duree_moyenne_patho"))


def _diag_columns():
    sev = F.coalesce(F.col("severite_relative"), F.lit(2))
    return [
        F.coalesce(F.col("libelle_complet"), F.lit("Autre")).alias("libelle_diagnostic"),
        F.coalesce(F.col("groupe_clinique"), F.lit("AUTRE")).alias("groupe_clinique"),
        sev.alias("severite_relative"),
        F.coalesce(F.col("risque_readmission"), F.lit("Faible")).alias("risque_readmission_patho"),
        C.rnd(sev.cast("double") / F.lit(5.0), 2).alias("severite_normalisee"),
        C.coalesce_false(F.col("groupe_clinique").isin(*S.CHRONIC_GROUPS)).alias("flag_pathologie_chronique"),
        (sev >= 4).alias("flag_pathologie_critique"),
    ]


def attach_icd10(clean: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    # the built-in table is fixed; a caller's table is broadcast only after a size check
    hint = broadcast_if_small if reference is not None else fixed_broadcast
    ref = reference if reference is not None else icd10_reference(clean.sparkSession)
    ref = hint(ref.withColumnRenamed("code_cim10", "_code"))
    return clean.join(ref, clean.diagnostic_principal == ref._code, "left").drop("_code")


def enrich_diagnostics(clean: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Diagnostic view: ICD-10 lookup with defaults for unknown codes."""
    j = attach_icd10(clean, reference)
    return j.select("patient_id", F.col("diagnostic_principal").alias("code_cim10"), "pathologie",
                    *_diag_columns(), "readmission_30j")


def silver_wide(clean: DataFrame, reference: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Clean columns plus the stay-metric and diagnostic columns, one row per clean row."""
    j = attach_icd10(attach_pathology_stats(clean, stats), reference)
    return j.select(*[F.col(c) for c in clean.columns], *_sejour_columns(), *_diag_columns())
