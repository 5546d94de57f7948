"""Dashboard views, label translation, filter-independent rates, ordering helpers.

The report pages are groupings of the measure layer; each is one grouped aggregate over
the measure base (features + score), so every visual is a single partial-aggregated pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.plans.joins import broadcast_if_small, materialize


def _rate() -> Column:
    return C.safe_ratio(F.count_if(F.col("readmission_30j") == 1), F.count(F.lit(1)))


# name → (grouping expression builder, aggregates builder); builders run lazily (Columns need a session)
DASHBOARDS = {
    "readmissions_by_date": (lambda: [F.col("date_admission")],
                             lambda: [F.count_if(F.col("readmission_30j") == 1).alias("total_readmissions")]),
    "stays_by_tier": (lambda: [C.classify_risk("score_risque_modele").alias("categorie_risque")],
                      lambda: [F.count(F.lit(1)).alias("total_sejours")]),
    "stays_by_season": (lambda: [F.col("saison_admission")], lambda: [F.count(F.lit(1)).alias("total_sejours")]),
    "stays_by_discharge": (lambda: [F.col("mode_sortie")], lambda: [F.count(F.lit(1)).alias("total_sejours")]),
    "pathology_rate_score": (lambda: [F.col("pathologie")],
                             lambda: [_rate().alias("taux_readmission"), F.avg("score_risque_modele").alias("score_risque_moyen")]),
    "age_complexity_by_pathology": (lambda: [F.col("pathologie")],
                                    lambda: [F.avg("age").alias("age_moyen"), F.avg("indice_complexite").alias("indice_complexite_moyen")]),
    "prior_by_group": (lambda: [F.col("groupe_clinique")],
                       lambda: [F.avg("nb_hospitalisations_precedentes").alias("hospitalisations_precedentes_moy")]),
    "meds_by_pathology": (lambda: [F.col("pathologie")], lambda: [F.avg("nb_medicaments").alias("medicaments_moyen")]),
    "complexity_by_service": (lambda: [F.col("service")],
                              lambda: [F.avg("indice_complexite").alias("indice_complexite_moyen")]),
}


def dashboard(base: DataFrame, name: str) -> DataFrame:
    keys, aggs = DASHBOARDS[name]
    return base.groupBy(*keys()).agg(*aggs())


def translate_labels(df: DataFrame, dictionary: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Add the English label of ``column`` (the source label when the dictionary has none).

    The dictionary is a lookup table; it is broadcast after a size check.
    """
    d = dictionary.select(F.col("label_fr").alias("_fr"), F.col("label_en").alias("_en"))
    j = df.join(broadcast_if_small(d), df[column] == F.col("_fr"), "left")
    return j.withColumn(out or f"{column}_en", F.coalesce(F.col("_en"), F.col(column))).drop("_fr", "_en")


def rate_ignoring_filters(filtered: DataFrame, full: DataFrame, key: str = "pathologie") -> DataFrame:
    """Per ``key``: the rate in the filtered selection next to the rate over the unfiltered table
    (the filter on every other column is lifted). Both sides are per-key aggregates."""
    sel = filtered.groupBy(key).agg(F.count(F.lit(1)).alias("total_sejours"), _rate().alias("taux_readmission"))
    allk = full.groupBy(key).agg(_rate().alias("taux_readmission_sans_filtre"))
    return sel.join(broadcast_if_small(allk), key, "left")


def ordered(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Total order for reports (a range-partitioned sort; use on aggregated results)."""
    return df.orderBy(*keys)


def top_k(df: DataFrame, by: str | Column, k: int, descending: bool = True, magnitude: bool = False, ties: Sequence[str | Column] = ()) -> DataFrame:
    """The k first rows by ``by`` (optionally by absolute value), equal ones in the order of ``ties``. Spark plans this as a
    TakeOrderedAndProject: each task keeps its own k best, only k·tasks rows meet at the end."""
    c = F.col(by) if isinstance(by, str) else by
    c = F.abs(c) if magnitude else c
    return df.orderBy(c.desc() if descending else c.asc(), *ties).limit(k)


def numbered(report: DataFrame, name: str = "rang") -> DataFrame:
    """An ordered report (a bounded, aggregated table) with its row numbers from 1, so that order is part of the result.

    The rows are numbered as they lie: by partition, then by place, from one small count per partition.
    """
    placed = materialize(report.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    first = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = placed.join(F.broadcast(first), part == F.col("_part"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn(name, (F.col("_before") + place + 1).cast("int")).drop("_at", "_part", "_n", "_before")
