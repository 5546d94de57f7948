"""All 51 BI measures by name, for any group set.

Each measure has a grain. A grain's measures come from one aggregate of the stays:

- ``row``: counts, rates, labels and the confusion matrix of the group's stays (``measures.derive_measures``);
- ``pathology``: the group's stays per pathology, against all stays;
- ``calendar``: stays per day, dealt to the periods they count for (last year, last month, year to date, 30 days);
- ``services``: the group's stays per service;
- ``percentile``: exact order statistics of the score.

Only the grains that the asked names need are computed. Their tables (a row per group) are put together by a
union and one more aggregate, so null groups are groups like any other, the empty group set is one row, and
no join is made.

A group set may hold ``annee_admission``, alone or with ``mois_admission``: then a row's period is that year or
month. Otherwise its period is the whole calendar up to ``as_of`` (by default the last admission date). Rows are
those groups that hold stays. A measure over no stays is 0, null under ``null_on_empty``; trends read "N/A" only then.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.operators import measures as M

YEAR, MONTH = "annee_admission", "mois_admission"

# Grain of every measure that is not a plain row aggregate.
PATHOLOGY = ["taux_readmission_pathologie", "ecart_vs_moyenne_globale_pp", "rang_pathologie", "pathologie_plus_risquee"]
CALENDAR = ["taux_readmission_annee_precedente", "delta_taux_vs_annee_precedente_pp", "icone_tendance_annee", "taux_readmission_ytd",
            "readmissions_30j_glissants", "sejours_annee_precedente", "taux_readmission_mois_precedent", "delta_taux_vs_mois_precedent"]
SERVICES = ["services_au_dessus_seuil"]
PERCENTILE = ["separation_scores_ks_approx"]


def row_names() -> list[str]:
    """The measures of the row grain, in their order."""
    return list(M.MEASURE_COLUMNS)


def all_names() -> list[str]:
    return [*row_names(), *PATHOLOGY, *CALENDAR, *SERVICES, *PERCENTILE]


def grain(name: str) -> str:
    """The grain of a measure; KeyError for a name that is none."""
    grains = {"row": row_names(), "pathology": PATHOLOGY, "calendar": CALENDAR, "services": SERVICES, "percentile": PERCENTILE}
    for g, names in grains.items():
        if name in names:
            return g
    raise KeyError(f"no such measure: {name}")


def _per(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.count_if(F.col("readmission_30j") == 1).alias("_r")]


def _ratio(null_on_empty: bool):
    return lambda num, den: M.ratio(num, den, null_on_empty)


def _pathology(df: DataFrame, group_by: Sequence[str], null_on_empty: bool, key: str = "pathologie") -> DataFrame:
    """The four pathology measures of each group.

    The pathology rate drops every filter but the one on the pathology; the rank of the group's rate is dense, among
    the pathologies under the group's other filters; ties of the riskiest pathology are all named, in order.
    """
    r = _ratio(null_on_empty)
    other = [c for c in group_by if c != key]
    per = df.groupBy(*other, key).agg(*_counts())
    # windows over the aggregated table (a row per group and pathology), not over stays
    here, same, everyone = Window.partitionBy(*other), Window.partitionBy(key), per.agg(F.sum("_n").alias("n"), F.sum("_r").alias("r"))
    whole = everyone.select(r("r", "n")).scalar()
    per = per.select(*other, key, "_n", "_r", r("_r", "_n").alias("_rate"),
                     r(F.sum("_r").over(same), F.sum("_n").over(same)).alias("_alone"))
    if key in group_by:
        return per.select(*group_by, F.col("_alone").alias("taux_readmission_pathologie"), ((F.col("_rate") - whole) * 100).alias("ecart_vs_moyenne_globale_pp"),
                          F.dense_rank().over(here.orderBy(F.desc("_rate"))).alias("rang_pathologie"), F.col(key).alias("pathologie_plus_risquee"))
    seen = per.select("*", r(F.sum("_r").over(here), F.sum("_n").over(here)).alias("_own"), F.max("_alone").over(here).alias("_most"))
    out = _per(seen, other, F.max("_own").alias("_own"), F.count_distinct(F.when(F.col("_rate") > F.col("_own"), F.col("_rate"))).alias("_above"),
               F.array_join(F.array_sort(F.collect_set(F.when(F.col("_alone") == F.col("_most"), F.col(key)))), ", ").alias("pathologie_plus_risquee"))
    return out.select(*group_by, F.lit(whole).alias("taux_readmission_pathologie"), ((F.col("_own") - whole) * 100).alias("ecart_vs_moyenne_globale_pp"),
                      (F.col("_above") + 1).cast("int").alias("rang_pathologie"), "pathologie_plus_risquee")


_PERIODS = ["annee", "mois", "ytd", "jours"]


def _dealt(group_by: Sequence[str], days: int) -> Column:
    """The (year, month, kind) of every period that a day's stays count for; a few of each."""
    d = F.col("_d")
    i = C.month_index(F.year(d), F.month(d))
    one = lambda month, kind: F.struct((F.floor((month - 1) / 12)).cast("int").alias("y"), ((month - 1) % 12 + 1).cast("int").alias("m"),
                                       F.lit(kind).alias("kind"))
    last_day = lambda month: F.last_day(F.make_date(F.floor((month - 1) / 12).cast("int"), ((month - 1) % 12 + 1).cast("int"), F.lit(1)))
    if MONTH in group_by:
        rest_of_year = F.transform(F.sequence(F.month(d), F.lit(12)), lambda m: one(i - F.month(d) + m, "ytd"))
        rolling = F.transform(F.filter(F.array(i, i + 1), lambda m: F.datediff(last_day(m), d) < days), lambda m: one(m, "jours"))
        return F.concat(F.array(one(i + 12, "annee"), one(i + 1, "mois")), rest_of_year, rolling)
    if YEAR in group_by:
        rolling = F.filter(F.array(one(i, "jours")), lambda _: F.datediff(F.make_date(F.year(d), F.lit(12), F.lit(31)), d) < days)
        return F.concat(F.array(one(i + 12, "annee"), one(i + 1, "mois"), one(i, "ytd")), rolling)
    end = F.col("_end")
    kept = {"annee": d <= F.add_months(end, -12), "mois": d <= F.add_months(end, -1), "ytd": (F.year(d) == F.year(end)) & (d <= end),
            "jours": (d > F.date_sub(end, days)) & (d <= end)}
    return F.filter(F.array(*[F.when(cond, one(i, kind)) for kind, cond in kept.items()]), lambda p: p.isNotNull())


def _calendar(df: DataFrame, group_by: Sequence[str], date_col: str, as_of: str | None, days: int) -> DataFrame:
    """Stays and readmissions of each period that a group looks at, as columns ``_n_<kind>`` and ``_r_<kind>``.

    Stays are first counted per day; each day is then dealt to the few periods it counts for and summed with a
    map-side combine, so nothing is joined by date ranges.
    """
    if MONTH in group_by and YEAR not in group_by:
        raise ValueError(f"{MONTH} needs {YEAR} beside it: a month without its year is no period")
    other = [c for c in group_by if c not in (YEAR, MONTH)]
    daily = df.where(F.col(date_col).isNotNull()).groupBy(*other, F.col(date_col).alias("_d")).agg(*_counts())
    if YEAR not in group_by:
        daily = daily.withColumn("_end", F.lit(as_of).cast("date") if as_of else df.agg(F.max(date_col)).scalar())
    dealt = daily.select(*other, "_n", "_r", F.explode(_dealt(group_by, days)).alias("_p"))
    period = [F.col("_p.y").alias(YEAR)] if YEAR in group_by else []
    period += [F.col("_p.m").alias(MONTH)] if MONTH in group_by else []
    sums = [F.sum(F.when(F.col("_p.kind") == k, F.col(c))).alias(f"{c}_{k}") for k in _PERIODS for c in ("_n", "_r")]
    out = dealt.groupBy(*other, *period).agg(*sums) if other or period else dealt.agg(*sums)
    return out.select(*[F.col(c).cast(df.schema[c].dataType).alias(c) for c in group_by], *[f"{c}_{k}" for k in _PERIODS for c in ("_n", "_r")])


def _calendar_measures(null_on_empty: bool) -> dict[str, Column]:
    r = _ratio(null_on_empty)
    n = {k: F.coalesce(f"_n_{k}", F.lit(0)) for k in _PERIODS}
    y = {k: F.coalesce(f"_r_{k}", F.lit(0)) for k in _PERIODS}
    now = r("_r_now", "_n_now")
    delta = (now - r(y["annee"], n["annee"])) * 100
    return {
        "taux_readmission_annee_precedente": r(y["annee"], n["annee"]),
        "delta_taux_vs_annee_precedente_pp": delta,
        "icone_tendance_annee": C.trend_label(delta),
        "taux_readmission_ytd": r(y["ytd"], n["ytd"]),
        "readmissions_30j_glissants": y["jours"],
        "sejours_annee_precedente": n["annee"],
        "taux_readmission_mois_precedent": r(y["mois"], n["mois"]),
        "delta_taux_vs_mois_precedent": now - r(y["mois"], n["mois"]),
    }


def by_name(df: DataFrame, group_by: Sequence[str] = (), names: Sequence[str] | None = None, null_on_empty: bool = False,
            date_col: str = "date_admission", as_of: str | None = None, threshold: float = 0.20, days: int = 30) -> DataFrame:
    """The named measures (all 51 by default) per group of ``group_by``, one row for each group that holds stays.

    An empty input gives no row for a group set, and one row of zeros (or nulls) for the empty set.
    """
    group_by, names = list(group_by), list(names or all_names())
    grains = {grain(n) for n in names}
    base = M.base_counts(df, group_by)
    parts = [M.derive_measures(base, group_by, null_on_empty).withColumn("_n_now", F.col("total_sejours"))
             .withColumn("_r_now", F.col("total_readmissions")).withColumn("_here", F.lit(True))]
    if "pathology" in grains:
        parts.append(_pathology(df, group_by, null_on_empty))
    if "calendar" in grains:
        parts.append(_calendar(df, group_by, date_col, as_of, days))
    if "services" in grains:
        per = _per(df, list(dict.fromkeys([*group_by, "service"])), *_counts()).select(
            *group_by, C.safe_ratio("_r", "_n").alias("_rate"))
        parts.append(_per(per, group_by, F.count_if(F.col("_rate") >= threshold).alias("services_au_dessus_seuil")))
    if "percentile" in grains:
        parts.append(M.ks_approx(df, group_by=group_by).select(*group_by, F.col("ks_approx_label").alias("separation_scores_ks_approx")))
    # each value stands in one part only: max takes it, and a group that is in no part's rows but a shifted period's goes
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = _per(both, group_by, *[F.max(c).alias(c) for c in both.columns if c not in group_by]).where("_here")
    shifted = _calendar_measures(null_on_empty) if "calendar" in grains else {}
    return merged.select(*group_by, *[shifted[n].alias(n) if n in shifted else F.col(n) for n in names])
