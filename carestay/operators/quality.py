"""Declarative data-quality checks.

``run_expectations(df, suite)`` evaluates every row-level check of a suite in ONE
aggregate (a ``count_if`` per check) and all uniqueness checks as one keyed
aggregate with one shuffle; the report has one row per check: model, check, column, failing rows, status.
Nulls pass accepted-value and range checks, as in the source's test framework.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestay import schema as S


@dataclass(frozen=True)
class Expectation:
    kind: str                 # not_null | unique | accepted_values | range | date_order | positive | rate_within
    column: str
    values: tuple = field(default_factory=tuple)
    min_value: float | None = None
    max_value: float | None = None
    other: str | None = None  # second column (date_order)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


def expect_not_null(c): return Expectation("not_null", c)
def expect_unique(c): return Expectation("unique", c)
def expect_accepted_values(c, values): return Expectation("accepted_values", c, tuple(values))
def expect_range(c, lo=None, hi=None): return Expectation("range", c, min_value=lo, max_value=hi)
def expect_date_order(start, end): return Expectation("date_order", end, other=start)
def expect_positive(c): return Expectation("positive", c)
def expect_rate_within(c, lo, hi): return Expectation("rate_within", c, min_value=lo, max_value=hi)
def expect_unique_features(c="patient_id"): return Expectation("unique", c)


def _failing(e: Expectation) -> Column:
    c = F.col(e.column)
    if e.kind == "not_null":
        return F.count_if(c.isNull())
    if e.kind == "accepted_values":
        return F.count_if(~c.isin(*e.values))
    if e.kind == "range":
        cond = F.lit(True)
        if e.min_value is not None:
            cond = cond & (c >= e.min_value)
        if e.max_value is not None:
            cond = cond & (c <= e.max_value)
        return F.count_if(~cond)
    if e.kind == "date_order":
        return F.count_if(c < F.col(e.other))
    if e.kind == "positive":
        return F.count_if(c <= 0)
    if e.kind == "rate_within":
        rate = F.avg(c.cast("double"))
        return F.when((rate < e.min_value) | (rate > e.max_value), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    raise ValueError(e.kind)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once (null keys ignored) with their count."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("nb_occurrences"))
            .where(F.col("nb_occurrences") > 1))


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: for each key column, how many of its values are seen more than once (nulls ignored).

    All keys go through one shuffle of (column, value) counts, combined on the map side, so a value that holds a third of
    all rows is one row per task; values are compared whole, not by a hash.
    """
    entries = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("value")) for i, c in enumerate(keys)])
    counts = (df.select(F.explode(entries).alias("e")).where(F.col("e.value").isNotNull())
              .groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    return counts.agg(*[F.count_if((F.col("column") == i) & (F.col("n") > 1)).alias(c) for i, c in enumerate(keys)])


def run_suites(df: DataFrame, suites: Sequence[tuple[str, Sequence[Expectation]]]) -> DataFrame:
    """Several suites over one relation: every row-level check of every suite in ONE aggregate,
    and one keyed aggregate for all uniqueness columns (each shared by the suites that ask)."""
    row_checks = [(m, e) for m, suite in suites for e in suite if e.kind != "unique"]
    key_checks = [(m, e) for m, suite in suites for e in suite if e.kind == "unique"]
    parts = []
    if row_checks:
        agg = df.agg(*[_failing(e).cast("bigint").alias(f"c{i}") for i, (_, e) in enumerate(row_checks)])
        stack = ", ".join(f"'{m}', '{e.kind}', '{e.column}', c{i}" for i, (m, e) in enumerate(row_checks))
        parts.append(agg.selectExpr(f"stack({len(row_checks)}, {stack}) AS (model, check, column, failing_rows)"))
    if key_checks:
        dup = duplicate_counts(df, list(dict.fromkeys(e.column for _, e in key_checks)))
        stack = ", ".join(f"'{m}', '{e.kind}', '{e.column}', `{e.column}`" for m, e in key_checks)
        parts.append(dup.selectExpr(f"stack({len(key_checks)}, {stack}) AS (model, check, column, failing_rows)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "check", "column", "failing_rows",
                      F.when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL").alias("status"))


def run_expectations(df: DataFrame, suite: Sequence[Expectation], model: str = "") -> DataFrame:
    """One suite over one relation (see ``run_suites``)."""
    return run_suites(df, [(model, suite)])


# Suites restating the source's declarative tests (accepted values and bounds are fixed values).
def source_suite() -> list[Expectation]:
    return [expect_not_null("patient_id"), expect_not_null("age"), expect_not_null("readmission_30j"),
            expect_accepted_values("readmission_30j", [0, 1])]


def clean_suite(discharge_modes: Sequence[str] = S.DISCHARGE_MODES_ACCEPTED) -> list[Expectation]:
    return [
        expect_not_null("patient_id"), expect_unique("patient_id"),
        expect_not_null("age"), expect_range("age", 18, 95),
        expect_not_null("sexe"), expect_accepted_values("sexe", S.SEXES),
        expect_not_null("tranche_age"), expect_accepted_values("tranche_age", S.AGE_BRACKETS),
        expect_not_null("pathologie"), expect_not_null("diagnostic_principal"),
        expect_not_null("duree_sejour"), expect_range("duree_sejour", 1, 45),
        expect_not_null("nb_hospitalisations_precedentes"), expect_range("nb_hospitalisations_precedentes", 0, 10),
        expect_not_null("nb_medicaments"), expect_range("nb_medicaments", 0, 20),
        expect_not_null("date_admission"), expect_not_null("date_sortie"),
        expect_not_null("mode_sortie"), expect_accepted_values("mode_sortie", discharge_modes),
        expect_not_null("readmission_30j"), expect_accepted_values("readmission_30j", [0, 1]),
        expect_not_null("flag_polymedication"),
        expect_date_order("date_admission", "date_sortie"), expect_positive("age"),
    ]


def stay_suite() -> list[Expectation]:
    return [expect_not_null("patient_id"), expect_unique("patient_id"),
            expect_not_null("indice_complexite"), expect_range("indice_complexite", 0, 10),
            expect_not_null("duree_zscore_patho"), expect_not_null("ratio_meds_duree"),
            expect_not_null("flag_antecedents_lourds")]


def diagnostic_suite() -> list[Expectation]:
    return [expect_not_null("patient_id"), expect_unique("patient_id"),
            expect_not_null("groupe_clinique"), expect_accepted_values("groupe_clinique", S.CLINICAL_GROUPS),
            expect_not_null("severite_relative"), expect_range("severite_relative", 1, 5),
            expect_not_null("risque_readmission_patho"), expect_accepted_values("risque_readmission_patho", S.RISK_LEVELS),
            expect_not_null("severite_normalisee"), expect_range("severite_normalisee", 0, 1)]


def feature_suite() -> list[Expectation]:
    flags = ["flag_polymedication", "flag_sortie_complexe", "flag_deja_hospitalise", "flag_antecedents_lourds"]
    out = [expect_not_null("patient_id"), expect_unique("patient_id"),
           expect_not_null("readmission_30j"), expect_accepted_values("readmission_30j", [0, 1]),
           expect_not_null("age"), expect_range("age", 18, 95),
           expect_not_null("nb_hospitalisations_precedentes"), expect_range("nb_hospitalisations_precedentes", 0, 10),
           expect_not_null("indice_complexite"), expect_range("indice_complexite", 0, 10),
           expect_not_null("severite_normalisee"), expect_range("severite_normalisee", 0, 1)]
    for f in flags:
        out += [expect_not_null(f), expect_accepted_values(f, [0, 1])]
    out += [expect_not_null("groupe_clinique"), expect_accepted_values("groupe_clinique", S.CLINICAL_GROUPS),
            expect_not_null("tranche_age"), expect_accepted_values("tranche_age", S.AGE_BRACKETS),
            expect_rate_within("readmission_30j", 0.05, 0.40)]
    return out


def kpi_suite() -> list[Expectation]:
    return [expect_not_null("dimension"), expect_accepted_values("dimension", S.KPI_DIMENSIONS),
            expect_not_null("valeur"), expect_not_null("nb_sejours"), expect_range("nb_sejours", 1, None),
            expect_not_null("nb_readmissions"), expect_not_null("taux_readmission"),
            expect_range("taux_readmission", 0, 1), expect_not_null("indice_complexite_moy"),
            expect_range("indice_complexite_moy", 0, 10)]


# Singular tests: each returns its failing rows (an empty result passes).

def date_order_violations(df: DataFrame, key: str = "patient_id") -> DataFrame:
    """Stays discharged before admission, with the computed stay length."""
    return (df.where(F.col("date_sortie") < F.col("date_admission"))
            .select(key, "date_admission", "date_sortie",
                    F.datediff("date_sortie", "date_admission").alias("duree_calculee")))


def non_positive_ages(df: DataFrame, key: str = "patient_id") -> DataFrame:
    """Ages ≤ 0 (a null age is not caught, as in the source test)."""
    return df.where(F.col("age") <= 0).select(key, "age")


def implausible_rate(df: DataFrame, target: str = S.TARGET, lo: float = 0.05, hi: float = 0.40) -> DataFrame:
    """One row holding the global rate when it lies outside [lo, hi]; empty otherwise."""
    return (df.agg(F.avg(F.col(target).cast("double")).alias("taux_global"))
            .where((F.col("taux_global") < lo) | (F.col("taux_global") > hi)))
