"""Scalar Column functions of the stay analytics.

All are compositions of built-in ``pyspark.sql.functions`` so they stay inside
whole-stage codegen. Rounding follows one rule everywhere: pass through
``decimal(38,8)`` and round half away from zero, which reproduces exact decimal
rounding of values that are decimal at heart (rates, means of small integers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from carestay import schema as S

__all__ = [
    "col_", "rnd", "norm_upper", "pg_initcap", "age_bracket", "stay_length_bucket", "season",
    "month_key", "month_index", "day_of_week_sun0", "complexity_index", "meds_per_day",
    "prior_flags", "classify_risk", "risk_tier_cut", "safe_ratio", "clamp", "flag_to_int",
    "stay_days", "discharge_date", "additive_scorecard", "pct_label", "number_label",
    "signed_label", "trend_label", "threshold_label", "odds_ratio", "is_uuid", "coalesce_false",
    "SCORECARD_RULES",
]

UUID_PATTERN = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: Column | str, digits: int) -> Column:
    """Round half away from zero through decimal(38,8); result is double."""
    return F.round(col_(c).cast("decimal(38,8)"), digits).cast("double")


def coalesce_false(cond: Column) -> Column:
    """SQL ``CASE WHEN cond THEN TRUE ELSE FALSE END``: unknown counts as false."""
    return F.coalesce(cond, F.lit(False))


def norm_upper(c: Column | str) -> Column:
    return F.upper(F.trim(col_(c)))


# a separator is any character that is neither a letter, a digit nor the plain space
_SEP = r"([^\p{L}\p{N} ])"


def pg_initcap(c: Column | str) -> Column:
    """Word capitalisation where a word is a maximal run of letters/digits.

    ``F.initcap`` only splits on spaces, so a space is inserted after every other
    separator, ``initcap`` is applied, and the inserted spaces are removed again:
    ``Île-de-france`` becomes ``Île-De-France``. Three codegen'd string functions, no
    higher-order function.
    """
    spaced = F.regexp_replace(col_(c), _SEP, "$1 ")
    return F.regexp_replace(F.initcap(spaced), _SEP + " ", "$1")


def age_bracket(age: Column | str) -> Column:
    a = col_(age)
    return (F.when(a.between(18, 44), "18-44").when(a.between(45, 64), "45-64")
            .when(a.between(65, 74), "65-74").when(a.between(75, 84), "75-84")
            .when(a >= 85, "85+").otherwise(S.UNKNOWN_LABEL))


def stay_length_bucket(los: Column | str) -> Column:
    d = col_(los)
    b = S.STAY_BUCKETS
    return (F.when(d.between(1, 3), b[0]).when(d.between(4, 7), b[1])
            .when(d.between(8, 14), b[2]).when(d > 14, b[3]).otherwise(S.UNKNOWN_LABEL))


def season(month: Column | str) -> Column:
    m = col_(month)
    out = None
    for label, months in S.SEASONS.items():
        out = F.when(m.isin(months), label) if out is None else out.when(m.isin(months), label)
    return out  # no otherwise: an unknown month stays null


def month_key(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM``; like the source's CONCAT, null parts vanish (a null date gives ``-``)."""
    return F.concat_ws("", col_(year).cast("string"), F.lit("-"), F.lpad(col_(month).cast("string"), 2, "0"))


def month_index(year: Column | str, month: Column | str) -> Column:
    return col_(year) * 12 + col_(month)


def day_of_week_sun0(d: Column | str) -> Column:
    """Day of week with 0 = Sunday."""
    return F.dayofweek(col_(d)) - 1


def complexity_index(los: Column | str, meds: Column | str, prior: Column | str) -> Column:
    """Capped weighted sum in [0, 10]: stay 35 %, medications 30 %, prior stays 35 %.

    ``least`` skips nulls, so a null input counts at its cap, as in the source.
    """
    raw = (F.least(col_(los), F.lit(30)).cast("double") / F.lit(30.0) * F.lit(3.5)
           + F.least(col_(meds), F.lit(15)).cast("double") / F.lit(15.0) * F.lit(3.0)
           + F.least(col_(prior), F.lit(5)).cast("double") / F.lit(5.0) * F.lit(3.5))
    return F.least(F.lit(10.0), rnd(raw, 2))


def meds_per_day(meds: Column | str, los: Column | str) -> Column:
    d = col_(los)
    return F.when(d > 0, rnd(col_(meds).cast("double") / d, 4)).otherwise(F.lit(0.0))


def prior_flags(prior: Column | str, los: Column | str) -> list[Column]:
    p, d = col_(prior), col_(los)
    return [coalesce_false(p >= 3).alias("flag_antecedents_lourds"),
            coalesce_false(p >= 1).alias("flag_deja_hospitalise"),
            coalesce_false(d >= 14).alias("flag_long_sejour")]


def classify_risk(score: Column | str) -> Column:
    """Left-closed tiers; a null score falls to the last tier."""
    s = col_(score)
    return (F.when(s >= 0.70, "Eleve").when(s >= 0.40, "Modere")
            .when(s >= 0.20, "Faible").otherwise("Tres faible"))


def risk_tier_cut(score: Column | str) -> Column:
    """Right-closed tiers (0,.2] (.2,.4] (.4,.7] (.7,1]; anything outside is null."""
    s = col_(score)
    return (F.when((s > 0.0) & (s <= 0.20), "Tres faible").when((s > 0.20) & (s <= 0.40), "Faible")
            .when((s > 0.40) & (s <= 0.70), "Modere").when((s > 0.70) & (s <= 1.0), "Eleve"))


def safe_ratio(num: Column | str, den: Column | str, default: float | Column = 0) -> Column:
    d = col_(den)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return F.when(d.isNull() | (d == 0), dflt.cast("double")).otherwise(col_(num).cast("double") / d)


def clamp(c: Column | str, lo, hi) -> Column:
    return F.least(F.greatest(col_(c), F.lit(lo)), F.lit(hi))


def flag_to_int(c: Column | str) -> Column:
    return col_(c).cast("int")


def stay_days(admit: Column | str, discharge: Column | str) -> Column:
    return F.datediff(col_(discharge), col_(admit))


def discharge_date(admit: Column | str, los: Column | str) -> Column:
    return F.date_add(col_(admit), col_(los).cast("int"))


# The readmission scorecard of the source generator, in points of 0.01.
# base 10, clamp to [5, 85]; conditions on (age, prior stays, medications, stay, discharge, pathology).
SCORECARD_RULES = [
    ("age > 70", 12),
    ("age > 80", 8),
    ("nb_hospitalisations_precedentes >= 2", 15),
    ("nb_hospitalisations_precedentes >= 4", 10),
    ("nb_medicaments >= 8", 8),
    ("duree_sejour >= 10", 6),
    ("upper(mode_sortie) IN ('SSR', 'EHPAD')", 7),
    ("pathologie = 'Sepsis'", 12),
    ("pathologie = 'Insuffisance cardiaque'", 8),
]


def additive_scorecard(rules: Sequence[tuple[str | Column, int]] = SCORECARD_RULES, base: int = 10,
                       lo: int = 5, hi: int = 85, scale: float = 100.0) -> Column:
    """Base points plus conditional increments, clamped, divided once by ``scale``.

    Integer points keep the sum exact; the single division gives the 4-digit score.
    """
    total = F.lit(base)
    for cond, pts in rules:
        c = F.expr(cond) if isinstance(cond, str) else cond
        total = total + F.when(c, F.lit(pts)).otherwise(F.lit(0))
    return rnd(clamp(total, lo, hi).cast("double") / F.lit(scale), 4)


def _fmt(c: Column, decimals: int, flag: str = "", suffix: str = "") -> Column:
    """Fixed-decimal text; rounds half away from zero first so formatting never re-rounds."""
    v = F.round(c.cast("decimal(38,8)"), decimals).cast("double")
    # format_string would print a null as text
    return F.when(v.isNotNull(), F.format_string(f"%{flag}.{decimals}f{suffix}", v))


def pct_label(c: Column | str, decimals: int = 1) -> Column:
    """``0.0%`` style text of a ratio."""
    return _fmt(col_(c) * 100, decimals, suffix="%%")


def number_label(c: Column | str, decimals: int = 3) -> Column:
    return _fmt(col_(c), decimals)


def signed_label(c: Column | str, decimals: int = 1) -> Column:
    return _fmt(col_(c), decimals, flag="+")


def trend_label(delta: Column | str, band: float = 0.5) -> Column:
    """Year-over-year trend text of a delta in percentage points."""
    d = col_(delta)
    absd = _fmt(F.abs(d), 1)
    return (F.when(d.isNull(), "N/A")
            .when(d > band, F.concat(F.lit("up +"), absd, F.lit("pp")))
            .when(d < -band, F.concat(F.lit("down "), absd, F.lit("pp")))
            .otherwise(F.concat(F.lit("stable "), signed_label(d, 1), F.lit("pp"))))


def threshold_label(c: Column | str, bands: Sequence[tuple[float, str]], default: str,
                    strict: bool = False) -> Column:
    """First matching band wins (``>=`` bound, or ``>`` when ``strict``)."""
    x = col_(c)
    out = None
    for bound, label in bands:
        cond = (x > bound) if strict else (x >= bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default)


def odds_ratio(coef: Column | str) -> Column:
    return F.exp(col_(coef))


def is_uuid(c: Column | str) -> Column:
    return col_(c).rlike(UUID_PATTERN)
