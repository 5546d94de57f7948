"""Time intelligence on a calendar: prior year / prior month, year-to-date, rolling days.

Facts are first aggregated per day or month (a table bounded by the calendar span, not by
the stays); shifts are self-joins on a month index, so missing months are handled
explicitly; windows then run over that small calendar-sized table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestay.functions import columns as C
from carestay.sources.reference import calendar_for


def _counts():
    return [F.count(F.lit(1)).alias("sejours"), F.count_if(F.col("readmission_30j") == 1).alias("readmissions")]


def daily(df: DataFrame, date_col: str = "date_admission", group_by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_by, F.col(date_col).alias("date")).agg(*_counts())


def monthly(df: DataFrame, date_col: str = "date_admission", group_by: Sequence[str] = ()) -> DataFrame:
    d = F.col(date_col)
    return (df.groupBy(*group_by, F.year(d).alias("year"), F.month(d).alias("month")).agg(*_counts())
            .withColumn("month_index", C.month_index("year", "month")))


def daily_on_calendar(df: DataFrame, date_col: str = "date_admission") -> DataFrame:
    """Every calendar day of the covered years with its stay and readmission counts (0 if none)."""
    cal = calendar_for(df, date_col)
    d = daily(df, date_col)
    # both sides are bounded by the calendar (days), so the join is small
    return (cal.join(d, "date", "left")
            .select("date", "year", "month", "month_index", "day_number",
                    F.coalesce("sejours", F.lit(0)).alias("sejours"),
                    F.coalesce("readmissions", F.lit(0)).alias("readmissions")))


def period_shift_join(periods: DataFrame, months: int, group_by: Sequence[str] = (), suffix: str = "_prev") -> DataFrame:
    """Each period with the counts of the period ``months`` earlier (0 when absent)."""
    prev = periods.select(*group_by, (F.col("month_index") + months).alias("month_index"),
                          F.col("sejours").alias("sejours" + suffix), F.col("readmissions").alias("readmissions" + suffix))
    prev = prev.select(F.col("month_index").alias("_m"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group_by)],
                       "sejours" + suffix, "readmissions" + suffix)
    # a null group is a group like any other
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group_by)],
                  F.col("month_index") == F.col("_m"))
    j = periods.join(prev, same, "left").drop("_m", *[f"_g{i}" for i in range(len(group_by))])
    return (j.withColumn("sejours" + suffix, F.coalesce(F.col("sejours" + suffix), F.lit(0)))
            .withColumn("readmissions" + suffix, F.coalesce(F.col("readmissions" + suffix), F.lit(0))))


def prior_year(df: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Per month: rate, same month last year, delta in pp and its trend label, prior-year stays."""
    j = period_shift_join(monthly(df, group_by=group_by), 12, group_by)
    rate = C.safe_ratio("readmissions", "sejours")
    prev = C.safe_ratio("readmissions_prev", "sejours_prev")
    delta = (rate - prev) * 100
    return j.select(*group_by, "year", "month", "sejours", rate.alias("taux_readmission"),
                    prev.alias("taux_annee_precedente"), delta.alias("delta_pp"),
                    C.trend_label(delta).alias("tendance"), F.col("sejours_prev").alias("sejours_annee_precedente"))


def prior_month(df: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    j = period_shift_join(monthly(df, group_by=group_by), 1, group_by)
    rate = C.safe_ratio("readmissions", "sejours")
    prev = C.safe_ratio("readmissions_prev", "sejours_prev")
    return j.select(*group_by, "year", "month", rate.alias("taux_readmission"),
                    prev.alias("taux_mois_precedent"), (rate - prev).alias("delta_mois"))


def period_deltas(periods: DataFrame) -> DataFrame:
    """Year delta in pp and month delta (raw) from a frame that has both shifted rates."""
    return periods.select("*", ((F.col("taux_readmission") - F.col("taux_annee_precedente")) * 100).alias("delta_annee_pp"),
                          (F.col("taux_readmission") - F.col("taux_mois_precedent")).alias("delta_mois"))


def ytd_rate(df: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Per month: readmissions and stays accumulated since January of the same year."""
    m = monthly(df, group_by=group_by)
    w = Window.partitionBy(*group_by, "year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    cs, cr = F.sum("sejours").over(w), F.sum("readmissions").over(w)
    return m.select(*group_by, "year", "month", cs.alias("sejours_ytd"), cr.alias("readmissions_ytd"),
                    C.safe_ratio(cr, cs).alias("taux_readmission_ytd"))


def rolling_readmissions(df: DataFrame, days: int = 30, date_col: str = "date_admission") -> DataFrame:
    """Per calendar day d: readmissions admitted in [d - days + 1, d]."""
    cal = daily_on_calendar(df, date_col)
    # one ordered window over the calendar-day table (≤ 366 rows per year), not over stays
    w = Window.orderBy("day_number").rangeBetween(-(days - 1), 0)
    return cal.select("date", F.sum("readmissions").over(w).alias(f"readmissions_{days}j"),
                      F.sum("sejours").over(w).alias(f"sejours_{days}j"))


def rolling_as_of(df: DataFrame, as_of: str | None = None, days: int = 30,
                  date_col: str = "date_admission") -> DataFrame:
    """One row: readmissions in the ``days`` days ending at ``as_of`` (default: last fact date)."""
    d = F.col(date_col)
    end = F.lit(as_of).cast("date") if as_of else df.agg(F.max(date_col)).scalar()
    start = F.date_sub(end, days - 1)
    # the date range is a filter, so it can prune the scan
    return df.where((d >= start) & (d <= end)).agg(F.count_if((F.col("readmission_30j") == 1)).alias(f"readmissions_{days}j"))
