"""Row-level access filters by role (management, department, analyst, physician)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.plans.joins import broadcast_if_small

ALL_ROWS_ROLES = {"Direction_Hopital"}
SERVICE_ROLES = {"Responsable_Service", "Medecin_Traitant"}
ANALYST_ROLES = {"Analyste_Risques"}
ANALYST_MIN_SCORE = 0.40


def row_level_filter(df: DataFrame, users: DataFrame, user_name: str, role: str,
                     score_col: str = "score_risque_modele") -> DataFrame:
    """Rows visible to ``user_name`` acting as ``role``.

    Whatever the role, a user who is not mapped to it sees nothing. Department roles keep the rows of
    the user's services through a left-semi join with the user's mapping rows (a handful of rows,
    broadcast after a size check). Where ``df`` is a table partitioned by service, only the user's folders are read.
    """
    mine = users.where((F.col("user_name") == user_name) & (F.col("role") == role))
    mapped = mine.agg(F.count(F.lit(1))).scalar() > 0
    if role in ALL_ROWS_ROLES:
        return df.where(mapped)
    if role in ANALYST_ROLES:
        return df.where((F.col(score_col) >= ANALYST_MIN_SCORE) & mapped)
    if role in SERVICE_ROLES:
        # the role is chosen above the stored rows of the user: a filter there is what lets the join prune partitions
        theirs = broadcast_if_small(users.where(F.col("user_name") == user_name).select("role", "service"))
        return df.join(theirs.where(F.col("role") == role).select("service"), "service", "left_semi")
    raise ValueError(f"unknown role {role!r}")


def visible_counts(df: DataFrame, users: DataFrame, score_col: str = "score_risque_modele") -> DataFrame:
    """Stays and readmissions visible to every mapped user, in one pass per role family.

    Department users: the per-service aggregate (one row per service) joined to the
    mapping, never a join of the raw rows with the users.
    """
    per_service = df.groupBy("service").agg(F.count(F.lit(1)).alias("sejours_visibles"),
                                             F.count_if(F.col("readmission_30j") == 1).alias("readmissions_visibles"))
    svc_users = users.where(F.col("role").isin(*SERVICE_ROLES))
    by_service = (svc_users.join(broadcast_if_small(per_service), "service", "left")
                  .groupBy("user_name", "role")
                  .agg(F.coalesce(F.sum("sejours_visibles"), F.lit(0)).cast("bigint").alias("sejours_visibles"),
                       F.coalesce(F.sum("readmissions_visibles"), F.lit(0)).cast("bigint").alias("readmissions_visibles")))
    totals = df.agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("readmission_30j") == 1).alias("r_all"),
                    F.count_if(F.col(score_col) >= ANALYST_MIN_SCORE).alias("n_an"),
                    F.count_if((F.col(score_col) >= ANALYST_MIN_SCORE) & (F.col("readmission_30j") == 1)).alias("r_an"))
    fixed = users.where(F.col("role").isin(*(ALL_ROWS_ROLES | ANALYST_ROLES))).select("user_name", "role")
    # four totals as scalar subqueries (merged by the optimizer into one scan of df)
    t = {c: totals.select(c).scalar() for c in ["n_all", "r_all", "n_an", "r_an"]}
    is_all = F.col("role").isin(*ALL_ROWS_ROLES)
    fixed = fixed.select("user_name", "role",
                         F.when(is_all, t["n_all"]).otherwise(t["n_an"]).cast("bigint").alias("sejours_visibles"),
                         F.when(is_all, t["r_all"]).otherwise(t["r_an"]).cast("bigint").alias("readmissions_visibles"))
    return by_service.unionByName(fixed)
