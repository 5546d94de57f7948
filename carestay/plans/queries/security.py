"""Registered queries: row-level security."""

from __future__ import annotations

from carestay.operators import measures as M
from carestay.operators import security as SEC
from carestay.plans import oracle_sql as O
from carestay.plans.layers import gold_by_service
from carestay.plans.registry import register
from carestay.sources.reference import users_by_service
from carestay.plans.queries.common import measure_base


_USERS_SQL = """svc AS (SELECT DISTINCT service FROM mb WHERE service IS NOT NULL),
users AS (
  SELECT 'resp.' || regexp_replace(lower(service), '[^\\p{L}\\p{N}]+', '_', 'g') AS user_name, 'Responsable_Service' AS role, service FROM svc
  UNION ALL SELECT 'dr.' || regexp_replace(lower(service), '[^\\p{L}\\p{N}]+', '_', 'g'), 'Medecin_Traitant', service FROM svc
  UNION ALL SELECT 'direction', 'Direction_Hopital', NULL
  UNION ALL SELECT 'analyste', 'Analyste_Risques', NULL)"""


@register("row_level_service", O.with_ctes(O.BASE + [O.MB, _USERS_SQL], """
SELECT patient_id, service, readmission_30j FROM mb
WHERE service IN (SELECT service FROM users WHERE user_name = 'resp.cardiologie' AND role = 'Responsable_Service')"""))
def q_row_level_service(spark, sf):
    mb = M.measure_base(gold_by_service(spark, sf))
    users = users_by_service(mb)
    return SEC.row_level_filter(mb, users, "resp.cardiologie", "Responsable_Service").select(
        "patient_id", "service", "readmission_30j")


@register("row_level_analyst", O.with_ctes(O.BASE + [O.MB], """
SELECT patient_id, service, score_risque_modele FROM mb WHERE score_risque_modele >= 0.40"""))
def q_row_level_analyst(spark, sf):
    mb = measure_base(spark, sf)
    return SEC.row_level_filter(mb, users_by_service(mb), "analyste", "Analyste_Risques").select(
        "patient_id", "service", "score_risque_modele")


@register("rls_visible_counts", O.with_ctes(O.BASE + [O.MB, _USERS_SQL], """
SELECT u.user_name, u.role,
  CAST(CASE WHEN u.role = 'Direction_Hopital' THEN (SELECT count(*) FROM mb)
       WHEN u.role = 'Analyste_Risques' THEN (SELECT count(*) FROM mb WHERE score_risque_modele >= 0.40)
       ELSE (SELECT count(*) FROM mb WHERE mb.service = u.service) END AS BIGINT) AS sejours_visibles,
  CAST(CASE WHEN u.role = 'Direction_Hopital' THEN (SELECT count(*) FROM mb WHERE readmission_30j = 1)
       WHEN u.role = 'Analyste_Risques' THEN (SELECT count(*) FROM mb WHERE score_risque_modele >= 0.40 AND readmission_30j = 1)
       ELSE (SELECT count(*) FROM mb WHERE mb.service = u.service AND readmission_30j = 1) END AS BIGINT) AS readmissions_visibles
FROM users u"""))
def q_rls_visible_counts(spark, sf):
    mb = measure_base(spark, sf)
    return SEC.visible_counts(mb, users_by_service(mb))
