import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestay.operators import measures as M
from carestay.operators import model as MD
from carestay.operators import stats as ST
from carestay.plans import ranking
from carestay.plans.joins import materialize
from carestay.plans.ranking import running_totals
from tests.test_plans import physical_plan


def test_running_totals_equal_brute_force(spark):
    rnd = random.Random(1)
    rows = [(g, float(rnd.randint(0, 300)), rnd.randint(1, 5)) for g in ("a", "b") for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, v double, n int").groupBy("g", "v").agg(F.sum("n").alias("n"))
    got = {(r.g, r.v): (r.cum_n, r.tot_n) for r in running_totals(df, ["v"], ["n"], ["g"], 8).collect()}
    for g in ("a", "b"):
        agg = {}
        for gg, v, n in rows:
            if gg == g:
                agg[v] = agg.get(v, 0) + n
        tot, cum = sum(agg.values()), 0
        for v in sorted(agg):
            cum += agg[v]
            assert got[(g, v)] == (cum, tot)


def test_exact_percentiles_match_numpy(spark):
    rnd = random.Random(2)
    vals = [rnd.choice([0.1, 0.25, 0.3, 0.55, 0.9]) + rnd.random() * (i % 3) for i in range(997)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = M.exact_percentiles(df, "v", [0.1, 0.5, 0.9]).first()
    for p, got in zip([10, 50, 90], [r.p10, r.p50, r.p90]):
        assert math.isclose(got, float(np.percentile(vals, p)), rel_tol=1e-12)


def test_auc_by_rank_equals_pair_count_with_ties(spark):
    data = [(0.2, 0), (0.2, 1), (0.5, 0), (0.5, 1), (0.5, 1), (0.7, 0), (0.9, 1), (0.1, 0)]
    pairs = [(a, b) for a in data if a[1] == 1 for b in data if b[1] == 0]
    brute = sum(1.0 if a[0] > b[0] else 0.5 if a[0] == b[0] else 0.0 for a, b in pairs) / len(pairs)
    df = spark.createDataFrame(data, "score_risque_modele double, readmission_30j int")
    assert math.isclose(MD.exact_auc(df, buckets=3).first().auc, brute)


def test_mann_whitney_and_kruskal_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(18, 30), rnd.randint(0, 1), rnd.choice("abc")) for _ in range(300)]
    df = spark.createDataFrame(rows, "age int, readmission_30j int, pathologie string")
    x0 = [a for a, y, _ in rows if y == 0]
    x1 = [a for a, y, _ in rows if y == 1]
    u0 = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in x0 for b in x1)
    got = ST.mann_whitney_u(df, ["age"]).first()
    assert math.isclose(got.u_statistic, u0)
    # Kruskal-Wallis with average ranks
    allv = sorted(a for a, _, _ in rows)
    rank = {}
    for v in set(allv):
        idx = [i + 1 for i, x in enumerate(allv) if x == v]
        rank[v] = sum(idx) / len(idx)
    n = len(rows)
    h = 12 / (n * (n + 1)) * sum(sum(rank[a] for a, _, g in rows if g == grp) ** 2 / sum(1 for *_, g in rows if g == grp)
                                 for grp in "abc") - 3 * (n + 1)
    ties = sum(allv.count(v) ** 3 - allv.count(v) for v in set(allv))
    h /= 1 - ties / (n ** 3 - n)
    assert math.isclose(ST.kruskal_h(df).first().h, h, rel_tol=1e-9)


def test_chi2_tail_closed_form():
    # reference points of the χ² upper tail
    assert math.isclose(ST.chi2_sf_scalar(3.841458820694124, 1), 0.05, rel_tol=1e-9)
    assert math.isclose(ST.chi2_sf_scalar(5.991464547107979, 2), 0.05, rel_tol=1e-9)
    assert math.isclose(ST.chi2_sf_scalar(7.814727903251178, 3), 0.05, rel_tol=1e-9)
    assert math.isclose(ST.chi2_sf_scalar(14.067140449340169, 7), 0.05, rel_tol=1e-9)


def test_yates_correction_on_2x2(spark):
    rows = [("M", 1)] * 10 + [("M", 0)] * 20 + [("F", 1)] * 20 + [("F", 0)] * 15
    df = spark.createDataFrame(rows, "sexe string, readmission_30j int")
    got = ST.chi_square_stat(df, ["sexe"]).first()
    obs = np.array([[10, 20], [20, 15]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    chi = (((np.abs(obs - exp) - 0.5) ** 2) / exp).sum()
    assert got.dof == 1 and math.isclose(got._chi2_raw, chi)


def test_normality_rejects_skewed_and_accepts_normal(spark):
    rs = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rs.normal(size=2000), rs.exponential(size=2000))],
                               "nrm double, expo double")
    r = {x.feature: x for x in ST.normality_test(df, ["nrm", "expo"]).collect()}
    assert r["expo"].normal == "No" and r["expo"].p_value < 1e-6
    assert r["nrm"].statistic < 20


def test_many_buckets_give_the_same_ranks(spark, monkeypatch):
    from carestay.operators import gold, silver
    from carestay.plans import ranking
    from carestay.sources.fixture import stays_raw
    from tests.conftest import SF_SMALL
    f = gold.with_features(silver.clean_stays(stays_raw(spark, SF_SMALL)))
    mb = M.measure_base(f)

    def run():
        s = MD.stratified_split(f.select("patient_id", "readmission_30j"))
        split = sorted((r.patient_id, r.split, r.fold) for r in s.collect())
        return split, MD.exact_auc(mb, "score_risque_modele").first().auc, tuple(
            M.exact_percentiles(f, "ratio_meds_duree", [0.1, 0.5, 0.9]).first())

    one = run()
    monkeypatch.setattr(ranking, "choose_ranges", lambda largest, rows: max(1, rows // 40))
    many = run()
    assert one == many


def test_degenerate_inputs_do_not_fail(spark):
    one_class = spark.createDataFrame([(float(v), 0) for v in range(10)], "age double, readmission_30j int")
    r = ST.mann_whitney_u(one_class, ["age"]).first()
    assert r.n1 == 0 and r.effect_r is None
    tied = spark.createDataFrame([(5.0, "a"), (5.0, "b"), (5.0, "a")], "age double, pathologie string")
    assert ST.kruskal_h(tied).first().h is None
    assert ST.chi2_sf_scalar(0.0, 0) == 1.0
    roc = MD.roc_points(spark.createDataFrame([(0.3, 1), (0.6, 1)], "score_risque_modele double, readmission_30j int"))
    assert all(r.fpr is None for r in roc.collect())


def test_normality_needs_eight_values(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 3]], "age double")
    r = ST.normality_test(df, ["age"]).first()
    assert r.statistic is None


def test_range_count_follows_the_rows():
    from carestay.plans.ranking import choose_ranges
    # one of 200 groups holds a third of 600M rows: ranges of about 2M rows over all
    assert choose_ranges(200_000_000, 600_000_000, target=2_000_000) == 300
    assert choose_ranges(10**12, 10**13) == 5_000_000  # no cap
    assert choose_ranges(10, 600_000_000) == 1         # many small groups: windows per group suffice


def test_null_groups_keep_their_rows_at_any_range_count(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", None]), rnd.choice(["x", None]), float(rnd.randint(0, 40)), rnd.randint(0, 1)) for _ in range(600)]
    df = spark.createDataFrame(rows, "g string, h string, v double, y int")

    def run(buckets):
        p = M.exact_percentiles(df, "v", [0.1, 0.5], ["g", "h"], buckets)
        a = MD.exact_auc(df, "v", "y", ["g"], buckets)
        return sorted(map(str, p.collect())), sorted(map(str, a.collect()))

    one = run(1)
    assert len(one[0]) == 4 and len(one[1]) == 2
    assert run(3) == one and run(1000) == one
    split = spark.createDataFrame([(f"k{i}", None if i % 3 == 0 else i % 2) for i in range(60)], "patient_id string, readmission_30j int")
    both = [sorted(map(str, MD.stratified_split(split, buckets=b).collect())) for b in (1, 5)]
    assert len(both[0]) == 60 and both[0] == both[1]


def test_large_counts_do_not_overflow(spark):
    from carestay.functions import columns as C
    big = spark.createDataFrame([(0.2, 5 * 10**9, 10**9), (0.7, 10**9, 5 * 10**9)], "s double, a bigint, b bigint")
    r = MD.exact_auc(big, "s", weights=("a", "b")).first()
    assert abs(r.auc - (25 + 0.5 * 10) / 36) < 1e-12
    assert spark.range(1).select(C.rnd(F.lit(2.6e17), 2)).first()[0] == 2.6e17
    assert spark.range(1).select(C.rnd(F.lit(1.5e10) + 0.125, 2)).first()[0] == 15000000000.13


def test_poisson_is_not_cut_short():
    cdf = MD.poisson1_cdf()
    assert np.searchsorted(cdf, 1.0 - 2.0 ** -53, side="right") >= 17 and abs(cdf[1] - 2 / math.e) < 1e-15
    w = MD.replicate_weights(np.arange(20000, dtype=np.int64), 50, cdf)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02


def test_bootstrap_equals_brute_force_at_any_range_count(spark):
    rnd = random.Random(7)
    rows = [(f"k{i}", rnd.randint(0, 12) / 12, rnd.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "patient_id string, score_risque_modele double, readmission_30j int").withColumn(
        "prediction", (F.col("score_risque_modele") > 0.5).cast("int"))
    got = [MD.bootstrap_ci(df, n=25, ranges=r).first().asDict() for r in (1, 5)]
    h = {r[0]: r[1] for r in df.select("patient_id", F.xxhash64("patient_id", F.lit(42))).collect()}
    w = MD.replicate_weights(np.array([h[k] for k, *_ in rows], np.int64), 25, MD.poisson1_cdf())
    sc, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    p = sc > 0.5
    cmp = (sc[y == 1][:, None] > sc[y == 0][None, :]) + 0.5 * (sc[y == 1][:, None] == sc[y == 0][None, :])
    auc = [w[y == 1, r] @ cmp @ w[y == 0, r] / (w[y == 1, r].sum() * w[y == 0, r].sum()) for r in range(25)]
    f1 = [2 * w[(y == 1) & p, r].sum() / (w[y == 1, r].sum() + w[p, r].sum()) for r in range(25)]
    for g in got:
        assert g["replicates"] == 25
        assert math.isclose(g["auc_lo"], np.percentile(auc, 2.5)) and math.isclose(g["auc_hi"], np.percentile(auc, 97.5))
        assert math.isclose(g["f1_lo"], np.percentile(f1, 2.5)) and math.isclose(g["f1_hi"], np.percentile(f1, 97.5))


def test_null_group_of_ks_and_prior_period(spark):
    from carestay.operators import timeintel as TI
    df = spark.createDataFrame([(None, 0.1, 0), (None, 0.9, 1), ("a", 0.3, 0), ("a", 0.5, 1)], "g string, s double, readmission_30j int")
    ks = {r.g: (r.ks_approx, r.ks_approx_label) for r in M.ks_approx(df, "s", ["g"]).collect()}
    assert len(ks) == 2 and abs(ks[None][0] - 0.8) < 1e-12 and ks[None][1] == "0.800"
    half = M.ks_approx(df.where("s < 0.4"), "s", ["g"]).collect()
    assert all(r.ks_approx_label is None for r in half)
    per = spark.createDataFrame([(None, 2000, 5, 3, 1), (None, 2012, 5, 4, 2)], "g string, month_index int, x int, sejours int, readmissions int")
    got = {r.month_index: r.sejours_prev for r in TI.period_shift_join(per, 12, ["g"]).collect()}
    assert got == {2000: 0, 2012: 3}


def test_vif_of_collinear_and_constant_columns(spark):
    rnd = random.Random(3)
    rows = [(a, 2 * a, rnd.random(), 7.0) for a in (rnd.random() for _ in range(200))]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    v = {r.feature: r.vif for r in ST.vif(df, ["a", "b", "c"]).collect()}
    assert v["a"] == math.inf and v["b"] == math.inf and 1.0 <= v["c"] < 1.1
    k = {r.feature: r.vif for r in ST.vif(df, ["a", "c", "k"]).collect()}
    assert k["k"] is None or math.isnan(k["k"])
    assert 1.0 <= k["a"] < 1.1


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_split_of_repeated_and_null_keys_equals_brute_force(spark, ranges):
    rnd = random.Random(11)
    rows = [(None if i % 17 == 0 else f"k{i % 150}", None if i % 13 == 0 else rnd.randint(0, 1), "wide" * 20, i) for i in range(400)]
    df = spark.createDataFrame(rows, "patient_id string, readmission_30j int, note string, id int")
    got = MD.stratified_split(df, buckets=ranges)
    assert got.columns == ["patient_id", "readmission_30j", "note", "id", "split", "fold"]
    got = got.collect()
    assert sorted(r["id"] for r in got) == list(range(400)) and {r["note"] for r in got} == {"wide" * 20}
    want = []
    for y in (None, 0, 1):
        mine = sorted((hashlib.md5(f"{k}-42".encode()).hexdigest() if k else "", k or "") for k, label, *_ in rows if label == y)
        n = math.floor(len(mine) * 0.2 + 0.5)
        want += [(k, y, "test" if i < n else "train", None if i < n else (i - n) % 5) for i, (_, k) in enumerate(mine)]
    # rows of one key and class are alike to the order: any of them may have any of their places
    have = [(r["patient_id"] or "", r["readmission_30j"], r["split"], r["fold"]) for r in got]
    assert Counter(have) == Counter(want)


def test_split_shuffles_whole_rows_once_into_small_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANKED_ROWS_PER_RANGE", 100, raising=False)
    df = spark.range(4000).select(F.concat(F.lit("k"), F.col("id")).alias("patient_id"), (F.col("id") % 2).cast("int").alias("readmission_30j"),
                                  F.repeat(F.lit("x"), 200).alias("note"))
    stored = []
    monkeypatch.setattr(ranking, "store_rows", lambda d, real=getattr(ranking, "store_rows", None): stored.append(real(d)) or stored[-1], raising=False)
    got = MD.stratified_split(materialize(df))
    plan = physical_plan(got)
    # the counts are broadcast to the stored rows; no window, sort or shuffle of the rows is left
    assert "BroadcastHashJoin" in plan and not any(x in plan for x in ("Window", "Sort", "hashpartitioning", "rangepartitioning"))
    sizes = [r["count"] for r in stored[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) > 30 and max(sizes) < 300 and sum(sizes) == 4000
