import datetime as dt

from carestay.operators import quality as Q


def report(spark, rows, ddl, suite):
    return {(r.check, r.column): (r.failing_rows, r.status) for r in
            Q.run_expectations(spark.createDataFrame(rows, ddl), suite, "t").collect()}


def test_each_check_with_a_planted_failure(spark):
    rows = [("a", 20, dt.date(2024, 1, 2), dt.date(2024, 1, 1), 0),
            ("a", -1, dt.date(2024, 1, 1), dt.date(2024, 1, 3), 1),
            (None, None, None, None, 1)]
    ddl = "k string, age int, adm date, dis date, y int"
    suite = [Q.expect_not_null("k"), Q.expect_unique("k"), Q.expect_accepted_values("y", [0]),
             Q.expect_range("age", 0, 95), Q.expect_date_order("adm", "dis"), Q.expect_positive("age"),
             Q.expect_rate_within("y", 0.05, 0.40)]
    r = report(spark, rows, ddl, suite)
    assert r[("not_null", "k")] == (1, "FAIL")
    assert r[("unique", "k")] == (1, "FAIL")            # one duplicated key; null keys ignored
    assert r[("accepted_values", "y")] == (2, "FAIL")
    assert r[("range", "age")] == (1, "FAIL")           # null passes
    assert r[("date_order", "dis")] == (1, "FAIL")
    assert r[("positive", "age")] == (1, "FAIL")        # null is not caught, as in the source test
    assert r[("rate_within", "y")] == (1, "FAIL")       # rate 2/3


def test_passing_suite(spark):
    r = report(spark, [("a", 30, 0), ("b", 40, 0), ("c", 50, 0), ("d", 60, 0), ("e", 70, 1)], "k string, age int, y int",
               [Q.expect_unique("k"), Q.expect_range("age", 18, 95), Q.expect_rate_within("y", 0.05, 0.40)])
    assert all(v == (0, "PASS") for v in r.values())
