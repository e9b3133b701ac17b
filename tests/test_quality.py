"""Quality checks: semantics, one-job evaluation, gate."""

import pytest

from merchlens.operators import quality as Q


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, "x"), (2, "b", 5.5, "y"), (2, None, None, "z"), (3, "d", 3.0, None), (None, "e", 0.5, "x")],
        "id long, name string, v double, s string")


def results(spark, df, checks):
    return {(r.check_name, r.column_name): r for r in Q.run_suite(df, "t", checks).collect()}


def test_check_semantics(spark, df):
    got = results(spark, df, [Q.not_null("name"), Q.unique("id"), Q.between("v", 1.0, 5.0),
                              Q.between("v", 1.0, None), Q.in_set("s", ["x", "y"]), Q.row_count(1, 4)])
    assert got[("not_null", "name")].observed == 1
    assert got[("unique", "id")].observed == 2          # both rows of the repeated value; NULL id ignored
    assert got[("in_set", "s")].observed == 1           # NULL ignored, 'z' fails
    assert got[("row_count", None)].observed == 5 and not got[("row_count", None)].success
    between = [r for k, r in got.items() if k == ("between", "v")]
    assert between  # both between checks share a key; evaluate separately below
    one = Q.run_suite(df, "t", [Q.between("v", 1.0, 5.0)]).first()
    assert one.observed == 2 and not one.success      # 5.5 and 0.5; NULL ignored
    lo = Q.run_suite(df, "t", [Q.between("v", 1.0, None)]).first()
    assert lo.observed == 1


def test_row_checks_run_in_one_aggregate(spark, df):
    res = Q.run_suite(df, "t", [Q.not_null("name"), Q.between("v", 1.0, 5.0), Q.in_set("s", ["x"])])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # partial + final of one aggregate


def test_uniqueness_shares_the_pass(spark, df):
    checks = [Q.not_null("name"), Q.unique("id"), Q.between("v", 1.0, 5.0), Q.row_count(1, None)]
    res = Q.run_suite(df, "t", checks)
    assert res._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert {(r.check_name, r.observed, r.total_rows) for r in res.collect()} == {
        ("not_null", 1, 5), ("unique", 2, 5), ("between", 2, 5), ("row_count", 5, 5)}
    empty = {r.check_name: (r.observed, r.success) for r in Q.run_suite(df.limit(0), "t", checks).collect()}
    assert empty == {"not_null": (0, True), "unique": (0, True), "between": (0, True), "row_count": (0, False)}


def test_a_broken_suite_is_a_failed_row(spark, df, tmp_path):
    late = df.selectExpr("id", "raise_error('broken on the way') as name")
    suites = [("good", df, [Q.row_count(1, None)]), ("no column", df, [Q.not_null("nope")]), ("late", late, [Q.not_null("name")])]
    got = {r.table_name: r for r in Q.evaluate(suites, str(tmp_path)).collect()}
    assert got["good"].success and not got["no column"].success and got["late"].check_name == "suite_error"
    lazy = {r.table_name: r.success for r in Q.run_suites(suites[:2]).collect()}
    assert lazy == {"good": True, "no column": False}


def test_error_counts_all_failures(spark, df):
    bad = Q.run_suite(df, "t", [Q.not_null("name"), Q.not_null("s"), Q.not_null("v")])
    with pytest.raises(Q.QualityGateError, match="3 checks"):
        Q.enforce(bad, shown=1)


def test_suites_have_published_sizes():
    assert len(Q.suite_businesses()) == 11
    assert len(Q.suite_reviews()) == 8
    assert len(Q.suite_orders()) == 6


def test_gate_and_enforce(spark, df):
    ok = Q.run_suite(df, "t", [Q.row_count(1, 10)])
    assert Q.gate(ok).first().all_passed
    Q.enforce(ok)
    bad = Q.run_suite(df, "t", [Q.not_null("name")])
    assert not Q.gate(bad).first().all_passed
    with pytest.raises(Q.QualityGateError):
        Q.enforce(bad)


def test_row_counts_union(spark, df):
    got = {r.table_name: r.row_count for r in Q.row_counts([("a", df), ("b", df.limit(2))]).collect()}
    assert got == {"a": 5, "b": 2}
