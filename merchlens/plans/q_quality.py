"""Registered data-quality queries (DQ1-DQ13, SET1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchlens.operators import quality as Q
from merchlens.plans import entities as E
from merchlens.plans.catalog import query
from merchlens.plans.oracle import CHECKS, check_rows, with_ctes
from merchlens.sources import adapters

BIZ_NOT_NULL = [Q.not_null(c) for c in ("business_id", "business_name", "state", "stars",
                                        "primary_cuisine", "address")]
UNIQUE_CHECKS = [("stg_businesses", "business_id"), ("stg_reviews", "review_id"),
                 ("stg_orders", "order_id"), ("stg_checkins", "business_id")]
BETWEEN_CHECKS = [("stg_businesses", [Q.between("stars", 1.0, 5.0), Q.between("review_count", 1, None),
                                      Q.between("latitude", 18.0, 72.0),
                                      Q.between("longitude", -180.0, -65.0)]),
                  ("stg_reviews", [Q.between("review_stars", 1.0, 5.0),
                                   Q.between("review_year", 2015, 2026)]),
                  ("stg_orders", [Q.between("order_total_usd", 0.01, 500.0),
                                  Q.between("actual_delivery_min", 10, None)])]
IN_SET_CHECKS = [("stg_reviews", [Q.in_set("sentiment_bucket", ("positive", "neutral", "negative"))]),
                 ("stg_orders", [Q.in_set("order_status", ("delivered", "cancelled"))]),
                 ("stg_businesses", [Q.in_set("stars", (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0))])]
ROW_COUNT_CHECKS = [("stg_businesses", [Q.row_count(100, 500_000)]),
                    ("stg_reviews", [Q.row_count(100, 10_000_000)]),
                    ("stg_orders", [Q.row_count(1_000, 600_000)])]


def _staged(spark, d):
    return {"stg_businesses": E.businesses(spark, d), "stg_reviews": E.reviews(spark, d),
            "stg_orders": E.orders(spark, d), "stg_checkins": E.checkins(spark, d)}


def _suites_sql(pairs) -> str:
    """pairs: (table, checks of the SQL side)."""
    return with_ctes("\nunion all\n".join(check_rows(t, checks) for t, checks in pairs), *{t for t, _ in pairs})


def _run(spark, d, pairs):
    st = _staged(spark, d)
    return Q.run_suites([(t, st[t], cs) for t, cs in pairs])


@query("dq1_not_null", _suites_sql([("stg_businesses", [("not_null", c) for c in ("business_id", "business_name", "state", "stars", "primary_cuisine", "address")])]))
def dq1(spark, d):
    return _run(spark, d, [("stg_businesses", BIZ_NOT_NULL)])


_UNIQ = [(t, [Q.unique(c)]) for t, c in UNIQUE_CHECKS]


@query("dq2_unique", _suites_sql([("stg_businesses", [("unique", "business_id")]), ("stg_reviews", [("unique", "review_id")]),
                                  ("stg_orders", [("unique", "order_id")]), ("stg_checkins", [("unique", "business_id")])]))
def dq2(spark, d):
    return _run(spark, d, _UNIQ)


@query("dq3_between", _suites_sql([
    ("stg_businesses", [("between", "stars", 1.0, 5.0), ("between", "review_count", 1, None), ("between", "latitude", 18.0, 72.0), ("between", "longitude", -180.0, -65.0)]),
    ("stg_reviews", [("between", "review_stars", 1.0, 5.0), ("between", "review_year", 2015, 2026)]),
    ("stg_orders", [("between", "order_total_usd", 0.01, 500.0), ("between", "actual_delivery_min", 10, None)])]))
def dq3(spark, d):
    return _run(spark, d, BETWEEN_CHECKS)


@query("dq4_in_set", _suites_sql([
    ("stg_reviews", [("in_set", "sentiment_bucket", "'positive','neutral','negative'")]), ("stg_orders", [("in_set", "order_status", "'delivered','cancelled'")]),
    ("stg_businesses", [("in_set", "stars", "1.0,1.5,2.0,2.5,3.0,3.5,4.0,4.5,5.0")])]))
def dq4(spark, d):
    return _run(spark, d, IN_SET_CHECKS)


@query("dq5_row_count", _suites_sql([
    ("stg_businesses", [("row_count", 100, 500000)]), ("stg_reviews", [("row_count", 100, 10000000)]), ("stg_orders", [("row_count", 1000, 600000)])]))
def dq5(spark, d):
    return _run(spark, d, ROW_COUNT_CHECKS)


_S6 = [("stg_businesses", Q.suite_businesses())]
_S7 = [("stg_reviews", Q.suite_reviews())]
_S8 = [("stg_orders", Q.suite_orders())]
_ALL = _S6 + _S7 + _S8
_SQL6, _SQL7, _SQL8 = (("stg_businesses", CHECKS["businesses"]), ("stg_reviews", CHECKS["reviews"]), ("stg_orders", CHECKS["orders"]))


@query("dq6_suite_businesses", _suites_sql([_SQL6]))
def dq6(spark, d):
    return _run(spark, d, _S6)


@query("dq7_suite_reviews", _suites_sql([_SQL7]))
def dq7(spark, d):
    return _run(spark, d, _S7)


@query("dq8_suite_orders", _suites_sql([_SQL8]))
def dq8(spark, d):
    return _run(spark, d, _S8)


@query("dq9_run_suites", with_ctes(
    "select table_name, count(*) filter (where success) as passed, count(*) as checks, "
    "bool_and(success) as all_passed from (" + "\nunion all\n".join(
        check_rows(t, lines) for t, lines in (_SQL6, _SQL7, _SQL8)) + ") group by 1",
    *{t for t, _ in _ALL}))
def dq9(spark, d):
    return Q.suite_summary(_run(spark, d, _ALL))


@query("dq10_gate", with_ctes(
    "select coalesce(bool_and(success), false) as all_passed, "
    "count(*) filter (where not success) as failed_checks from (" + "\nunion all\n".join(
        check_rows(t, lines) for t, lines in (_SQL6, _SQL7, _SQL8)) + ")",
    *{t for t, _ in _ALL}))
def dq10(spark, d):
    return Q.gate(_run(spark, d, _ALL))


_SRC = [("raw_businesses", Q.source_tests_businesses()),
        ("raw_reviews_src", Q.source_tests_reviews()),
        ("checkin_events", Q.source_tests_checkins()),
        ("raw_orders", Q.source_tests_orders())]


@query("dq11_source_tests", _suites_sql([
    ("raw_businesses", CHECKS["source businesses"]), ("raw_reviews_src", CHECKS["source reviews"]),
    ("checkin_events", CHECKS["source checkins"]), ("raw_orders", CHECKS["source orders"])]))
def dq11(spark, d):
    E.prepare(spark)
    src = {
        "raw_businesses": adapters.raw_businesses(spark, d),
        "raw_reviews_src": adapters.raw_reviews(spark, d).withColumn(
            "review_date", F.col("date").cast("date")),
        "checkin_events": adapters.checkin_events(spark, d),
        "raw_orders": adapters.raw_orders(spark, d),
    }
    return Q.run_suites([(t, src[t], cs) for t, cs in _SRC])


_MART = [("merchant_performance", Q.mart_tests_performance()),
         ("cuisine_market_share", Q.mart_tests_market_share()),
         ("cohort_retention", Q.mart_tests_retention()),
         ("delivery_operations", Q.mart_tests_delivery())]


@query("dq12_mart_tests", _suites_sql([
    ("merchant_performance", CHECKS["mart performance"]), ("cuisine_market_share", CHECKS["mart share"]),
    ("cohort_retention", CHECKS["mart retention"]), ("delivery_operations", CHECKS["mart delivery"])]))
def dq12(spark, d):
    perf = E.performance(spark, d)
    marts = {"merchant_performance": perf, "cuisine_market_share": E.market_share(spark, d, perf),
             "cohort_retention": E.retention(spark, d),
             "delivery_operations": E.delivery_ops(spark, d, perf)}
    return Q.run_suites([(t, marts[t], cs) for t, cs in _MART])


_MART_NAMES = ["merchant_performance", "cuisine_market_share", "cohort_retention", "delivery_operations"]


@query("dq13_row_counts", with_ctes("\nunion all\n".join(
    f"select '{m}' as table_name, count(*) as row_count from {m}" for m in _MART_NAMES), *_MART_NAMES))
def dq13(spark, d):
    perf = E.performance(spark, d)
    return Q.row_counts([
        ("merchant_performance", perf), ("cuisine_market_share", E.market_share(spark, d, perf)),
        ("cohort_retention", E.retention(spark, d)),
        ("delivery_operations", E.delivery_ops(spark, d, perf))])


_STG = ["stg_businesses", "stg_reviews", "stg_checkins", "stg_orders"]


@query("set1_union_all_counts", with_ctes("\nunion all\n".join(
    f"select '{m}' as table_name, count(*) as row_count from {m}" for m in _STG), *_STG))
def set1(spark, d):
    st = _staged(spark, d)
    return Q.row_counts([(m, st[m]) for m in _STG])
