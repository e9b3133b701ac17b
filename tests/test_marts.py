"""Edge rows (FIXTURES 7) and invariants of the marts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from merchlens.operators import marts as M
from merchlens.operators import staging as S
from merchlens.plans import entities as E
from tests.conftest import SF_SMALL

BIZ = "business_id long, name string, address string, city string, state string, postal_code string, " \
      "latitude double, longitude double, stars double, review_count long, is_open int, categories string"
REV = "review_id long, user_id long, business_id long, stars double, useful long, funny long, cool long, " \
      "text string, date string"


def businesses(spark, rows):
    return S.stage_businesses(spark.createDataFrame(rows, BIZ))


def biz(i, state="PA", cats="Pizza", stars=4.0):
    return (i, f"B{i}", "addr", "City", state, "1", 40.0, -75.0, stars, 10, 1, cats)


def reviews(spark, rows):
    return S.stage_reviews(spark.createDataFrame(rows, REV), min_date=None)


def rev(i, b, date, stars=5.0, user=None):
    return (i, user if user is not None else i, b, stars, 0, 0, 0, "t", date)


def empty_checkins(spark):
    return S.stage_checkins(spark.createDataFrame([], "business_id long, checkin_at timestamp"))


def test_staging_filters(spark):
    rows = [biz(1), biz(2, cats=None), (3, "B3", "a", "c", "PA", "1", None, -75.0, 4.0, 10, 1, "Pizza"),
            (4, "B4", "a", "c", "PA", "1", 40.0, -75.0, 0.5, 10, 1, "Pizza"),
            (5, "B5", "a", "c", "pa ", "1", 40.0, -75.0, 4.0, 0, 1, "Pizza"), biz(6, cats="Hardware")]
    got = businesses(spark, rows).select("business_id").collect()
    assert [r.business_id for r in got] == [1]


def test_activity_defaults_and_velocity(spark):
    b = businesses(spark, [biz(1), biz(2)])
    r = reviews(spark, [rev(1, 1, "2020-01-03"), rev(2, 1, "2020-01-30 10:00:00")])
    act = {x.business_id: x for x in M.merchant_activity(b, r, empty_checkins(spark)).collect()}
    # all reviews in one month: velocity 0 (NULL coalesced)
    assert act[1].total_reviews == 2 and act[1].reviews_per_month == 0.0
    # merchant without reviews or check-ins
    assert act[2].total_reviews == 0 and act[2].avg_review_stars == 4.0
    assert act[2].positive_review_ratio is None and act[2].total_checkins == 0
    assert act[2].peak_day_of_week is None


def test_no_checkins_means_null_scores(spark):
    b = businesses(spark, [biz(i) for i in range(1, 8)])
    r = reviews(spark, [rev(i, i, "2020-01-03") for i in range(1, 8)] +
                [rev(100 + i, i, "2020-05-03") for i in range(1, 8)])
    perf = M.merchant_performance(M.merchant_activity(b, r, empty_checkins(spark)))
    rows = perf.collect()
    assert all(x.composite_score is None for x in rows)
    assert sorted(x.performance_tier for x in rows) == [1, 1, 2, 2, 3, 4, 5]


def test_equal_scores_split_by_id(spark):
    b = businesses(spark, [biz(i) for i in range(1, 11)])
    r = reviews(spark, [rev(i, i, "2020-01-03") for i in range(1, 11)])
    ci = S.stage_checkins(spark.createDataFrame([(i, dt.datetime(2020, 1, 1)) for i in range(1, 11)],
                                                "business_id long, checkin_at timestamp"))
    perf = M.merchant_performance(M.merchant_activity(b, r, ci))
    got = {x.business_id: x.performance_tier for x in perf.collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 3, 6: 3, 7: 4, 8: 4, 9: 5, 10: 5}


def test_market_share_rank_gaps(spark):
    perf = spark.createDataFrame(
        [(i, "AZ", c, 4.0, 1.0, 1, 0.5, 2, True, False) for i, c in
         enumerate(["Pizza"] * 2 + ["Sushi"] * 2 + ["Thai"])],
        "business_id long, state string, primary_cuisine string, avg_review_stars double, "
        "reviews_per_month double, total_checkins long, composite_score double, total_reviews long, "
        "is_open boolean, is_elite_merchant boolean")
    got = {r.primary_cuisine: r for r in M.cuisine_market_share(perf).collect()}
    assert [got[c].cuisine_rank_in_state for c in ("Pizza", "Sushi", "Thai")] == [1, 1, 3]
    assert got["Pizza"].market_share_pct == 40.0 and got["Thai"].total_merchants_in_state == 5


def test_retention_offsets(spark):
    r = reviews(spark, [rev(1, 1, "2020-01-31", user=7), rev(2, 1, "2020-02-01", user=7),
                        rev(3, 1, "2022-02-10", user=7), rev(4, 1, "2020-01-05", user=8),
                        rev(5, 1, "2020-01-06", user=8)])
    got = {(x.cohort_label, x.months_since_cohort): x for x in M.cohort_retention(r).collect()}
    assert set(got) == {("2020-01", 0), ("2020-01", 1)}  # offset 25 excluded
    assert got[("2020-01", 0)].cohort_size == 2 and got[("2020-01", 0)].retention_rate_pct == 100.0
    assert got[("2020-01", 1)].retained_users == 1 and got[("2020-01", 1)].retention_rate_pct == 50.0


def test_delivery_only_cancelled_and_unknown_merchant(spark):
    schema = ("order_id string, business_id long, courier_id string, order_timestamp timestamp, "
              "order_date date, order_hour int, order_day_of_week string, estimated_delivery_min int, "
              "actual_delivery_min int, delivery_delta_min int, is_on_time boolean, "
              "order_total_usd double, delivery_fee_usd double, order_status string, _is_synthetic boolean")
    d = dt.date(2023, 3, 6)
    ts = dt.datetime(2023, 3, 6, 18)
    rows = [("a", 1, "x", ts, d, 18, "Monday", 30, None, None, None, 20.0, 2.5, "cancelled", True),
            ("b", 1, "x", ts, d, 18, "Monday", 30, None, None, None, 10.0, 1.5, "cancelled", True),
            ("c", 9, "x", ts, d, 18, "Monday", 30, 40, 10, False, 10.0, 1.5, "delivered", True)]
    orders = S.stage_orders(spark.createDataFrame(rows, schema))
    perf = spark.createDataFrame([(1, "B1", "C", "PA", "Pizza", 3, "Average")],
                                 "business_id long, business_name string, city string, state string, "
                                 "primary_cuisine string, performance_tier long, tier_label string")
    got = M.delivery_operations(orders, perf).collect()
    assert len(got) == 1  # merchant 9 unknown -> dropped
    g = got[0]
    assert g.total_orders == 2 and g.delivered_orders == 0 and g.cancelled_orders == 2
    assert g.fulfillment_rate == 0.0 and g.on_time_rate is None
    assert g.avg_delivery_min is None and g.p90_delivery_min is None
    assert g.total_gmv_usd == 30.0 and g.avg_order_value_usd == 15.0


@pytest.fixture(scope="module")
def small_marts(spark):
    perf = E.performance(spark, SF_SMALL)
    return perf, E.market_share(spark, SF_SMALL, perf), E.retention(spark, SF_SMALL), \
        E.delivery_ops(spark, SF_SMALL, perf)


def test_invariants_on_testdata(spark, small_marts):
    perf, share, ret, ops = small_marts
    sizes = [r["count"] for r in perf.groupBy("performance_tier").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    for r in share.groupBy("state").agg(F.sum("market_share_pct").alias("s")).collect():
        assert abs(r.s - 100.0) < 0.05 * 10
    assert ret.filter("months_since_cohort = 0 and retention_rate_pct != 100.0").count() == 0
    assert ops.filter("delivered_orders + cancelled_orders != total_orders").count() == 0
    assert perf.select("business_id").distinct().count() == perf.count()


def test_share_matrix_wide_uses_label_columns(spark, small_marts):
    from merchlens.functions import rules
    from merchlens.operators.reports import share_matrix_wide

    _, share, _, _ = small_marts
    wide = share_matrix_wide(share, 10, rules.PART_RULES)
    assert wide.columns == ["state", "Red anvil", "Jewelry", "Metal", "Parts", "Other"]
    assert wide.count() == min(10, share.select("state").distinct().count())


def test_tiers_are_the_same_over_any_partitioning(spark):
    """Ratings whose float sums depend on the order of addition, thousands of near ties: tiers by the unrounded score, from rows in any order."""
    import random

    r = random.Random(5)
    reviews = [(f"r{i}", f"b{r.randrange(300):03d}", r.choice([1.1, 2.3, 3.7, 4.9, 3.3]), f"2019-0{r.randrange(1, 4)}-01") for i in range(6000)]
    businesses = [(f"b{i:03d}", f"name {i}", "c", f"S{i % 3}", "Pizza", 3.3, 9, True, 30.0, -100.0) for i in range(300)]
    b = spark.createDataFrame(businesses, "business_id string, business_name string, city string, state string, primary_cuisine string, stars double, "
                                          "review_count int, is_open boolean, latitude double, longitude double")
    checkins = spark.createDataFrame([(f"b{i % 300:03d}", "2019-01-01 10:00:00") for i in range(900)], "business_id string, at string") \
        .select("business_id", F.col("at").cast("timestamp").alias("checkin_at"))
    seen = []
    for seed, parts in ((1, 1), (2, 7), (3, 23)):
        random.Random(seed).shuffle(reviews)
        rows = spark.createDataFrame(reviews, "review_id string, business_id string, stars double, date string").repartition(parts).selectExpr("*", "'u' as user_id", "0 as useful", "0 as funny", "0 as cool")
        act = M.merchant_activity(b.repartition(parts), S.stage_reviews(rows, None), S.stage_checkins(checkins))
        scores = M.composite_scores(act).select("business_id", "composite_score", "avg_review_stars").collect()
        perf = M.merchant_performance(act).select("business_id", "performance_tier", "state_performance_tier").collect()
        seen.append((sorted(map(tuple, scores)), sorted(map(tuple, perf))))
    assert seen[0] == seen[1] == seen[2]
    order = sorted(((score, i) for i, score, _ in seen[0][0]))
    assert {i: t for i, t, _ in seen[0][1]} == {i: 1 + place // 60 for place, (_, i) in enumerate(order)}


def test_p90_is_read_off_sorted_rows(spark):
    # groups of 1 to 400 orders, some without minutes, equal to Spark's exact percentile to the last bit
    rows = [(g % 7 or None, dt.date(2024, 1 + g % 3, 1), "Monday", "delivered" if i % 5 else "cancelled", bool(i % 3),
             10 + (i * 37 + g) % 53 if i % 5 else None, 1.5, 0.5, True) for g in range(40) for i in range(1 + g * g // 4)]
    rows.append((99, dt.date(2024, 1, 1), "Sunday", "cancelled", None, None, 1.5, 0.5, True))
    orders = spark.createDataFrame(rows, "business_id long, order_month date, order_day_of_week string, order_status string, is_on_time boolean, "
                                         "actual_delivery_min int, order_total_usd double, delivery_fee_usd double, _is_synthetic boolean")
    keys = ["business_id", "order_month", "order_day_of_week"]
    got = M.order_metrics(orders)
    want = orders.groupBy(*keys).agg(F.percentile(F.col("actual_delivery_min").cast("double"), F.lit(0.9)).alias("p"), F.count(F.lit(1)).alias("n"))
    tell = lambda rows: sorted(map(tuple, rows), key=str)
    assert tell(got.select(*keys, "p90_delivery_min", "total_orders").collect()) == tell(want.collect())
    assert "ObjectHashAggregate" not in got._jdf.queryExecution().toString()
