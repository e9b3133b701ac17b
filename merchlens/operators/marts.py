"""Gold models (MOD6-MOD10): merchant activity, performance with tiers,
cuisine market share, reviewer cohort retention, delivery operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.functions.columns import (
    date_label,
    exact_mean,
    flag,
    months_diff,
    round_dp,
    safe_ratio,
    tier_label,
)
from merchlens.operators.ntile import ranged, tiles
from merchlens.session import scratch_path


def review_aggregates(reviews: DataFrame) -> DataFrame:
    """Per business: volume, mean stars, first/last date, reviews per month
    (NULL when first and last fall in one month), sentiment counts, years. The stars are added up as decimals, so their mean is the same
    to the last bit however the rows are partitioned."""
    first, last = F.min("review_date"), F.max("review_date")
    return reviews.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        exact_mean("review_stars").alias("avg_review_stars"),
        first.alias("first_review_date"),
        last.alias("last_review_date"),
        (F.count(F.lit(1)) / F.nullif(months_diff(first, last), F.lit(0))).alias("reviews_per_month"),
        F.sum(F.when(F.col("sentiment_bucket") == "positive", 1).otherwise(0)).cast("long")
        .alias("positive_reviews"),
        F.sum(F.when(F.col("sentiment_bucket") == "negative", 1).otherwise(0)).cast("long")
        .alias("negative_reviews"),
        F.countDistinct("review_year").alias("active_years"),
    )


def review_months(reviews: DataFrame) -> DataFrame:
    """Reviews per business and month, added up: rows that the calendar bounds, whatever a merchant's popularity, from which
    ``review_aggregates_of_months`` tells the same as ``review_aggregates`` of the reviews."""
    good, bad = F.col("sentiment_bucket") == "positive", F.col("sentiment_bucket") == "negative"
    return reviews.groupBy("business_id", "review_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("review_stars").cast("decimal(38,12)")).alias("stars"), F.count("review_stars").alias("rated"),
        F.min("review_date").alias("first_date"), F.max("review_date").alias("last_date"), F.count_if(good).alias("good"), F.count_if(bad).alias("bad"))


def review_aggregates_of_months(months: DataFrame) -> DataFrame:
    first, last = F.min("first_date"), F.max("last_date")
    return months.groupBy("business_id").agg(
        F.sum("n").alias("total_reviews"), (F.sum("stars").cast("double") / F.nullif(F.sum("rated").cast("double"), F.lit(0.0))).alias("avg_review_stars"),
        first.alias("first_review_date"), last.alias("last_review_date"),
        (F.sum("n") / F.nullif(months_diff(first, last), F.lit(0))).alias("reviews_per_month"),
        F.sum("good").alias("positive_reviews"), F.sum("bad").alias("negative_reviews"), F.countDistinct(F.year("review_month")).alias("active_years"))


def checkin_aggregates(checkins: DataFrame) -> DataFrame:
    """Per business: check-ins, distinct active days and the weekday of the
    largest (date, hour) bucket; ties go to the smallest weekday, NULL
    weekdays are skipped."""
    return checkins.groupBy("business_id").agg(
        F.sum("checkin_count").cast("long").alias("total_checkins"),
        F.countDistinct("checkin_date").alias("active_checkin_days"),
        F.max_by(
            F.col("day_of_week"),
            F.when(F.col("day_of_week").isNotNull(),
                   F.struct(F.col("checkin_count"), -F.col("day_of_week"))),
        ).alias("peak_day_of_week"),
    )


def merchant_activity(businesses: DataFrame, reviews: DataFrame, checkins: DataFrame) -> DataFrame:
    """MOD6: one row per staged business with review and check-in metrics;
    missing sides default to 0, mean stars fall back to the listing stars,
    the positive ratio is NULL without reviews.

    Both aggregates are hash-partitioned by ``business_id`` when they leave
    their final aggregation, so the two left joins add one exchange of the
    business table at most (AQE broadcasts small sides by measured size)."""
    return _activity(businesses, review_aggregates(reviews), checkin_aggregates(checkins))


def merchant_activity_colocated(businesses: DataFrame, months: DataFrame, checkins: DataFrame) -> DataFrame:
    """MOD6 from tables bucketed by ``business_id`` (``sinks.write_bucketed``): businesses, ``review_months`` and daily check-ins. Groups and joins read the buckets
    as they lie, without an exchange."""
    return _activity(businesses, review_aggregates_of_months(months), checkin_aggregates(checkins))


def _activity(b: DataFrame, r: DataFrame, c: DataFrame) -> DataFrame:
    j = b.join(r, "business_id", "left").join(c, "business_id", "left")
    return j.select(
        "business_id",
        "business_name",
        "city",
        "state",
        "primary_cuisine",
        F.col("stars").alias("listing_stars"),
        F.col("review_count").alias("listing_review_count"),
        "is_open",
        "latitude",
        "longitude",
        F.coalesce(F.col("total_reviews"), F.lit(0).cast("long")).alias("total_reviews"),
        F.coalesce(F.col("avg_review_stars"), F.col("stars")).alias("avg_review_stars"),
        "first_review_date",
        "last_review_date",
        F.coalesce(F.col("reviews_per_month"), F.lit(0.0)).alias("reviews_per_month"),
        F.coalesce(F.col("positive_reviews"), F.lit(0).cast("long")).alias("positive_reviews"),
        F.coalesce(F.col("negative_reviews"), F.lit(0).cast("long")).alias("negative_reviews"),
        F.coalesce(F.col("active_years"), F.lit(0).cast("long")).alias("active_years"),
        F.when(F.coalesce(F.col("total_reviews"), F.lit(0)) == 0, F.lit(None).cast("double"))
        .otherwise(safe_ratio(F.col("positive_reviews"), F.col("total_reviews")))
        .alias("positive_review_ratio"),
        F.coalesce(F.col("total_checkins"), F.lit(0).cast("long")).alias("total_checkins"),
        F.coalesce(F.col("active_checkin_days"), F.lit(0).cast("long")).alias("active_checkin_days"),
        F.col("peak_day_of_week"),
    )


def composite_scores(activity: DataFrame) -> DataFrame:
    """Adds ``composite_score`` (unrounded): 0.40 * stars / 5 + 0.35 * velocity / max velocity + 0.25 * check-ins / max
    check-ins, NULL when a maximum is 0. Every term comes from whole numbers or an exact sum, so the score does not depend on the
    order of rows. The two maxima are a one-row aggregate joined to every row."""
    most = activity.agg(F.max("reviews_per_month").cast("double").alias("__mv"), F.max("total_checkins").cast("double").alias("__mc"))
    score = (
        F.lit(rules.SCORE_WEIGHT_STARS) * (F.col("avg_review_stars") / F.lit(rules.STAR_SCALE))
        + F.lit(rules.SCORE_WEIGHT_VELOCITY) * (F.col("reviews_per_month") / F.nullif(F.col("__mv"), F.lit(0.0)))
        + F.lit(rules.SCORE_WEIGHT_CHECKINS) * (F.col("total_checkins") / F.nullif(F.col("__mc"), F.lit(0.0)))
    )
    return with_one_row(activity, most).withColumn("composite_score", score).drop("__mv", "__mc")


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """The single row of a global aggregate beside every row: a broadcast of one row, by its making."""
    return df.join(F.broadcast(one), F.lit(True))


def merchant_performance(activity: DataFrame) -> DataFrame:
    """MOD7: composite score, national and in-state quintiles (1 = bottom, 5 = top), tier label and flags.

    Tiers order by the unrounded score, NULL scores last, ties split by business_id. The output score is rounded to 4. One table, stored range-partitioned by (score, id), serves both tiers; the activity
    table is stored before, so the maxima and the ranges read it instead of computing it twice."""
    spark = activity.sparkSession
    at = scratch_path(spark, "activity")
    activity.write.parquet(at)
    key = ["composite_score", "business_id"]
    tiered = tiles(ranged(composite_scores(spark.read.parquet(at)), key), rules.N_TIERS, key, out_col="performance_tier")
    tiered = tiles(tiered, rules.N_TIERS, key, ["state"], out_col="state_performance_tier")
    return tiered.select(
        "business_id", "business_name", "city", "state", "primary_cuisine",
        "latitude", "longitude", "is_open",
        "listing_stars", "avg_review_stars", "total_reviews", "reviews_per_month",
        "total_checkins", "active_checkin_days", "positive_review_ratio", "active_years",
        round_dp(F.col("composite_score"), 4).alias("composite_score"),
        "performance_tier",
        "state_performance_tier",
        tier_label(F.col("performance_tier")).alias("tier_label"),
        flag(F.col("performance_tier") == 5).alias("is_elite_merchant"),
        flag(F.col("is_open") == F.lit(False)).alias("is_closed"),
    )


def cuisine_market_share(perf: DataFrame) -> DataFrame:
    """MOD8: per (state, cuisine) count, share of the state's merchants,
    rounded means, review total, open count, elite share and the rank of the
    cuisine in its state by count (gaps on ties).

    One partial/final aggregation over merchants; state totals and ranks are
    windows over the aggregated (state, cuisine) rows, so no join."""
    cs = perf.groupBy("state", "primary_cuisine").agg(
        F.count(F.lit(1)).alias("merchant_count"),
        exact_mean("avg_review_stars").alias("avg_stars"),
        exact_mean("reviews_per_month").alias("avg_reviews_per_month"),
        F.avg("total_checkins").alias("avg_checkins"),
        exact_mean("composite_score").alias("avg_composite_score"),
        F.sum("total_reviews").cast("long").alias("total_reviews_in_segment"),
        F.sum(F.when(F.col("is_open"), 1).otherwise(0)).cast("long").alias("open_merchant_count"),
        F.avg(F.when(F.col("is_elite_merchant"), F.lit(1.0)).otherwise(F.lit(0.0)))
        .alias("elite_merchant_share"),
    )
    by_state = Window.partitionBy("state")
    total = F.sum("merchant_count").over(by_state).cast("long")
    return cs.select(
        "state",
        "primary_cuisine",
        "merchant_count",
        total.alias("total_merchants_in_state"),
        round_dp(F.lit(100.0) * F.col("merchant_count") / F.nullif(total, F.lit(0)), 2)
        .alias("market_share_pct"),
        round_dp("avg_stars", 2).alias("avg_stars"),
        round_dp("avg_reviews_per_month", 2).alias("avg_reviews_per_month"),
        round_dp("avg_checkins", 0).alias("avg_checkins"),
        round_dp("avg_composite_score", 4).alias("avg_composite_score"),
        "total_reviews_in_segment",
        "open_merchant_count",
        round_dp("elite_merchant_share", 4).alias("elite_merchant_share"),
        F.rank().over(by_state.orderBy(F.col("merchant_count").desc())).cast("long")
        .alias("cuisine_rank_in_state"),
    )


def user_month_offsets(reviews: DataFrame) -> DataFrame:
    """Distinct (user, activity month) with the user's first month and the
    months since it, in ONE shuffle: each user's set of review months is
    combined map-side and shuffled by user. The set is bounded by the
    calendar (one entry per month), however many reviews a user writes."""
    per_user = (
        reviews.filter(F.col("user_id").isNotNull() & F.col("review_month").isNotNull())
        .groupBy("user_id").agg(F.collect_set("review_month").alias("__months"))
    )
    return per_user.select(
        "user_id",
        F.explode("__months").alias("activity_month"),
        F.array_min("__months").alias("cohort_month"),
    ).withColumn("months_since_cohort", months_diff("cohort_month", "activity_month").cast("long"))


def cohort_retention(reviews: DataFrame, max_months: int = rules.RETENTION_MAX_MONTHS) -> DataFrame:
    """MOD9: users grouped by the month of their first review; per cohort and
    month offset (0..max_months) the distinct users still reviewing and their
    share of the cohort.

    Plan: each user's set of months (map-side combined, one shuffle by
    user, bounded by the calendar) -> exploded (user, month, first month)
    -> count per (cohort, offset) with map-side combine. The cohort size is the
    offset-0 count (every user is active in their own cohort month), taken
    by a window over the small aggregate: no self-join, no count distinct."""
    with_cohort = user_month_offsets(reviews)
    retention = (
        with_cohort.filter(F.col("months_since_cohort").between(0, max_months))
        .groupBy("cohort_month", "months_since_cohort")
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    size = F.max(
        F.when(F.col("months_since_cohort") == 0, F.col("retained_users"))
    ).over(Window.partitionBy("cohort_month"))
    return retention.select(
        F.col("cohort_month").cast("date").alias("cohort_month"),
        date_label("cohort_month").alias("cohort_label"),
        "months_since_cohort",
        size.alias("cohort_size"),
        "retained_users",
        round_dp(F.lit(100.0) * F.col("retained_users") / F.nullif(size, F.lit(0)), 2)
        .alias("retention_rate_pct"),
    )


def order_metrics(orders: DataFrame) -> DataFrame:
    """Per (business, month, weekday) order volume, fulfillment, on-time,
    delivery minutes (mean and exact p90) and money. Rows are shuffled once by
    the group and sorted by minutes in it, so the p90 is read off two rows;
    sort and window spill, and a busy merchant spreads by month and weekday."""
    keys = ["business_id", "order_month", "order_day_of_week"]
    delivered = F.col("order_status") == "delivered"
    minutes = F.col("actual_delivery_min")
    sort = Window.partitionBy(*keys).orderBy(minutes.asc_nulls_last())
    place = F.lit(0.9) * (F.col("__n") - 1)
    low, high = F.col("__low").cast("double"), F.col("__high").cast("double")
    grouped = (
        orders.filter(F.col("_is_synthetic") == F.lit(True))
        .select(*keys, "order_status", "is_on_time", "actual_delivery_min", "order_total_usd", "delivery_fee_usd",
                (F.row_number().over(sort) - 1).alias("__at"),
                F.count(minutes).over(sort.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__n"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum(F.when(delivered, 1).otherwise(0)).cast("long").alias("delivered_orders"),
            F.sum(F.when(F.col("order_status") == "cancelled", 1).otherwise(0)).cast("long")
            .alias("cancelled_orders"),
            F.avg(F.when(delivered, F.lit(1.0)).otherwise(F.lit(0.0))).alias("fulfillment_rate"),
            F.avg(F.when(delivered, F.col("is_on_time").cast("double"))).alias("on_time_rate"),
            F.avg(F.when(delivered, minutes)).alias("avg_delivery_min"),
            F.max("__n").alias("__n"),
            F.max(F.when(F.col("__at") == F.floor(place), minutes)).alias("__low"),
            F.max(F.when(F.col("__at") == F.ceil(place), minutes)).alias("__high"),
            F.sum("order_total_usd").alias("total_gmv_usd"),
            F.count("order_total_usd").alias("__n_value"),
            F.sum("delivery_fee_usd").alias("total_delivery_fees_usd"),
        )
    )
    p90 = F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)
    return grouped.withColumn("p90_delivery_min", p90).drop("__n", "__low", "__high")


def delivery_operations(orders: DataFrame, perf: DataFrame) -> DataFrame:
    """MOD10: order metrics joined to merchant attributes (orders of unknown
    merchants drop out), rates and money rounded."""
    om = order_metrics(orders)
    m = perf.select("business_id", "business_name", "city", "state", "primary_cuisine",
                    "performance_tier", "tier_label")
    gmv = F.col("total_gmv_usd")
    return om.join(m, "business_id", "inner").select(
        "business_id", "business_name", "city", "state", "primary_cuisine",
        "performance_tier", "tier_label", "order_month", "order_day_of_week",
        "total_orders", "delivered_orders", "cancelled_orders",
        round_dp("fulfillment_rate", 4).alias("fulfillment_rate"),
        round_dp("on_time_rate", 4).alias("on_time_rate"),
        round_dp("avg_delivery_min", 1).alias("avg_delivery_min"),
        round_dp("p90_delivery_min", 1).alias("p90_delivery_min"),
        round_dp(gmv.cast("double"), 2).alias("total_gmv_usd"),
        round_dp(gmv.cast("double") / F.nullif(F.col("__n_value").cast("double"), F.lit(0.0)), 2)
        .alias("avg_order_value_usd"),
        round_dp(F.col("total_delivery_fees_usd").cast("double"), 2).alias("total_delivery_fees_usd"),
        F.lit(True).alias("_is_synthetic_data"),
    )
