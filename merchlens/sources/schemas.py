"""Explicit schemas for raw documents and mart extracts (no inference pass)."""

from __future__ import annotations

from pyspark.sql import types as T

HOURS = T.StructType(
    [T.StructField(d, T.StringType()) for d in
     ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")]
)

RAW_BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("is_open", T.IntegerType()),
    T.StructField("categories", T.StringType()),
    T.StructField("hours", HOURS),
])

RAW_REVIEW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("useful", T.LongType()),
    T.StructField("funny", T.LongType()),
    T.StructField("cool", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.StringType()),
])

RAW_CHECKIN = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("date", T.StringType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    T.StructField("courier_id", T.StringType()),
    T.StructField("order_timestamp", T.TimestampType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("order_hour", T.IntegerType()),
    T.StructField("order_day_of_week", T.StringType()),
    T.StructField("estimated_delivery_min", T.IntegerType()),
    T.StructField("actual_delivery_min", T.IntegerType()),
    T.StructField("delivery_delta_min", T.IntegerType()),
    T.StructField("is_on_time", T.BooleanType()),
    T.StructField("order_total_usd", T.DoubleType()),
    T.StructField("delivery_fee_usd", T.DoubleType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("_is_synthetic", T.BooleanType()),
])

# Mart extract contracts (the warehouse load DDL): column -> Spark type name.
MART_MARKET_SHARE = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("primary_cuisine", T.StringType()),
    T.StructField("merchant_count", T.LongType()),
    T.StructField("total_merchants_in_state", T.LongType()),
    T.StructField("market_share_pct", T.DoubleType()),
    T.StructField("avg_stars", T.DoubleType()),
    T.StructField("avg_reviews_per_month", T.DoubleType()),
    T.StructField("avg_checkins", T.DoubleType()),
    T.StructField("avg_composite_score", T.DoubleType()),
    T.StructField("total_reviews_in_segment", T.LongType()),
    T.StructField("open_merchant_count", T.LongType()),
    T.StructField("elite_merchant_share", T.DoubleType()),
    T.StructField("cuisine_rank_in_state", T.LongType()),
])

MART_RETENTION = T.StructType([
    T.StructField("cohort_month", T.DateType()),
    T.StructField("cohort_label", T.StringType()),
    T.StructField("months_since_cohort", T.LongType()),
    T.StructField("cohort_size", T.LongType()),
    T.StructField("retained_users", T.LongType()),
    T.StructField("retention_rate_pct", T.DoubleType()),
])

MART_PERFORMANCE = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("business_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("primary_cuisine", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("is_open", T.BooleanType()),
    T.StructField("listing_stars", T.DoubleType()),
    T.StructField("avg_review_stars", T.DoubleType()),
    T.StructField("total_reviews", T.LongType()),
    T.StructField("reviews_per_month", T.DoubleType()),
    T.StructField("total_checkins", T.LongType()),
    T.StructField("active_checkin_days", T.LongType()),
    T.StructField("positive_review_ratio", T.DoubleType()),
    T.StructField("active_years", T.LongType()),
    T.StructField("composite_score", T.DoubleType()),
    T.StructField("performance_tier", T.LongType()),
    T.StructField("state_performance_tier", T.LongType()),
    T.StructField("tier_label", T.StringType()),
    T.StructField("is_elite_merchant", T.BooleanType()),
    T.StructField("is_closed", T.BooleanType()),
])

MART_DELIVERY = T.StructType([
    T.StructField("business_id", T.StringType()),
    T.StructField("business_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("primary_cuisine", T.StringType()),
    T.StructField("performance_tier", T.LongType()),
    T.StructField("tier_label", T.StringType()),
    T.StructField("order_month", T.DateType()),
    T.StructField("order_day_of_week", T.StringType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("delivered_orders", T.LongType()),
    T.StructField("cancelled_orders", T.LongType()),
    T.StructField("fulfillment_rate", T.DoubleType()),
    T.StructField("on_time_rate", T.DoubleType()),
    T.StructField("avg_delivery_min", T.DoubleType()),
    T.StructField("p90_delivery_min", T.DoubleType()),
    T.StructField("total_gmv_usd", T.DoubleType()),
    T.StructField("avg_order_value_usd", T.DoubleType()),
    T.StructField("total_delivery_fees_usd", T.DoubleType()),
    T.StructField("_is_synthetic_data", T.BooleanType()),
])

#: The load contracts by mart.
CONTRACTS = {
    "merchant_performance": MART_PERFORMANCE, "cuisine_market_share": MART_MARKET_SHARE,
    "reviewer_cohort_retention": MART_RETENTION, "delivery_operations": MART_DELIVERY,
}


def with_long_ids(contract: T.StructType) -> T.StructType:
    """The contract for the test tables, whose merchants have numbers."""
    return T.StructType([T.StructField(f.name, T.LongType()) if f.name == "business_id" else f for f in contract.fields])
