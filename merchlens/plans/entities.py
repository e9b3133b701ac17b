"""The model DAG over the driver's test tables: each function builds one
relation lazily from ``(spark, sf_dir)``; marts take their upstream as
DataFrames, so the pipeline can pass materialized tables instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchlens.functions import rules
from merchlens.operators import marts, staging
from merchlens.sources import adapters


#: Review floor that fits the test tables' 1995-2001 dates.
TESTDATA_REVIEW_FLOOR = "2000-01-01"


def prepare(spark: SparkSession) -> SparkSession:
    """Calendar fields and labels are computed in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def businesses(spark: SparkSession, d: str) -> DataFrame:
    """MOD1 with the part-name keyword filter and taxonomy of the test tables."""
    return staging.stage_businesses(
        adapters.raw_businesses(prepare(spark), d),
        keywords=rules.PART_KEYWORDS, rule_list=rules.PART_RULES, default=rules.CUISINE_DEFAULT,
    )


def businesses_dev(spark: SparkSession, d: str) -> DataFrame:
    """MOD2: no keyword filter, short rule list, unmatched text passes through."""
    return staging.stage_businesses(
        adapters.raw_businesses(prepare(spark), d),
        keywords=None, rule_list=rules.PART_DEV_RULES, default=None,
    )


def reviews(spark: SparkSession, d: str, min_date: str | None = TESTDATA_REVIEW_FLOOR) -> DataFrame:
    """MOD3 with a review floor that fits the test tables' 1995-2001 dates."""
    return staging.stage_reviews(adapters.raw_reviews(prepare(spark), d), min_date=min_date)


def reviews_all(spark: SparkSession, d: str) -> DataFrame:
    return reviews(spark, d, min_date=None)


def checkins(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_checkins(adapters.checkin_events(prepare(spark), d))


def orders(spark: SparkSession, d: str) -> DataFrame:
    return staging.stage_orders(adapters.raw_orders(prepare(spark), d))


def activity(spark: SparkSession, d: str) -> DataFrame:
    return marts.merchant_activity(businesses(spark, d), reviews(spark, d), checkins(spark, d))


def performance(spark: SparkSession, d: str) -> DataFrame:
    return marts.merchant_performance(activity(spark, d))


def market_share(spark: SparkSession, d: str, perf: DataFrame | None = None) -> DataFrame:
    return marts.cuisine_market_share(perf if perf is not None else performance(spark, d))


def retention(spark: SparkSession, d: str) -> DataFrame:
    """MOD9 from the reviews that the gate checks, above the floor."""
    return marts.cohort_retention(reviews(spark, d))


def retention_dev(spark: SparkSession, d: str) -> DataFrame:
    """The development variant: all reviews."""
    return marts.cohort_retention(reviews_all(spark, d))


def delivery_ops(spark: SparkSession, d: str, perf: DataFrame | None = None) -> DataFrame:
    return marts.delivery_operations(orders(spark, d), perf if perf is not None else performance(spark, d))
