"""Registered queries: one per operator of the inventory, each a Spark
DataFrame over the whole test tables plus (where SQL can say it) the
equivalent oracle SQL. ``__spark_entry__`` exposes these."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from merchlens.plans import entities as E
from merchlens.plans.oracle import with_ctes


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = Query(key, fn, sql)
        return fn
    return deco


def _star(name: str) -> str:
    return with_ctes(f"select * from {name}", name)


# ---------------------------------------------------------------- models

@query("mod1_stage_businesses", _star("stg_businesses"))
def mod1(spark, d):
    return E.businesses(spark, d)


@query("mod2_stage_businesses_dev", _star("stg_businesses_dev"))
def mod2(spark, d):
    return E.businesses_dev(spark, d)


@query("mod3_stage_reviews", _star("stg_reviews"))
def mod3(spark, d):
    return E.reviews(spark, d)


@query("mod4_stage_checkins", _star("stg_checkins"))
def mod4(spark, d):
    return E.checkins(spark, d)


@query("mod5_stage_orders", _star("stg_orders"))
def mod5(spark, d):
    return E.orders(spark, d)


@query("mod6_merchant_activity", _star("merchant_activity"))
def mod6(spark, d):
    return E.activity(spark, d)


@query("mod7_merchant_performance", _star("merchant_performance"))
def mod7(spark, d):
    return E.performance(spark, d)


@query("mod8_cuisine_market_share", _star("cuisine_market_share"))
def mod8(spark, d):
    return E.market_share(spark, d)


@query("mod9_cohort_retention", _star("cohort_retention"))
def mod9(spark, d):
    return E.retention(spark, d)


@query("mod9_cohort_retention_dev", _star("cohort_retention_dev"))
def mod9_dev(spark, d):
    return E.retention_dev(spark, d)


@query("mod10_delivery_operations", _star("delivery_operations"))
def mod10(spark, d):
    return E.delivery_ops(spark, d)


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    from merchlens.plans import q_io, q_operators, q_quality, q_reports  # noqa: F401
    return QUERIES
