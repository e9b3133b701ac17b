"""PIP1: the medallion run as one Python function: bronze -> silver ->
quality gate -> gold -> mart tests -> CSV export, stopping before gold when
a silver check fails and before the export when a mart test fails. Scheduling is not built; this is the data work only.

Bronze and gold are written tables (which also cuts lineage); silver stays
lazy. The merchant performance mart is written once and read back by the
marts that depend on it. Writes of one step that don't need each other run
side by side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from merchlens.functions import rules
from merchlens.operators import marts, quality, staging
from merchlens.session import at_once, scratch_path
from merchlens.sources import checked, readers, schemas, sinks


@dataclass
class PipelineConfig:
    keywords: Sequence[str] | None = rules.FOOD_KEYWORDS
    cuisine_rules: Sequence = rules.CUISINE_RULES
    cuisine_default: str | None = rules.CUISINE_DEFAULT
    review_min_date: str | None = rules.REVIEW_MIN_DATE
    retention_months: int = rules.RETENTION_MAX_MONTHS
    #: the development variant counts cohorts from all reviews, also those below the floor
    retention_from_all_reviews: bool = False
    mart_tests: dict[str, list] = field(default_factory=lambda: {
        "merchant_performance": quality.mart_tests_performance(),
        "cuisine_market_share": quality.mart_tests_market_share(),
        "reviewer_cohort_retention": quality.mart_tests_retention(),
        "delivery_operations": quality.mart_tests_delivery(),
    })
    suites: dict[str, list] = field(default_factory=lambda: {
        "stg_businesses": quality.suite_businesses(),
        "stg_reviews": quality.suite_reviews(),
        "stg_orders": quality.suite_orders(),
    })
    export_csv: bool = True


@dataclass
class RawInputs:
    businesses: DataFrame      # business documents
    reviews: DataFrame         # review documents (text date)
    checkins: DataFrame        # one row per business, comma-separated stamps
    orders: DataFrame          # order events


def run_pipeline(spark: SparkSession, raw: RawInputs, dest: str | None = None,
                 cfg: PipelineConfig | None = None) -> dict[str, DataFrame]:
    cfg = cfg or PipelineConfig()
    dest = (dest or scratch_path(spark, "pipeline")).rstrip("/")

    # ---- bronze: lineage + layout, written once
    bronze = {
        "businesses": (readers.bronze_businesses(raw.businesses), dict(partition_col="state")),
        "reviews": (readers.bronze_reviews(raw.reviews), dict(partition_col="review_year")),
        "checkins": (readers.bronze_checkins(raw.checkins), {}),
        "orders": (raw.orders, {}),
    }
    at_once(spark, [partial(sinks.write_partitioned if part else sinks.write_table, df, f"{dest}/bronze/{name}", **part)
                    for name, (df, part) in bronze.items()])
    b = {n: sinks.read_back(spark, f"{dest}/bronze/{n}", bronze[n][0].schema) for n in bronze}

    # ---- silver: lazy views over bronze
    silver = {
        "stg_businesses": staging.stage_businesses(b["businesses"], cfg.keywords, cfg.cuisine_rules,
                                                   cfg.cuisine_default),
        "stg_reviews": staging.stage_reviews(b["reviews"], cfg.review_min_date),
        "stg_reviews_all": staging.stage_reviews(b["reviews"], None),
        "stg_checkins": staging.stage_checkins(b["checkins"]),
        "stg_orders": staging.stage_orders(b["orders"]),
    }

    # ---- gate: the exact frames gold will read
    checks = quality.evaluate([(t, silver[t], cs) for t, cs in cfg.suites.items()], f"{dest}/quality/silver")
    quality.enforce(checks)

    # ---- gold
    act = marts.merchant_activity(silver["stg_businesses"], silver["stg_reviews"], silver["stg_checkins"])
    perf = marts.merchant_performance(act)
    perf_path = f"{dest}/gold/merchant_performance"
    sinks.write_layout(perf, perf_path, "state", ["primary_cuisine"], tiebreak=["business_id"])
    perf = sinks.read_back(spark, perf_path, perf.schema)
    gold = {
        "merchant_performance": perf,
        "cuisine_market_share": marts.cuisine_market_share(perf),
        "reviewer_cohort_retention": marts.cohort_retention(
            silver["stg_reviews_all" if cfg.retention_from_all_reviews else "stg_reviews"], cfg.retention_months),
        "delivery_operations": marts.delivery_operations(silver["stg_orders"], perf),
    }

    def store(name: str) -> DataFrame:
        path = f"{dest}/gold/{name}"
        schema = gold[name].schema
        sinks.write_table(gold[name], path)
        return sinks.read_back(spark, path, schema)

    later = ("cuisine_market_share", "reviewer_cohort_retention", "delivery_operations")
    gold.update(zip(later, at_once(spark, [partial(store, name) for name in later]), strict=True))

    # ---- mart tests
    mart_checks = quality.evaluate([(t, gold[t], cs) for t, cs in cfg.mart_tests.items()], f"{dest}/quality/gold")
    quality.enforce(mart_checks)

    out: dict[str, DataFrame] = {**silver, **gold, "silver_checks": checks, "mart_checks": mart_checks}
    if cfg.export_csv:
        counts = at_once(spark, [partial(sinks.export_csv, gold[name], f"{dest}/exports/{name}") for name in gold])
        exported = [(name, n, len(gold[name].columns)) for name, n in zip(gold, counts, strict=True)]
        out["manifest"] = sinks.export_manifest(spark, exported)
    return out


def run_from_folders(spark: SparkSession, src: str, dest: str, cfg: PipelineConfig | None = None) -> dict[str, DataFrame]:
    """The run from landed files: ``business``, ``review`` and ``checkin`` JSON lines and ``orders`` Parquet below ``src``. Broken lines and bad dates
    go to ``<dest>/quarantine/<source>``, also when a gate stops the run."""
    landed = {
        "businesses": checked.CheckedJson(spark, f"{src}/business", schemas.RAW_BUSINESS),
        "reviews": checked.CheckedJson(spark, f"{src}/review", schemas.RAW_REVIEW, checked.bad_date("date")),
        "checkins": checked.CheckedJson(spark, f"{src}/checkin", schemas.RAW_CHECKIN, checked.bad_stamps("date")),
    }
    raw = RawInputs(**{name: source.rows() for name, source in landed.items()}, orders=spark.read.parquet(f"{src}/orders"))
    try:
        return run_pipeline(spark, raw, dest, cfg)
    finally:
        for name, source in landed.items():
            source.settle(f"{dest.rstrip('/')}/quarantine/{name}")


def raw_inputs_from_tables(spark: SparkSession, sf_dir: str) -> RawInputs:
    """Raw inputs derived from the driver's test tables (see adapters)."""
    from merchlens.sources import adapters

    return RawInputs(
        businesses=adapters.raw_businesses(spark, sf_dir),
        reviews=adapters.raw_reviews(spark, sf_dir),
        checkins=adapters.raw_checkin_lists(spark, sf_dir),
        orders=adapters.raw_orders(spark, sf_dir),
    )


def testdata_config() -> PipelineConfig:
    """Parameters that fit the test tables: part-name rules, 1995-2001 dates, and no ceiling on row counts, as the tables
    come in any size."""
    from merchlens.plans.entities import TESTDATA_REVIEW_FLOOR

    return PipelineConfig(
        keywords=rules.PART_KEYWORDS, cuisine_rules=rules.PART_RULES,
        cuisine_default=rules.CUISINE_DEFAULT, review_min_date=TESTDATA_REVIEW_FLOOR,
        suites={
            "stg_businesses": quality.suite_businesses(max_rows=None),
            "stg_reviews": quality.suite_reviews(min_year=1992, max_rows=None),
            "stg_orders": quality.suite_orders(max_rows=None),
        },
    )

