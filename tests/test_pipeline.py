"""The medallion run: gate order and outputs."""

import pytest

from merchlens.operators.quality import QualityGateError
from merchlens.plans import pipeline as PL
from merchlens.session import scratch_path
from tests.conftest import SF_SMALL


def test_pipeline_runs_and_exports(spark):
    out = PL.run_pipeline(spark, PL.raw_inputs_from_tables(spark, SF_SMALL), scratch_path(spark, "t-pipe"),
                          PL.testdata_config())
    man = {r.table_name: (r.row_count, r.column_count) for r in out["manifest"].collect()}
    assert man["merchant_performance"][1] == 22 and man["cuisine_market_share"][1] == 13
    assert man["reviewer_cohort_retention"][1] == 6 and man["delivery_operations"][1] == 20
    assert man["merchant_performance"][0] == out["merchant_performance"].count()
    assert out["silver_checks"].filter("not success").count() == 0
    assert out["mart_checks"].count() == 18 and out["mart_checks"].filter("not success").count() == 0
    floor = PL.testdata_config().review_min_date
    assert out["reviewer_cohort_retention"].filter(f"cohort_month < '{floor}'").count() == 0


def test_mart_tests_stop_before_export(spark):
    import os

    cfg = PL.testdata_config()
    cfg.mart_tests = {"cuisine_market_share": [PL.quality.in_set("state", ["NATION_1"])]}
    dest = scratch_path(spark, "t-pipe-mart")
    with pytest.raises(QualityGateError):
        PL.run_pipeline(spark, PL.raw_inputs_from_tables(spark, SF_SMALL), dest, cfg)
    local = dest.removeprefix("file:")
    assert os.path.exists(f"{local}/gold") and not os.path.exists(f"{local}/exports")


def test_run_from_folders(spark):
    from merchlens.sources import sinks

    raw, src = PL.raw_inputs_from_tables(spark, SF_SMALL), scratch_path(spark, "t-landed")
    text_ids = lambda df, *cols: df.withColumns({c: df[c].cast("string") for c in cols})
    text_ids(raw.businesses, "business_id").write.json(f"{src}/business")
    text_ids(raw.reviews.drop("review_date"), "review_id", "user_id", "business_id").write.json(f"{src}/review")
    text_ids(raw.checkins, "business_id").write.json(f"{src}/checkin")
    text_ids(raw.orders, "business_id").write.parquet(f"{src}/orders")
    out = PL.run_from_folders(spark, src, scratch_path(spark, "t-run"), PL.testdata_config())
    assert out["manifest"].count() == 4
    counts = PL.readers.ingest_folder(spark, src, dest := scratch_path(spark, "t-bronze"))
    assert counts["businesses"].rows == raw.businesses.count() and counts["reviews"].rows == raw.reviews.count()
    assert counts["checkins"].rows == raw.checkins.count() < sinks.read_back(spark, f"{dest}/checkins").count()


def test_run_from_folders_with_bad_lines(spark):
    raw, src, dest = PL.raw_inputs_from_tables(spark, SF_SMALL), scratch_path(spark, "t-landed-bad"), scratch_path(spark, "t-run-bad")
    text_ids = lambda df, *cols: df.withColumns({c: df[c].cast("string") for c in cols})
    text_ids(raw.businesses, "business_id").write.json(f"{src}/business")
    text_ids(raw.reviews.drop("review_date"), "review_id", "user_id", "business_id").write.json(f"{src}/review")
    text_ids(raw.checkins, "business_id").write.json(f"{src}/checkin")
    text_ids(raw.orders, "business_id").write.parquet(f"{src}/orders")
    spark.createDataFrame([("{broken",), ('{"review_id":"z","business_id":"1","stars":5,"date":"soon"}',)], "value string").coalesce(1).write.mode("append").text(f"{src}/review")
    out = PL.run_from_folders(spark, src, dest, PL.testdata_config())
    assert out["stg_reviews_all"].count() == raw.reviews.count()
    bad = spark.read.parquet(f"{dest}/quarantine/reviews").collect()
    assert sorted(r.reason for r in bad) == ["bad date", "not JSON"] and spark.read.parquet(f"{dest}/quarantine/businesses").count() == 0


def test_gate_stops_before_gold(spark):
    # the published review suite expects 2015..2026; the test tables hold 1995..2001
    cfg = PL.testdata_config()
    cfg.suites = {"stg_reviews": PL.quality.suite_reviews()}
    dest = scratch_path(spark, "t-pipe-fail")
    with pytest.raises(QualityGateError):
        PL.run_pipeline(spark, PL.raw_inputs_from_tables(spark, SF_SMALL), dest, cfg)
    import os
    assert not os.path.exists(f"{dest.removeprefix('file:')}/gold")


def test_independent_steps_run_at_once(spark, monkeypatch):
    import threading

    meet, write, begun = threading.Barrier(4, timeout=60), PL.sinks.write_table, []

    def waits(df, path, *args, **kwargs):
        begun.append(path)
        if "/bronze/" in path:
            meet.wait()  # the four bronze writes wait for each other
        return write(df, path, *args, **kwargs)

    monkeypatch.setattr(PL.sinks, "write_table", waits)
    cfg = PL.testdata_config()
    cfg.suites = {"stg_reviews": PL.quality.suite_reviews()}
    with pytest.raises(QualityGateError):
        PL.run_pipeline(spark, PL.raw_inputs_from_tables(spark, SF_SMALL), scratch_path(spark, "t-pipe-once"), cfg)
    assert len(begun) == 4


def test_at_once_keeps_order_properties_and_errors(spark):
    from merchlens.session import at_once

    spark.sparkContext.setLocalProperty("merchlens.test", "mine")
    ended = []

    def step(i):
        ended.append(i)
        return i, spark.sparkContext.getLocalProperty("merchlens.test")

    def fails():
        raise ValueError("no")

    assert at_once(spark, [lambda i=i: step(i) for i in range(5)]) == [(i, "mine") for i in range(5)]
    ended.clear()
    with pytest.raises(ValueError, match="no"):
        at_once(spark, [fails, lambda: step(1), lambda: step(2)])
    assert sorted(ended) == [1, 2] and at_once(spark, []) == []
    spark.sparkContext.setLocalProperty("merchlens.test", None)
