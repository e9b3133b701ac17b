"""Sources and sinks: JSON ingest, exploded check-ins, CSV NULL tokens,
partitioned layout with pruning and pushed filters."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.operators import staging as S
from merchlens.session import scratch_path
from merchlens.sources import readers, schemas, sinks


def local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_checkin_explode_cases(spark):
    path = scratch_path(spark, "t-checkins")
    spark.createDataFrame(
        [("a", "2016-04-26 19:49:16, 2016-08-30 18:36:57"), ("b", "2017-01-01 00:00:00"), ("c", None), ("d", "")],
        "business_id string, date string").write.json(path)
    ev = readers.bronze_checkins(readers.read_json(spark, path, schemas.RAW_CHECKIN))
    got = sorted((r.business_id, r.checkin_at) for r in ev.filter(F.col("checkin_at").isNotNull()).collect())
    assert got == [("a", dt.datetime(2016, 4, 26, 19, 49, 16)), ("a", dt.datetime(2016, 8, 30, 18, 36, 57)),
                   ("b", dt.datetime(2017, 1, 1, 0, 0))]
    assert {"_ingested_at", "_source_file", "_batch_date"} <= set(ev.columns)
    daily = S.stage_checkins(ev).collect()
    assert sum(r.checkin_count for r in daily) == 3


def test_review_date_parses_both_formats(spark):
    path = scratch_path(spark, "t-reviews")
    rows = [("r1", "u", "b", 4.0, 0, 0, 0, "t", "2019-03-04"), ("r2", "u", "b", 4.0, 0, 0, 0, "t", "2019-03-05 10:11:12")]
    spark.createDataFrame(rows, schemas.RAW_REVIEW).write.json(path)
    b = readers.bronze_reviews(readers.read_json(spark, path, schemas.RAW_REVIEW))
    got = sorted((r.review_date, r.review_year) for r in b.collect())
    assert got == [(dt.date(2019, 3, 4), 2019), (dt.date(2019, 3, 5), 2019)]


def test_csv_null_tokens(spark):
    path = scratch_path(spark, "t-csv")
    os.makedirs(local(path))
    with open(os.path.join(local(path), "part.csv"), "w") as f:
        f.write("cohort_month,cohort_label,months_since_cohort,cohort_size,retained_users,retention_rate_pct\n")
        f.write('2019-01-01,"2019-01",0,41,41,100.0\n')
        f.write("2019-02-01,None,1.0,54,,NULL\n")
    got = readers.read_mart_csv(spark, path, schemas.MART_RETENTION).orderBy("cohort_month").collect()
    assert got[0].cohort_size == 41 and got[0].retention_rate_pct == 100.0
    assert got[1].cohort_label is None and got[1].retained_users is None and got[1].retention_rate_pct is None
    assert got[1].months_since_cohort == 1


def test_csv_keeps_breaks_quotes_and_commas(spark):
    rows = [(1, 'two\nlines, a "quote"'), (2, " spaces around "), (3, "a\r\nb"), (4, '"'), (5, "x,y"), (6, None), (7, "")]
    df = spark.createDataFrame(rows, "id long, text string")
    path = scratch_path(spark, "t-csv-breaks")
    sinks.export_csv(df, path, null_value="None")
    got = sorted(tuple(r) for r in readers.read_csv_with_null_tokens(spark, path, df.schema, null_tokens=("None",)).collect())
    assert got == rows


def test_a_bad_number_stops_the_load(spark):
    import pytest
    from pyspark.errors import PySparkException

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType())])
    for text, fine in (("15.0,1.5", True), ("15.7,1", False), ("abc,1", False), ("1,abc", False), ("NULL,None", True)):
        path = scratch_path(spark, "t-csv-strict")
        os.makedirs(local(path))
        with open(os.path.join(local(path), "part.csv"), "w") as f:
            f.write(f"n,x\n{text}\n")
        df = readers.read_csv_with_null_tokens(spark, path, schema)
        if fine:
            assert df.count() == 1 and df.first().n in (15, None)
        else:
            with pytest.raises(PySparkException):
                df.collect()


def test_contracts_have_published_widths():
    assert {k: len(v.fields) for k, v in schemas.CONTRACTS.items()} == {
        "merchant_performance": 22, "cuisine_market_share": 13, "reviewer_cohort_retention": 6, "delivery_operations": 20}


def test_layout_prunes_partitions_and_pushes_filters(spark):
    df = spark.createDataFrame([(i, ["PA", "AZ", "NV"][i % 3], ["Pizza", "Thai"][i % 2], float(i))
                                for i in range(300)], "business_id long, state string, primary_cuisine string, s double")
    path = scratch_path(spark, "t-layout")
    n = sinks.write_layout(df, path, "state", ["primary_cuisine"], tiebreak=["business_id"], num_partitions=4)
    assert n == 300
    back = sinks.read_back(spark, path, df.schema)
    q = back.filter((F.col("state") == "PA") & (F.col("primary_cuisine") == "Pizza")).select("business_id", "s")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan and "PushedFilters: [IsNotNull(primary_cuisine)," in plan
    assert "ReadSchema: struct<business_id:bigint,primary_cuisine:string,s:double>" in plan
    assert q.count() == 50
    assert sorted(x for x in os.listdir(local(path)) if x.startswith("state=")) == \
        ["state=AZ", "state=NV", "state=PA"]


def test_write_observes_rows_and_manifest(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    path = scratch_path(spark, "t-export")
    assert sinks.export_csv(df, path) == 10
    m = sinks.export_manifest(spark, [("t", 10, 2)]).first()
    assert (m.table_name, m.row_count, m.column_count) == ("t", 10, 2)
    back = spark.read.schema(T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.LongType())])) \
        .option("header", True).csv(path)
    assert back.count() == 10


def test_layout_pruning_reads_fewer_rows(spark):
    from merchlens.plans.diagnostics import layout_pruning
    from tests.conftest import SF_SMALL

    d = layout_pruning(spark, SF_SMALL, "NATION_1", "Parts")
    assert d["state_filter_rows_scanned_partitioned"] < d["state_filter_rows_scanned_flat"]
    assert d["state_filter_rows_scanned_flat"] == d["mart_rows"]
    assert d["state_cuisine_rows_scanned_partitioned_clustered"] <= d["state_filter_rows_scanned_partitioned"]
