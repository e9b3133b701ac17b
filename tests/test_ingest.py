"""Tolerant ingest, schema drift, and CSV files dealt to many tasks."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.operators import staging
from merchlens.session import scratch_path
from merchlens.sources import checked, csv_blocks, drift, readers, schemas, sinks


def put(spark, name, lines):
    path = scratch_path(spark, name)
    local = path.removeprefix("file:")
    os.makedirs(local)
    with open(f"{local}/part.json", "w", newline="") as f:
        f.write("\n".join(lines))
    return path


def review(i, **other):
    import json
    return json.dumps({"review_id": f"r{i}", "user_id": "u", "business_id": "b7x", "stars": 4.0, "useful": 1, "funny": 0, "cool": 0, "text": "t", "date": "2019-03-04"} | other)


def test_bad_lines_and_dates_are_kept_apart(spark):
    lines = [review(1), '{"review_id": "r2", "sta', "plain text", "[1, 2]", '"word"', "", "   ", review(3, stars="many"), review(4, date="not a date"),
             review(5, date="2019-02-30"), review(6, date=None), review(7, date="2020-01-05 10:11:12"), review(8, more=1), "{}", "null", review(9) + "}"]
    src, dest = put(spark, "t-bad", lines), scratch_path(spark, "t-bad-bronze")
    got = readers.ingest_reviews(spark, src, dest)
    rows = {r.review_id: r for r in spark.read.parquet(dest).collect()}
    bad = sorted((r.reason, r.record) for r in spark.read.parquet(f"{dest}_quarantine").collect())
    assert set(rows) == {"r1", "r4", "r5", "r6", "r7", "r8", None} | ({"r9"} & set(rows))
    assert rows["r4"].review_date is None and rows["r5"].review_date is None and str(rows["r7"].review_date) == "2020-01-05"
    reasons = {record: reason for reason, record in bad}
    assert reasons[lines[1]] == reasons["plain text"] == reasons["[1, 2]"] == reasons['"word"'] == reasons["null"] == checked.NOT_JSON
    assert reasons[lines[7]] == checked.NO_FIT and reasons[lines[8]] == reasons[lines[9]] == checked.BAD_DATE
    assert got == checked.Ingested(len(rows), len(bad) - 2, 2) and len(rows) + len(bad) - 2 == 14
    assert all("t-bad" in r.source_file for r in spark.read.parquet(f"{dest}_quarantine").collect())
    assert {r.review_id for r in staging.stage_reviews(spark.read.parquet(dest)).collect()} >= {"r1", "r7", "r8"}
    assert not {"r4", "r5", "r6", None} & {r.review_id for r in staging.stage_reviews(spark.read.parquet(dest)).collect()}


def test_clean_input_is_read_once_and_leaves_an_empty_quarantine(spark):
    src, dest = put(spark, "t-clean", [review(i) for i in range(5)]), scratch_path(spark, "t-clean-bronze")
    assert readers.ingest_reviews(spark, src, dest) == checked.Ingested(5, 0, 0)
    assert spark.read.parquet(f"{dest}_quarantine").count() == 0
    empty = put(spark, "t-none", [])
    assert readers.ingest_businesses(spark, empty, scratch_path(spark, "t-none-bronze")) == checked.Ingested(0, 0, 0)


def test_bad_stamps(spark):
    lines = ['{"business_id":"a","date":"2016-04-26 19:49:16, 2016-13-30 18:36:57"}', '{"business_id":"b","date":""}', '{"business_id":"c"}', '{"business_id":"d","date":"2017-01-01 00:00:00"}']
    src, dest = put(spark, "t-stamps", lines), scratch_path(spark, "t-stamps-bronze")
    assert readers.ingest_checkins(spark, src, dest) == checked.Ingested(4, 0, 1)
    assert spark.read.parquet(f"{dest}_quarantine").first().record == lines[0]
    assert spark.read.parquet(dest).filter("checkin_at is not null").count() == 2


def test_drift_is_told_and_new_fields_load(spark):
    lines = ['{"business_id":"a1","name":"x","stars":4.5,"review_count":"many","tags":["p"],"hours":{"Monday":"9","Holiday":"10"},"latitude":1,"state":"S"}',
             '{"business_id":"a2","name":"y","stars":3,"review_count":7,"owner":{"since":2001},"state":"S","void":null}', "broken"]
    src, dest = put(spark, "t-drift", lines), scratch_path(spark, "t-drift-bronze")
    seen, changes = readers.ingest_evolving(spark, src, dest, "business", share=1.0)
    told = {(r.field, r.change): (r.declared_type, r.found_type) for r in changes.collect()}
    assert told["review_count", drift.RETYPED] == ("bigint", "string") and told["tags", drift.NEW][1] == "array<string>"
    assert ("hours.Holiday", drift.NEW) in told and ("hours.Tuesday", drift.GONE) in told and ("owner", drift.NEW) in told and ("address", drift.GONE) in told
    assert not {"stars", "latitude", "name"} & {f for f, _ in told}
    assert seen == checked.Ingested(1, 2, 0)
    row = spark.read.parquet(dest).first()
    assert (row.business_id, row.owner.since, row.tags, row.review_count) == ("a2", 2001, None, 7)
    assert [r.reason for r in spark.read.parquet(f"{dest}_quarantine").orderBy("reason").collect()] == [checked.NOT_JSON, checked.NO_FIT]
    assert spark.read.parquet(f"{dest}_drift").count() == len(told)
    readers.ingest_evolving(spark, put(spark, "t-drift2", [lines[1].replace("owner", "holder")]), dest, "business", share=1.0)
    assert "holder" in spark.read.parquet(dest).columns and "owner" not in spark.read.parquet(dest).columns


def hostile(n, seed):
    r = random.Random(seed)
    bits = ['"', '""', "\n", "\r\n", ",", " ", "a", "é", "日本", "x" * 50, "\n\n\n", '",\n"', "NULL", "\t", "\\", "line\n" * 30]
    return [(i, r.choice([None, "", "plain", "".join(r.choices(bits, k=r.randint(1, 12)))]), r.choice([None, "".join(r.choices(bits, k=3)), "end\r", "\r"]), i / 3) for i in range(n)]


SCHEMA = "id long, text string, note string, x double"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_one_file_is_dealt_to_many_tasks(spark, small_splits, seed, threshold):
    df = spark.createDataFrame(hostile(600, seed), SCHEMA)
    path = scratch_path(spark, "t-blocks")
    sinks.export_csv(df.coalesce(1), path, null_value="None")
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]
    assert len(files) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = csv_blocks.records(spark, path)
        assert found.select("block").distinct().count() > 10
        assert found.count() == 601
        got = csv_blocks.read_csv_blocks(spark, path, df.schema)
        key = lambda r: tuple((x is None, str(x)) for x in r)
        whole = readers.read_csv(spark, path, df.schema)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)
        strict = readers.read_csv_with_null_tokens(spark, path, df.schema, null_tokens=("None",))
        assert sorted(map(tuple, strict.collect()), key=key) == sorted(map(tuple, df.collect()), key=key)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_record_over_many_blocks_and_several_files(spark, small_splits):
    rows = [(1, "start", None, 1.0), (2, "long\n" * 3000, "after", 2.0), (3, '"\n' * 2000, None, 3.0), (4, "end", "", 4.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = scratch_path(spark, "t-long-record")
    sinks.export_csv(df.repartition(3), path, null_value="None")
    got = readers.read_csv_with_null_tokens(spark, path, df.schema, null_tokens=("None",))
    assert sorted(map(tuple, got.collect())) == rows


def test_windows_line_ends_and_no_last_break(spark, small_splits):
    path = put(spark, "t-crlf", ['id,text\r', '1,"a\r', 'b"\r', "\r", "2,c\r", '3,"d"'])
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    assert sorted(map(tuple, csv_blocks.read_csv_blocks(spark, path, schema).collect())) == [(1, "a\r\nb"), (2, "c"), (3, "d")]
    assert csv_blocks.read_csv_blocks(spark, put(spark, "t-only-head", ["id,text"]), schema).count() == 0
    assert csv_blocks.read_csv_blocks(spark, put(spark, "t-empty-file", []), schema).count() == 0


def test_contracts_load_ids_with_letters(spark):
    for name, contract in schemas.CONTRACTS.items():
        if "business_id" not in contract.names:
            continue
        path = put(spark, f"t-{name}", [",".join(contract.names), ",".join("b-7Qx" if n == "business_id" else "NULL" for n in contract.names)])
        assert readers.read_mart_csv(spark, path, contract).first().business_id == "b-7Qx"


def test_every_arm_of_the_published_lists(spark):
    from merchlens.functions import columns as C
    from merchlens.functions import rules

    arms = [(" ".join(w.upper() for w in reversed(words)), label) for label, words in rules.CUISINE_RULES] + [("nothing", "Other"), (None, "Other"), ("seabar", "Other")]
    got = spark.createDataFrame(arms, "text string, want string").withColumn("got", C.taxonomy("text", rules.CUISINE_RULES, rules.CUISINE_DEFAULT))
    assert [r for r in got.collect() if r.got != r.want] == []
    assert spark.createDataFrame([(w.title(),) for w in rules.FOOD_KEYWORDS], "t string").filter(C.keyword_any("t", rules.FOOD_KEYWORDS)).count() == 16
    assert got.filter(F.col("text") == "nothing").filter(C.keyword_any("text", rules.FOOD_KEYWORDS)).count() == 0
