import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from merchlens.llm import decontaminate, order_minhash, queries, secrets
from tests.conftest import SF_MID, SF_SMALL


def run_stages(spark, docs, sf_dir, folder):
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], sf_dir).write.parquet(f"{folder}/{name}")
        seen.append(spark.read.parquet(f"{folder}/{name}"))
    return seen


def test_decisions_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    start, calm, single, clean, masked, ids = run_stages(spark, docs, SF_MID, tmp_path)
    assert start.columns == calm.columns == single.columns == clean.columns == masked.columns
    assert start.count() > calm.count() > single.count() > clean.count() == masked.count() == ids.count()
    left = order_minhash.near_duplicates(single)
    assert left.filter("class_size > 1").count() == 0
    classes = order_minhash.near_duplicates(calm).select("class_id").distinct().count()
    assert classes == single.count()
    assert decontaminate.decontaminate(clean, spark.read.parquet(f"{SF_MID}/benchmark.parquet")).filter("size(hits) > 0").count() == 0
    assert secrets.scan_secrets(masked).filter("size(secrets.spans) > 0").count() == 0
    whole = clean.join(masked.withColumnRenamed("text", "after"), "doc_id")
    spans = secrets.scan_secrets(clean).filter("size(secrets.spans) > 0").count()
    assert whole.filter("text != after").count() == spans
    assert ids.filter("n_tokens = 0").count() == 0


def test_odd_rows(spark, odd, tmp_path):
    docs = odd.select("doc_id", "text").selectExpr("doc_id", "text", "'en' as lang", "cast(null as string) as source", "cast(length(text) as bigint) as n_chars", "1 as key")
    seen = run_stages(spark, docs, SF_SMALL, tmp_path)
    # null and empty texts are one class, the repeated row stays once
    assert seen[-1].count() == odd.count() - 3


def test_columns_of_any_name_pass_through(spark, tmp_path):
    names = ["_id", "_key", "_copy", "_score", "_secrets", "_id_", "node", "hub"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("*", *[f"doc_id + {i} as {n}" for i, n in enumerate(names)])
    for docs_now in run_stages(spark, docs, SF_SMALL, tmp_path)[1:-1]:
        assert docs_now.columns == docs.columns and docs_now.count() > 50
        assert docs_now.filter(" or ".join(f"{n} != doc_id + {i}" for i, n in enumerate(names))).count() == 0


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert run_stages(spark, docs, SF_SMALL, tmp_path)[-1].count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_sql_equals_queries(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[key](spark, SF_SMALL)
    want = con.execute(f"select {', '.join(df.columns)} from ({queries.ORACLE_SQL[key]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_sql_of_secrets_on_tricky_texts(spark):
    rng = random.Random(9)
    pool = ["password", "SECRET", "token", "=", ": ", '"', " ", "é", "AKIA", "ABCDEF0123", "0123456789abcdef", "Zk3Vq8LmT1", "rB7yWcP5sD0aHj", "-", "/", "\n", "example"]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randrange(0, 30)))) for i in range(200)] + [(500, None)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    want = con.execute(f"select doc_id, spans from ({secrets.OP8_SQL})").fetchall()
    got = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", secrets.spelled(secrets.F.col("secrets.spans")))
    assert sorted(map(tuple, got.collect())) == sorted(want) and any("entropy" in s for _, s in want)
