"""Registered source and sink round trips (SRC1-SRC9, SNK1-SNK10, FLT9) and
the pipeline (PIP1). Each writes whole tables under the shared folder named
by ``spark.checkpoint.dir`` and returns a DataFrame read back from it; the
oracle is the plain query on the input tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.operators import reports as R
from merchlens.operators import staging
from merchlens.plans import entities as E
from merchlens.plans import pipeline as PL
from merchlens.plans.catalog import query
from merchlens.plans.oracle import with_ctes
from merchlens.plans.q_reports import REPORT_CUISINE, REPORT_STATE
from merchlens.session import scratch_path
from merchlens.sources import adapters, csv_blocks, readers, schemas, sinks

_RAW_B = ("business_id, name, address, city, state, postal_code, latitude, longitude, stars, "
          "review_count, is_open, categories")


@query("src1_json_scan_with_schema", with_ctes(f"select {_RAW_B} from raw_businesses", "raw_businesses"))
def src1(spark, d):
    raw = adapters.raw_businesses(E.prepare(spark), d)
    path = scratch_path(spark, "src1-json")
    sinks.write_table(raw, path, fmt="json")
    return readers.read_json(spark, path, raw.schema)


#: Lines of the orders as review documents: every tenth is cut off, every tenth has no date, every tenth a text for its stars.
_LINES_SQL = """(select o_orderkey, case when o_orderkey % 10 = 0 then '{"review_id":"r' || o_orderkey
           else '{"review_id":"r' || o_orderkey || '","business_id":"b' || o_custkey || '","stars":' || case when o_orderkey % 10 = 2 then '"many"' else '4.5' end
                || ',"date":"' || case when o_orderkey % 10 = 1 then 'the ' || o_orderkey || 'th' else strftime(o_orderdate, '%Y-%m-%d') end || '"}' end as line
    from orders)"""


@query("src1_quarantine", f"""
    select 'row' as outcome, 'r' || o_orderkey as review_id, case when o_orderkey % 10 <> 1 then substr(line, length(line) - 11, 10)::date end as review_date,
           null as record, null as named from {_LINES_SQL} where o_orderkey % 10 not in (0, 2)
    union all
    select case o_orderkey % 10 when 0 then 'not JSON' when 1 then 'bad date' else 'value does not fit' end, null, null, line, true
    from {_LINES_SQL} where o_orderkey % 10 <= 2""")
def src1_quarantine(spark, d):
    """SRC1 + SRC3 on files with broken lines and bad dates: the rows that load and the quarantine table."""
    o, key = adapters.table(E.prepare(spark), d, "orders"), F.col("o_orderkey")
    kind = key % 10
    line = F.when(kind == 0, F.concat(F.lit('{"review_id":"r'), key)).otherwise(F.concat(
        F.lit('{"review_id":"r'), key, F.lit('","business_id":"b'), "o_custkey", F.lit('","stars":'), F.when(kind == 2, '"many"').otherwise("4.5"),
        F.lit(',"date":"'), F.when(kind == 1, F.concat(F.lit("the "), key, F.lit("th"))).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit('"}')))
    src, dest = scratch_path(spark, "src1-lines"), scratch_path(spark, "src1-bronze")
    o.select(line.alias("value")).write.text(src)
    readers.ingest_reviews(spark, src, dest)
    rows = spark.read.parquet(dest).select(F.lit("row").alias("outcome"), "review_id", "review_date", F.lit(None).cast("string").alias("record"), F.lit(None).cast("boolean").alias("named"))
    bad = spark.read.parquet(f"{dest}_quarantine").select(
        F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("review_id"), F.lit(None).cast("date").alias("review_date"), "record",
        F.col("source_file").contains("src1-lines").alias("named"))
    return rows.unionByName(bad)


@query("src1_schema_drift", """
    select c_custkey::varchar as business_id, c_name as name, c_mktsegment as segment, c_acctbal as balance,
           'account:new categories:gone latitude:gone longitude:gone postal_code:gone review_count:gone segment:new stars:gone' as changes
    from customer""")
def src1_drift(spark, d):
    """An ingest of documents with new and missing fields: the table has the new ones, and the drift table tells of all."""
    c = adapters.table(E.prepare(spark), d, "customer")
    src, dest = scratch_path(spark, "drift-json"), scratch_path(spark, "drift-bronze")
    c.select(F.col("c_custkey").cast("string").alias("business_id"), F.col("c_name").alias("name"), F.lit("").alias("address"), F.lit("x").alias("city"), F.lit("S").alias("state"),
             F.lit(1).alias("is_open"), F.struct(F.lit("9-17").alias("Monday")).alias("hours"),
             F.col("c_mktsegment").alias("segment"), F.struct(F.col("c_acctbal").alias("balance")).alias("account")).write.json(src)
    _, changes = readers.ingest_evolving(spark, src, dest, "business", share=1.0)
    told = changes.filter("field not like '%.%'").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "field", "change"))), " ").alias("changes"))
    return spark.read.parquet(dest).select("business_id", "name", "segment", F.col("account.balance").alias("balance")).join(told)


@query("src2_ingest_businesses", with_ctes(f"select {_RAW_B} from raw_businesses", "raw_businesses"))
def src2(spark, d):
    """JSON documents -> lineage -> state-partitioned bronze -> read back."""
    raw = adapters.raw_businesses(E.prepare(spark), d)
    src = scratch_path(spark, "src2-json")
    sinks.write_table(raw, src, fmt="json")
    bronze = readers.bronze_businesses(readers.read_json(spark, src, raw.schema), "business.json")
    dest = scratch_path(spark, "src2-bronze")
    sinks.write_partitioned(bronze, dest, "state")
    back = sinks.read_back(spark, dest, bronze.schema)
    return back.select(*[c.strip() for c in _RAW_B.split(",")])


@query("src3_ingest_reviews", """
    select o_orderkey as review_id, o_custkey as user_id, o_custkey as business_id,
           cast(6 - cast(substr(o_orderpriority, 1, 1) as integer) as double) as stars,
           cast(o_orderdate as date) as review_date, cast(year(o_orderdate) as integer) as review_year
    from orders""")
def src3(spark, d):
    """Review documents with a text date -> parsed date -> year-partitioned bronze."""
    raw = adapters.raw_reviews(E.prepare(spark), d)
    src = scratch_path(spark, "src3-json")
    sinks.write_table(raw, src, fmt="json")
    bronze = readers.bronze_reviews(readers.read_json(spark, src, raw.schema), "review.json")
    dest = scratch_path(spark, "src3-bronze")
    sinks.write_partitioned(bronze, dest, "review_year")
    back = sinks.read_back(spark, dest, bronze.schema)
    return back.select("review_id", "user_id", "business_id", "stars", "review_date", "review_year")


@query("src4_explode_checkins", with_ctes("select * from stg_checkins", "stg_checkins"))
def src4(spark, d):
    """Comma-separated stamp lists -> split, explode, parse -> daily counts."""
    raw = adapters.raw_checkin_lists(E.prepare(spark), d)
    src = scratch_path(spark, "src4-json")
    sinks.write_table(raw, src, fmt="json")
    docs = readers.read_json(spark, src, raw.schema)
    dest = scratch_path(spark, "src4-bronze")
    sinks.write_table(readers.bronze_checkins(docs), dest)
    return staging.stage_checkins(sinks.read_back(spark, dest))


@query("src5_parquet_orders", with_ctes("select * from raw_orders", "raw_orders"))
def src5(spark, d):
    raw = adapters.raw_orders(E.prepare(spark), d)
    path = scratch_path(spark, "src5-orders")
    sinks.write_table(raw, path)
    return sinks.read_back(spark, path)


@query("src6_catalog_view_scan", with_ctes("select * from stg_businesses", "stg_businesses"))
def src6(spark, d):
    name = f"stg_businesses_{uuid.uuid4().hex[:12]}"
    sinks.register_view(E.businesses(spark, d), name)
    return sinks.read_view(spark, name)


@query("src7_seed_csv_scan", with_ctes(
    "select review_id, user_id, business_id, review_stars, review_date, sentiment_bucket from stg_reviews_all",
    "stg_reviews_all"))
def src7(spark, d):
    rev = E.reviews_all(spark, d).select("review_id", "user_id", "business_id", "review_stars",
                                         "review_date", "sentiment_bucket")
    path = scratch_path(spark, "src7-csv")
    sinks.export_csv(rev, path)
    return readers.read_csv(spark, path, rev.schema)


@query("src7_csv_of_texts", "select doc_id, text, source from documents")
def src7_texts(spark, d):
    """Texts with line breaks, quotes and commas through CSV and back."""
    docs = adapters.table(E.prepare(spark), d, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "src7-texts")
    sinks.export_csv(docs, path)
    return readers.read_csv(spark, path, docs.schema)


@query("src7_csv_blocks", "select doc_id, text, source from documents")
def src7_blocks(spark, d):
    """The same texts by the reader that deals a file to many tasks."""
    docs = adapters.table(E.prepare(spark), d, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "src7-blocks")
    sinks.export_csv(docs, path)
    return csv_blocks.read_csv_blocks(spark, path, docs.schema)


@query("src9_csv_null_tokens", with_ctes("select * from merchant_performance", "merchant_performance"))
def src9(spark, d):
    """Mart extract whose NULLs are written as 'None' and 'NULL' tokens (two
    parts) and read back with the multi-token contract reader."""
    perf = E.performance(spark, d)
    path = scratch_path(spark, "src9-csv")
    no_reviews = F.col("total_reviews") == 0
    sinks.export_csv(perf.filter(no_reviews), f"{path}/a", null_value="None")
    sinks.export_csv(perf.filter(~no_reviews), f"{path}/b", null_value="NULL")
    return readers.read_mart_csv(spark, [f"{path}/a", f"{path}/b"], schemas.with_long_ids(schemas.CONTRACTS["merchant_performance"]))


@query("src9_retention_contract", with_ctes("select * from cohort_retention", "cohort_retention"))
def src9_retention(spark, d):
    path = scratch_path(spark, "src9-retention")
    sinks.export_csv(E.retention(spark, d), path, null_value="NULL")
    return readers.read_mart_csv(spark, path, schemas.CONTRACTS["reviewer_cohort_retention"])


@query("src9_delivery_contract", with_ctes("select * from delivery_operations", "delivery_operations"))
def src9_delivery(spark, d):
    path = scratch_path(spark, "src9-delivery")
    sinks.export_csv(E.delivery_ops(spark, d), path, null_value="None")
    return readers.read_mart_csv(spark, path, schemas.with_long_ids(schemas.CONTRACTS["delivery_operations"]))


@query("flt9_state_partition_pruning", with_ctes(
    f"select * from stg_businesses where state = '{REPORT_STATE}'", "stg_businesses"))
def flt9(spark, d):
    """SNK2 + FLT9: state-partitioned layout; the state filter prunes folders."""
    b = E.businesses(spark, d)
    path = scratch_path(spark, "flt9-layout")
    sinks.write_layout(b, path, "state", ["primary_cuisine"], tiebreak=["business_id"])
    return sinks.read_back(spark, path, b.schema).filter(F.col("state") == REPORT_STATE)


@query("flt9_runtime_pruning", with_ctes(
    f"select o.*, m.listing_stars, m.composite_score from delivery_operations o join merchant_performance m "
    f"on o.state = m.state and o.business_id = m.business_id where m.is_elite_merchant and m.city = '{REPORT_STATE}'", "delivery_operations", "merchant_performance"))
def flt9_runtime(spark, d):
    """FLT9 + JON8: operations laid out by state, joined with merchants that a filter on another column picks; Spark prunes the other states' folders at run time."""
    at, perf = scratch_path(spark, "flt9-perf"), E.performance(spark, d)
    sinks.write_table(perf, at)
    perf = spark.read.parquet(at)
    ops = E.delivery_ops(spark, d, perf)
    path = scratch_path(spark, "flt9-ops")
    sinks.write_layout(ops, path, "state", ["order_month"], tiebreak=["business_id"])
    return R.operations_of(sinks.read_back(spark, path, ops.schema), perf.filter(F.col("is_elite_merchant") & (F.col("city") == REPORT_STATE)))


@query("snk1_published_versions", with_ctes(
    "select *, (select count(*) from raw_businesses) as raw_rows_before from stg_businesses", "stg_businesses", "raw_businesses"))
def snk1_published(spark, d):
    """Two versions of a table published one after the other: the current one is the staged businesses, and the first can still be read."""
    path = scratch_path(spark, "published")
    first, _ = sinks.publish(adapters.raw_businesses(E.prepare(spark), d), path)
    sinks.publish(E.businesses(spark, d), path)
    before = sinks.read_published(spark, path, first).agg(F.count(F.lit(1)).alias("raw_rows_before"))
    return sinks.read_published(spark, path).join(before)


@query("snk3_partition_by_derived_year", with_ctes(
    "select * from stg_reviews_all where review_year = 1998", "stg_reviews_all"))
def snk3(spark, d):
    rev = E.reviews_all(spark, d).drop("review_year")
    path = scratch_path(spark, "snk3")
    sinks.write_partitioned_by_derived(rev, path, "review_year", F.year("review_date"))
    schema = T.StructType(rev.schema.fields + [T.StructField("review_year", T.IntegerType())])
    back = sinks.read_back(spark, path, schema)
    return back.filter(F.col("review_year") == 1998)


@query("snk7_csv_export", with_ctes("select * from cuisine_market_share", "cuisine_market_share"))
def snk7(spark, d):
    share = E.market_share(spark, d)
    path = scratch_path(spark, "snk7-csv")
    sinks.export_csv(share, path)
    return readers.read_mart_csv(spark, path, schemas.CONTRACTS["cuisine_market_share"])


@query("snk10_partition_cluster_layout", with_ctes(
    f"select business_id, business_name, composite_score, reviews_per_month from merchant_performance "
    f"where state = '{REPORT_STATE}' and primary_cuisine = '{REPORT_CUISINE}'", "merchant_performance"))
def snk10(spark, d):
    perf = E.performance(spark, d)
    path = scratch_path(spark, "snk10-layout")
    sinks.write_layout(perf, path, "state", ["primary_cuisine"], tiebreak=["business_id"])
    back = sinks.read_back(spark, path, perf.schema)
    return back.filter((F.col("state") == REPORT_STATE) & (F.col("primary_cuisine") == REPORT_CUISINE)) \
        .select("business_id", "business_name", "composite_score", "reviews_per_month")


@query("pip1_pipeline_manifest", with_ctes(
    "\nunion all\n".join([
        "select 'merchant_performance' as table_name, count(*) as row_count, 22::bigint as column_count, 7::bigint as mart_tests_passed "
        "from merchant_performance",
        "select 'cuisine_market_share', count(*), 13::bigint, 4::bigint from cuisine_market_share",
        "select 'reviewer_cohort_retention', count(*), 6::bigint, 4::bigint from cohort_retention",
        "select 'delivery_operations', count(*), 20::bigint, 3::bigint from delivery_operations"]),
    "merchant_performance", "cuisine_market_share", "cohort_retention", "delivery_operations"))
def pip1(spark, d):
    """Whole run over the test tables (bronze, silver, gate, gold, mart
    tests, CSV export); the result is the export manifest with the number of mart tests passed."""
    out = PL.run_pipeline(E.prepare(spark), PL.raw_inputs_from_tables(spark, d), cfg=PL.testdata_config())
    passed = out["mart_checks"].filter("success").groupBy("table_name").agg(F.count(F.lit(1)).alias("mart_tests_passed"))
    return out["manifest"].join(passed, "table_name")


@query("snk8_export_manifest", with_ctes(
    "\nunion all\n".join([
        "select 'stg_businesses' as table_name, count(*) as row_count, 13::bigint as column_count "
        "from stg_businesses",
        "select 'stg_orders', count(*), 17::bigint from stg_orders"]),
    "stg_businesses", "stg_orders"))
def snk8(spark, d):
    exported = []
    for name, df in (("stg_businesses", E.businesses(spark, d)), ("stg_orders", E.orders(spark, d))):
        n = sinks.export_csv(df, scratch_path(spark, f"snk8-{name}"))
        exported.append((name, n, len(df.columns)))
    return sinks.export_manifest(spark, exported)


@query("prj5_lineage_columns", with_ctes(
    "select business_id, 'business.json' as _source_file, true as has_ingested_at, true as has_batch_date "
    "from raw_businesses", "raw_businesses"))
def prj5(spark, d):
    """Lineage columns on bronze rows; the clock values themselves are not
    reproducible, so the check is that they are set."""
    b = readers.bronze_businesses(adapters.raw_businesses(E.prepare(spark), d), "business.json")
    return b.select("business_id", "_source_file",
                    F.col("_ingested_at").isNotNull().alias("has_ingested_at"),
                    F.col("_batch_date").isNotNull().alias("has_batch_date"))


@query("snk1_overwrite_replaces_schema", with_ctes("select * from stg_businesses", "stg_businesses"))
def snk1(spark, d):
    """Overwrite a table folder holding the raw business documents with the
    staged businesses: the read-back has the new rows and the new schema."""
    path = scratch_path(spark, "snk1")
    sinks.write_table(adapters.raw_businesses(E.prepare(spark), d), path)
    staged = E.businesses(spark, d)
    sinks.write_table(staged, path, mode="overwrite")
    return spark.read.parquet(path)
