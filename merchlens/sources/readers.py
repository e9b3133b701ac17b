"""Readers: schema-first JSON and CSV scans, Parquet, lineage columns and the
bronze ingest steps (scan -> lineage -> typed columns)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.functions import rules
from merchlens.sources import checked, csv_blocks, drift, schemas, sinks


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Line-delimited JSON. Give a schema: inference costs a full extra scan."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_lineage(df: DataFrame, source_file: str) -> DataFrame:
    """Append the three bronze lineage columns."""
    return df.withColumns({
        "_ingested_at": F.current_timestamp(),
        "_source_file": F.lit(source_file),
        "_batch_date": F.current_date(),
    })


def bronze_businesses(raw: DataFrame, source_file: str = "business.json") -> DataFrame:
    """Business documents plus lineage (written partitioned by ``state``)."""
    return with_lineage(raw, source_file)


def bronze_reviews(raw: DataFrame, source_file: str = "review.json") -> DataFrame:
    """Review documents plus lineage, ``review_date`` parsed from the text date
    (date-only or date-time text both parse, any other gives NULL) and ``review_year`` for the
    partitioned write."""
    return (
        with_lineage(raw, source_file)
        .withColumn("review_date", F.col("date").try_cast("date"))
        .withColumn("review_year", F.year("review_date"))
    )


def bronze_checkins(raw: DataFrame, source_file: str = "checkin.json",
                    fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """One row per check-in: the comma-separated stamp list is split,
    exploded (NULL and empty lists yield no rows) and parsed."""
    return (
        raw.withColumn("checkin_at", F.explode(F.split(F.col("date"), ", ")))
        .withColumn("checkin_at", F.try_to_timestamp(F.col("checkin_at"), F.lit(fmt)))
        .drop("date")
        .transform(lambda d: with_lineage(d, source_file))
    )


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Header CSV with ``"`` quoting and doubling; quoted values may hold line breaks. A file is one task: for large files
    use ``csv_blocks.read_csv_blocks``."""
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
        .option("multiLine", True).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    )


def read_csv_with_null_tokens(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    null_tokens: Sequence[str] = rules.CSV_NULL_TOKENS,
) -> DataFrame:
    """CSV where any of several tokens means NULL, loaded strictly: a value that does not fit its column's type
    stops the load, as does a fraction in a whole-number column (``15.0`` is 15). Files are dealt to many tasks by
    ``csv_blocks``, line breaks inside quotes included.

    Every column is read as text (``nullValue`` accepts one token only), the tokens are mapped to NULL, then each
    column is cast to its declared type."""
    raw = csv_blocks.read_csv_blocks(spark, path, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    cols: list[Column] = []
    for f in schema.fields:
        c = F.when(~F.col(f.name).isin(*null_tokens), F.col(f.name))
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            # whole numbers may arrive as "15.0" from float-typed exports
            d = c.cast(T.DecimalType(38, 10))
            bad = F.raise_error(F.concat(F.lit(f"{f.name}: not a whole number: "), c)).cast(f.dataType)
            c = F.when(d.isNull() | (d == F.floor(d)), d.cast(f.dataType)).otherwise(bad)
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def read_mart_csv(spark: SparkSession, path: str | list[str], contract: T.StructType) -> DataFrame:
    return read_csv_with_null_tokens(spark, path, contract)


# ---- batch ingest by path: scan, lineage, bronze table

def ingest_businesses(spark: SparkSession, src: str, dest: str, schema: T.StructType = schemas.RAW_BUSINESS) -> checked.Ingested:
    """JSON lines -> bronze, a folder per state; broken lines -> ``<dest>_quarantine``."""
    return checked.load(spark, src, dest, schema, lambda df, to: sinks.write_partitioned(df, to, "state"), lambda raw: bronze_businesses(raw, src))


def ingest_reviews(spark: SparkSession, src: str, dest: str, schema: T.StructType = schemas.RAW_REVIEW) -> checked.Ingested:
    """JSON lines -> bronze, a folder per review year; broken lines and bad dates -> ``<dest>_quarantine``."""
    return checked.load(spark, src, dest, schema, lambda df, to: sinks.write_partitioned(df, to, "review_year"),
                        lambda raw: bronze_reviews(raw, src), checked.bad_date("date"))


def ingest_checkins(spark: SparkSession, src: str, dest: str, schema: T.StructType = schemas.RAW_CHECKIN) -> checked.Ingested:
    """JSON lines -> bronze, a row per check-in; broken lines and lists with bad stamps -> ``<dest>_quarantine``. ``rows`` counts documents."""
    return checked.load(spark, src, dest, schema, sinks.write_table, lambda raw: bronze_checkins(raw, src), checked.bad_stamps("date"))


def ingest_evolving(spark: SparkSession, src: str, dest: str, kind: str, share: float = drift.SHARE) -> tuple[checked.Ingested, DataFrame]:
    """An ingest by the declared schema and the new fields that a ``share`` of the records shows. The drift table goes to ``<dest>_drift``; the
    overwrite replaces the schema of the table by the one returned there."""
    step, declared = {"business": (ingest_businesses, schemas.RAW_BUSINESS), "review": (ingest_reviews, schemas.RAW_REVIEW),
                      "checkin": (ingest_checkins, schemas.RAW_CHECKIN)}[kind]
    found = drift.found_schema(spark, src, share)
    changes = drift.drift_table(spark, declared, found)
    changes.write.mode("overwrite").parquet(f"{dest.rstrip('/')}_drift")
    return step(spark, src, dest, drift.merged(declared, found)), changes


def ingest_folder(spark: SparkSession, src: str, dest: str) -> dict[str, checked.Ingested]:
    """``business``, ``review`` and ``checkin`` below ``src`` into bronze tables below ``dest``."""
    steps = {"businesses": (ingest_businesses, "business"), "reviews": (ingest_reviews, "review"), "checkins": (ingest_checkins, "checkin")}
    return {name: step(spark, f"{src}/{folder}", f"{dest}/{name}") for name, (step, folder) in steps.items()}


__all__ = [
    "read_json", "read_parquet", "with_lineage", "bronze_businesses", "bronze_reviews",
    "bronze_checkins", "read_csv", "read_csv_with_null_tokens", "read_mart_csv", "schemas",
    "ingest_businesses", "ingest_reviews", "ingest_checkins", "ingest_evolving", "ingest_folder",
]
