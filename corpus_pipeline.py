"""A corpus, cleaned and encoded: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns they were given. Documents are told apart by
(doc_id, 64-bit hash of the text), so repeated ids with different texts are judged by themselves. Columns beside those
of documents pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.llm import bpe_stream, decontaminate, order_minhash, secrets, toxicity
from merchlens.session import scratch_path


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` has them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _keys(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.col("doc_id").alias(a), F.col("text_key").alias(b)).distinct()


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col("doc_id").cast("long")) & (F.col(b) == F.xxhash64("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, = _free(docs, "_score")
    return toxicity.score(docs, model, score).filter(F.col(score) < 0.5).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, a repeated row once."""
    a, b, copy = _free(docs, "_id", "_key", "_copy")
    kept = _keys(order_minhash.near_duplicates(docs).filter("kept"), a, b)
    once = F.row_number().over(Window.partitionBy(a, b).orderBy(b))
    return docs.join(kept, _same(a, b)).withColumn(copy, once).filter(F.col(copy) == 1).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    a, b = _free(docs, "_id", "_key")
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(_keys(found.filter(F.size("hits") > 0), a, b), _same(a, b), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    into, = _free(docs, "_secrets")
    spans = F.col(f"{into}.spans")
    text = secrets.redact(F.col("text"), spans)
    return secrets.scan_secrets(docs, into=into).withColumns({
        "text": text, "n_chars": F.when(F.size(spans) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))}).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe_stream.round_trip(docs, bpe_stream.vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: SQL has no form of the learned scores, sketches and merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        at = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
