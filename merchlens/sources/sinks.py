"""Sinks and materialization (SNK1-SNK10).

All writes go to folders the caller names (on a cluster: under the shared
folder from ``spark.checkpoint.dir``, see ``merchlens.session.scratch_path``).
Row counts for logs and manifests come from ``observe`` metrics collected
while the write runs, not from a second scan of the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.session import scratch_path


#: Slices per partition value of a clustered layout.
SLICES = 4


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), mode: str = "overwrite", options: dict[str, str] | None = None) -> int:
    """SNK1/SNK4/SNK6/SNK9: overwrite (which replaces the schema) a table
    folder, optionally partitioned by stored columns (SNK2). Returns the row
    count, observed during the write."""
    obs = Observation(f"write_{uuid.uuid4().hex[:8]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get.get("rows", 0))


def write_partitioned_by_derived(df: DataFrame, path: str, name: str, expr,
                                 fmt: str = "parquet") -> int:
    """SNK3: partition by a derived column (e.g. the year of a date): the
    column is added first, then used as a partition column."""
    return write_table(df.withColumn(name, expr), path, fmt, partition_by=[name])


def write_partitioned(df: DataFrame, path: str, partition_col: str, fmt: str = "parquet") -> int:
    """A folder per value in files of even size: Spark rebalances by the value, joining small values and splitting hot
    ones at run time, without a sort and without a second scan to sample ranges."""
    return write_table(df.hint("rebalance", partition_col), path, fmt, partition_by=[partition_col])


def write_layout(df: DataFrame, path: str, partition_col: str, cluster_cols: Sequence[str],
                 tiebreak: Sequence[str] = (), num_partitions: int | None = None,
                 fmt: str = "parquet", bloom_cols: Sequence[str] | None = None) -> int:
    """SNK10: partitioned by ``partition_col`` and sorted by ``cluster_cols``
    inside each file, so a partition filter prunes folders and a cluster
    filter skips row groups by min/max statistics.

    Rows are range-partitioned on (partition_col, cluster_cols, tiebreak): each task holds a contiguous
    sorted slice, several slices per value, so a cluster filter skips whole files by their minima and maxima, and a
    value with a third of the rows is split across many tasks. The frame is stored first, as counting values
    and sampling ranges read it too. ``bloom_cols`` (the tie-break columns by default) get a Bloom filter per row group, so that a look-up by id skips the
    row groups that don't hold it, whatever their order."""
    spark = df.sparkSession
    at = scratch_path(spark, "layout")
    df.write.parquet(at)
    stored = spark.read.parquet(at)
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              SLICES * stored.agg(F.approx_count_distinct(partition_col)).first()[0])
    keys = [partition_col, *cluster_cols, *tiebreak]
    laid = stored.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in (tiebreak if bloom_cols is None else bloom_cols)}
    return write_table(laid, path, fmt, partition_by=[partition_col], options=blooms)


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A table of the session's catalog, in ``buckets`` files by the hash of ``keys`` and sorted by them: groups and joins by these keys on tables of the same
    number of buckets need no exchange. A bucket is read by one task, so bucket rows that a key's nature bounds (a merchant's months), not raw events."""
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", scratch_path(df.sparkSession, name)) \
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


# ---- tables that are replaced without a gap

_CURRENT = "_current"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """SNK1/SNK6 without a gap: the rows go to a version folder of their own, and one rename of a small file makes it the table. A write that fails leaves the
    table as it was; readers of an older version go on. Returns the version and its rows."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    rows = write_table(df, f"{path}/{version}", partition_by=partition_by)
    hadoop, fs = _fs(spark, path)
    new, current = hadoop.Path(f"{path}/{_CURRENT}-{version}"), hadoop.Path(f"{path}/{_CURRENT}")
    out = fs.create(new, True)
    out.writeBytes(version)
    out.close()
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, current, options)
    return version, rows


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version that readers get now; None before the first."""
    hadoop, fs = _fs(spark, path)
    at = hadoop.Path(f"{path}/{_CURRENT}")
    if not fs.exists(at):
        return None
    size = fs.getFileStatus(at).getLen()
    source = fs.open(at)
    try:
        return bytes(source.readNBytes(size)).decode()
    finally:
        source.close()


def read_published(spark: SparkSession, path: str, version: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A published table as of now, or a version that is named; it stays the same while others publish."""
    version = version or current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return read_back(spark, f"{path}/{version}", schema)


def drop_old_versions(spark: SparkSession, path: str) -> int:
    """Deletes all versions but the current one, half-written ones too. Call it when no reader needs them."""
    hadoop, fs = _fs(spark, path)
    keep, dropped = current_version(spark, path), 0
    for status in fs.listStatus(hadoop.Path(path)):
        name = status.getPath().getName()
        if name not in (keep, _CURRENT):
            dropped += name.startswith("v-")
            fs.delete(status.getPath(), True)
    return dropped


def read_back(spark: SparkSession, path: str, schema: T.StructType | None = None,
              fmt: str = "parquet") -> DataFrame:
    """Read a written table; give the schema to keep partition column types."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SNK5: view materialization (a named, lazily evaluated relation)."""
    df.createOrReplaceTempView(name)
    return df


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """SRC6: scan of a catalog relation by name."""
    return spark.table(name)


def export_csv(df: DataFrame, path: str, null_value: str = "") -> int:
    """SNK7: header CSV extract, written in parallel as a folder of parts."""
    obs = Observation(f"csv_{uuid.uuid4().hex[:8]}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("nullValue", null_value).option("emptyValue", '""').csv(path))
    return int(obs.get.get("rows", 0))


def export_manifest(spark: SparkSession, exported: Sequence[tuple[str, int, int]]) -> DataFrame:
    """SNK8: one row per exported table (name, rows, columns); the counts
    come from the write observations, the manifest is a few rows."""
    schema = T.StructType([T.StructField("table_name", T.StringType()),
                           T.StructField("row_count", T.LongType()),
                           T.StructField("column_count", T.LongType())])
    return spark.createDataFrame([(n, int(r), int(c)) for n, r, c in exported], schema)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
