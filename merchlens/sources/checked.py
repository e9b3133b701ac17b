"""Tolerant scans of JSON lines: good rows load, broken ones land in a quarantine table.

A file is read as lines, so the text of a bad record is at hand, and each line is parsed by the declared schema. What can be wrong:

* ``not JSON``: the line is no JSON object (cut off, plain text, an array). It has no row.
* ``value does not fit``: a value is not of its column's type. It has no row, as half a record would count as a whole one.
* ``bad date``: a date or stamp that no calendar knows. The row loads with a NULL there (silver drops it), and the line is listed too.

Lines of white space alone are no records. Counts are observed while the good rows are written; only if they tell of bad
lines is the input read again to write the quarantine table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
NOT_JSON, NO_FIT, BAD_DATE = "not JSON", "value does not fit", "bad date"
QUARANTINE = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("record", T.StringType())])


@dataclass(frozen=True)
class Ingested:
    """What a load made of its input: rows written, lines without a row, rows with a date that could not be read."""

    rows: int
    broken: int
    bad_dates: int


def bad_date(column: str = "date") -> Column:
    """A date text is there and is none."""
    return F.col(column).isNotNull() & F.col(column).try_cast("date").isNull()


def bad_stamps(column: str = "date", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Some stamp of a comma-separated list can't be read; an empty list is fine."""
    return F.coalesce(F.exists(F.split(column, ", "), lambda x: (x != "") & F.try_to_timestamp(x, F.lit(fmt)).isNull()), F.lit(False))


class CheckedJson:
    """The lines below a path, parsed by a schema. ``date_fault`` tells of a parsed row whether its dates can't be read."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, date_fault: Column | None = None):
        self.spark, self.schema = spark, schema
        self._name = f"checked_{uuid.uuid4().hex[:8]}"
        self._observed = Observation(self._name)
        lines = spark.read.text(path).select(F.col("value").alias("__line"), F.col("_metadata.file_path").alias("__file")).filter(F.trim("__line") != "")
        whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        parsed = lines.withColumn("__row", F.from_json("__line", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
        is_object = F.ltrim("__line").startswith("{")
        broken = F.when(~is_object, NOT_JSON).when(F.col(f"__row.{CORRUPT}").isNotNull(), F.when(F.try_parse_json("__line").isNull(), NOT_JSON).otherwise(NO_FIT))
        rows = parsed.withColumn("__broken", broken).select("__line", "__file", "__broken", *[F.col("__row")[f.name].alias(f.name) for f in schema.fields])
        fault = F.col("__broken").isNull() & date_fault if date_fault is not None else F.lit(False)
        self._tagged = rows.withColumn("__fault", fault)

    def rows(self) -> DataFrame:
        """The good rows. Their first use in a job observes the counts."""
        seen = self._tagged.observe(self._observed, F.count(F.when(F.col("__broken").isNull(), 1)).alias("rows"),
                                    F.count("__broken").alias("broken"), F.count(F.when(F.col("__fault"), 1)).alias("bad_dates"))
        return seen.filter(F.col("__broken").isNull()).select([f.name for f in self.schema.fields])

    def counts(self) -> Ingested:
        """After a job has used ``rows``."""
        seen = self._observed.get
        return Ingested(int(seen.get("rows", 0)), int(seen.get("broken", 0)), int(seen.get("bad_dates", 0)))

    def quarantine(self) -> DataFrame:
        """source_file, reason, record of every line that is broken or has a date that can't be read."""
        return self._tagged.filter(F.col("__broken").isNotNull() | F.col("__fault")).select(
            F.col("__file").alias("source_file"), F.coalesce("__broken", F.lit(BAD_DATE)).alias("reason"), F.col("__line").alias("record"))

    def settle(self, path: str) -> Ingested:
        """After the rows are written: the quarantine table at ``path``, empty where nothing is wrong."""
        seen = self.counts()
        found = self.quarantine() if seen.broken or seen.bad_dates else self.spark.createDataFrame([], QUARANTINE)
        found.write.mode("overwrite").parquet(path)
        return seen


def load(spark: SparkSession, src: str, dest: str, schema: T.StructType, write: Callable[[DataFrame, str], int], shape: Callable[[DataFrame], DataFrame],
         date_fault: Column | None = None) -> Ingested:
    """Good rows of ``src``, shaped, written to ``dest``; bad lines to ``<dest>_quarantine``."""
    source = CheckedJson(spark, src, schema, date_fault)
    write(shape(source.rows()), dest)
    return source.settle(f"{dest.rstrip('/')}_quarantine")
