"""CSV with line breaks inside quotes, read by many tasks.

Spark's ``multiLine`` reader gives a whole file to one task, as a line break may stand inside quotes. Here files are read as lines, split
anywhere, and quotes are counted: a line starts a record if the number of quotes before it in its file is even (a doubled quote counts two).

1. Quotes per block (file and split), added up per file before each block: one small row per block.
2. Each task goes through the lines of its blocks from the parity at their start and puts whole records together. Only the pieces at
   a block's ends, two at most, leave it.
3. Pieces of one record are joined in order of their blocks; all records are parsed by Spark's CSV parser.

Holds for files whose quotes are all doubled or around values, as ``sinks.export_csv`` and RFC 4180 have it; a lone quote within an unquoted
value shifts all that follows in its file. Records end at ``\\n`` or ``\\r\\n``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.session import scratch_path

OPTIONS = {"quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": "", "multiLine": "true"}
WHOLE, HEAD, TAIL = 0, 1, 2  # a record of one block; the end of one begun before; the beginning of one that goes on
PIECES = "file string, block long, at long, kind int, text string"


def _pieces(batches: Iterator[pa.RecordBatch], breaks: int) -> Iterator[pa.RecordBatch]:
    """Lines come sorted by (file, block, line). ``breaks``: records are sent on at this many."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("text", pa.string())])
    out: list[tuple] = []
    now, at, odd, begun, kind = None, 0, False, [], WHOLE

    def ended() -> None:
        if begun:
            out.append((*now, at, kind if not odd else TAIL if kind == WHOLE else HEAD, "\n".join(begun)))

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    for b in batches:
        for file, block, line, start in zip(*(b.column(c).to_pylist() for c in ("file", "block", "line", "odd")), strict=True):
            if now != (file, block):
                ended()
                now, at, odd, begun, kind = (file, block), 0, start, [], HEAD if start else WHOLE
            begun.append(line)
            odd ^= line.count('"') % 2 == 1
            if not odd:
                ended()
                at, begun, kind = at + 1, [], WHOLE
        if len(out) >= breaks:
            yield batch()
            out.clear()
    ended()
    if out:
        yield batch()


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block, at, text: the records of the files, headers among them, in the order of (file, block, at)."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("no"), F.col("value").alias("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    at = scratch_path(spark, "odd-blocks")
    blocks.withColumn("odd", F.coalesce(before, F.lit(0)) % 2 == 1).filter("odd").write.parquet(at)
    odd = spark.read.parquet(at)  # blocks that start inside quotes; Spark ships the table whole only where it is small
    marked = lines.join(odd, ["file", "block"], "left").withColumn("odd", F.coalesce("odd", F.lit(False))).sortWithinPartitions("file", "block", "no")
    parts = marked.select("file", "block", "line", "odd").mapInArrow(partial(_pieces, breaks=4096), PIECES)
    stored_at = scratch_path(spark, "records")
    parts.write.parquet(stored_at)
    stored = spark.read.parquet(stored_at)
    place = Window.partitionBy("file").orderBy("block", "at")
    torn = stored.filter(F.col("kind") != WHOLE).withColumn("record", F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(place))
    joined = torn.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "at", "text"))).alias("p")).select(
        "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["at"].alias("at"), F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text"))
    return stored.filter(F.col("kind") == WHOLE).select("file", "block", "at", "text").unionByName(joined)


def read_csv_blocks(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Rows of header CSV files as ``readers.read_csv`` gives them, whatever the number of tasks a file is dealt to. Empty records are skipped; the header's
    names are not compared. Writes the records once, to the shared folder."""
    found = records(spark, path)
    body = found.filter((F.col("block") > 0) | (F.col("at") > 0)).select(F.when(F.col("text").endswith("\r"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text")).alias("text"))
    return body.filter("text != ''").select(F.from_csv("text", _ddl(schema), OPTIONS).alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
