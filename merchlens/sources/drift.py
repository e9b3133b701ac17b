"""Schema drift of JSON sources: what a sample of the files holds against what is declared.

``found_schema`` infers from a share of the records (an extra pass over that share's text). ``drift`` lists the fields that are new, that are
gone, and those whose values no longer fit the declared type; nested fields by dotted names. ``merged`` is the declared schema with the new
fields after the known ones: a declared type always holds, so values that don't fit it end in the quarantine and not in a wider column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SHARE = 0.1
NEW, GONE, RETYPED = "new", "gone", "retyped"
DRIFT = T.StructType([T.StructField(n, T.StringType()) for n in ("field", "change", "declared_type", "found_type")])

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)


def found_schema(spark: SparkSession, path: str, share: float = SHARE) -> T.StructType:
    """Inferred from a ``share`` of the records; lines that are no JSON are passed over."""
    found = spark.read.option("samplingRatio", share).option("mode", "DROPMALFORMED").json(path).schema
    return T.StructType([f for f in found.fields if f.name != spark.conf.get("spark.sql.columnNameOfCorruptRecord")])


def fits(found: T.DataType, declared: T.DataType) -> bool:
    """Whether values of the found type can be read as the declared one."""
    if isinstance(found, T.NullType) or isinstance(declared, T.StringType):
        return True
    if isinstance(declared, _WHOLE):
        return isinstance(found, _WHOLE)
    if isinstance(declared, _NUMBERS):
        return isinstance(found, _NUMBERS)
    if isinstance(declared, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(found, (T.StringType, type(declared)))
    if isinstance(declared, T.ArrayType):
        return isinstance(found, T.ArrayType) and fits(found.elementType, declared.elementType)
    return type(found) is type(declared)


def drift(declared: T.StructType, found: T.StructType, prefix: str = "") -> list[tuple[str, str, str | None, str | None]]:
    """(field, change, declared type, found type) of every difference, by declared order, new fields after."""
    out: list[tuple[str, str, str | None, str | None]] = []
    have = {f.name: f.dataType for f in found.fields}
    for f in declared.fields:
        name = prefix + f.name
        if f.name not in have:
            out.append((name, GONE, f.dataType.simpleString(), None))
        elif isinstance(f.dataType, T.StructType) and isinstance(have[f.name], T.StructType):
            out += drift(f.dataType, have[f.name], f"{name}.")
        elif not fits(have[f.name], f.dataType):
            out.append((name, RETYPED, f.dataType.simpleString(), have[f.name].simpleString()))
    known = {f.name for f in declared.fields}
    return out + [(prefix + f.name, NEW, None, f.dataType.simpleString()) for f in found.fields if f.name not in known]


def merged(declared: T.StructType, found: T.StructType) -> T.StructType:
    """The declared fields, nested ones completed, then the new ones; a new field without any value is text."""
    have = {f.name: f.dataType for f in found.fields}
    both = [T.StructField(f.name, merged(f.dataType, have[f.name]) if isinstance(f.dataType, T.StructType) and isinstance(have.get(f.name), T.StructType) else f.dataType)
            for f in declared.fields]
    known = {f.name for f in declared.fields}
    return T.StructType(both + [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType) for f in found.fields if f.name not in known])


def drift_table(spark: SparkSession, declared: T.StructType, found: T.StructType) -> DataFrame:
    return spark.createDataFrame(drift(declared, found), DRIFT)
