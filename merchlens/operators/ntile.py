"""Exact distributed ``ntile``, ``rank`` and quantiles.

``ntile(k) over (order by s)`` as a window moves every row of the frame into one task. Here

1. ``ranged`` lets Spark range-partition the rows by the order columns and stores them once with their range
   number, so every later step reads the same ranges, and a lost executor recomputes nothing before it;
2. ``positions`` counts rows per (group, range), turns the counts into the number of rows before each range,
   joins that small table back, and adds ``row_number`` within (group, range).

The same stored ranges serve the global order and the order within any group columns. A value shared by many rows
spreads over several ranges when a unique column follows it in the order; a hot group is spread over the
ranges too, because ranges follow the order columns, not the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import scratch_path

_IDX, _RANGE, _SIZE = "__ml_idx", "__ml_range", "__ml_size"


def _order(order_cols: Sequence[str], descending: Sequence[str] = ()) -> list[Column]:
    return [F.col(c).desc_nulls_last() if c in descending else F.col(c).asc_nulls_last() for c in order_cols]


def ranged(df: DataFrame, order_cols: Sequence[str], descending: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """``df`` range-partitioned by the order columns (NULLs last, any orderable type), stored in the shared folder with a
    range number per row. ``ranges``: how many; Spark's shuffle setting by default."""
    order = _order(order_cols, descending)
    split = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    at = scratch_path(df.sparkSession, "ranges")
    split.withColumn(_RANGE, F.spark_partition_id()).write.parquet(at)
    return df.sparkSession.read.parquet(at)


def _same(a: DataFrame, b: DataFrame, keys: dict[str, str]) -> Column:
    """NULL-safe equality of columns of ``a`` with columns of ``b``; true without keys."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[v]) for k, v in keys.items()], F.lit(True))


def positions(stored: DataFrame, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
              descending: Sequence[str] = (), weight_col: str | None = None) -> DataFrame:
    """A frame from ``ranged`` with each row's 0-based position within its group (``__ml_idx``) and the group's
    size (``__ml_size``). With ``weight_col`` a row stands for that many rows and its position is where they start."""
    size = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    counts = stored.groupBy(*partition_cols, _RANGE).agg(size.cast("long").alias("__ml_n"))
    of_group = Window.partitionBy(*partition_cols)
    before = of_group.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    keys = {c: f"__ml_k{i}" for i, c in enumerate((*partition_cols, _RANGE))}
    starts = counts.select(
        *[F.col(c).alias(k) for c, k in keys.items()],
        F.coalesce(F.sum("__ml_n").over(before), F.lit(0)).alias("__ml_before"),
        F.coalesce(F.sum("__ml_n").over(of_group), F.lit(0)).alias(_SIZE))
    w = Window.partitionBy(_RANGE, *partition_cols).orderBy(*_order(order_cols, descending))
    if weight_col:
        own = F.sum(weight_col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(weight_col)
    else:
        own = F.row_number().over(w) - 1
    placed = stored.withColumn("__ml_own", own.cast("long"))
    return placed.join(starts, _same(placed, starts, keys)).withColumn(_IDX, F.col("__ml_before") + F.col("__ml_own")) \
        .drop("__ml_own", "__ml_before", *keys.values())


def tile_of(idx: Column, n: Column, k: int) -> Column:
    """1-based tile of the 0-based position ``idx`` among ``n`` rows: with ``q, r = divmod(n, k)`` the first ``r`` tiles hold
    ``q + 1`` rows and the rest ``q``."""
    q = F.floor(n / F.lit(k)).cast("long")
    r = n - q * F.lit(k)
    big = r * (q + 1)
    return F.when(idx < big, F.floor(idx / (q + 1)) + 1) \
        .otherwise(r + F.floor((idx - big) / F.nullif(q, F.lit(0))) + 1).cast("long")


def tiles(stored: DataFrame, k: int, order_cols: Sequence[str], partition_cols: Sequence[str] = (), out_col: str = "ntile") -> DataFrame:
    """``ntile`` on a frame from ``ranged``, whose range number stays for further tiles."""
    return positions(stored, order_cols, partition_cols).withColumn(out_col, tile_of(F.col(_IDX), F.col(_SIZE), k)).drop(_IDX, _SIZE)


def dist_ntile(df: DataFrame, k: int, order_cols: Sequence[str], partition_cols: Sequence[str] = (),
               out_col: str = "ntile", ranges: int | None = None) -> DataFrame:
    """Exact ``ntile(k) over ([partition by partition_cols] order by order_cols nulls last)``; ``out_col`` is bigint. Put a unique
    column last in ``order_cols`` for a deterministic assignment of tied rows."""
    return tiles(ranged(df, order_cols, ranges=ranges), k, order_cols, partition_cols, out_col).drop(_RANGE)


def grouped_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                      names: Sequence[str] | None = None, ranges: int | None = None) -> DataFrame:
    """Exact continuous quantiles (linear interpolation at ``p * (n - 1)``, NULLs ignored) of ``value_col`` per group, one
    column per probability."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    return column_quantiles(df, {value_col: dict(zip(names, probs, strict=True))}, group_cols, ranges)


def column_quantiles(df: DataFrame, wanted: dict[str, dict[str, float]], group_cols: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Exact continuous quantiles of several columns in one pass: ``wanted`` maps a column to {result column: probability}.

    Rows are first reduced to a (group, column, value) -> count histogram with map-side combine, so a value
    repeated across a third of the rows is one entry; one set of ranges serves all columns, positions are weighted, and each quantile is read by one
    grouped aggregate. No group's rows are gathered into one task."""
    values = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(wanted)])
    # a group whose values are all NULL keeps a zero-weight row, hence NULL quantiles; NULLs sort last
    tall = df.select(*group_cols, F.explode(values).alias("__x")).select(*group_cols, F.col("__x.c").alias("__c"), F.col("__x.v").alias("__v"))
    hist = tall.groupBy(*group_cols, "__c", "__v").agg(F.count("__v").alias("__w"))
    j = positions(ranged(hist, ["__v", "__c", *group_cols], ranges=ranges), ["__v"], ["__c", *group_cols], weight_col="__w")
    aggs = []
    for i, results in enumerate(wanted.values()):
        for name, p in results.items():
            pos = F.lit(float(p)) * (F.col(_SIZE) - 1).cast("double")

            def value_at(at: Column, i: int = i) -> Column:
                return F.max(F.when((F.col("__c") == i) & (F.col(_IDX) <= at) & (at < F.col(_IDX) + F.col("__w")), F.col("__v")))

            low, high = value_at(F.floor(pos)), value_at(F.ceil(pos))
            aggs.append((low + (high - low) * F.max(F.when(F.col("__c") == i, pos - F.floor(pos)))).alias(name))
    return j.groupBy(*group_cols).agg(*aggs) if group_cols else j.agg(*aggs)


def dist_rank(df: DataFrame, order_col: str, partition_cols: Sequence[str] = (), descending: bool = True,
              tiebreak: str | None = None, out_col: str = "rank", ranges: int | None = None) -> DataFrame:
    """``rank() over ([partition by p] order by order_col [desc])`` with gaps after ties (1, 1, 3), NULLs last, as bigint,
    for any orderable type.

    A rank is 1 plus the rows of greater values, so it is read from the (group, value) -> count histogram: a value is one entry however many rows
    hold it, only the entries are range-partitioned, and the ranks go back to the rows by one join. ``tiebreak`` is not needed any more: tied rows
    share a rank and are never sorted."""
    spark = df.sparkSession
    at = scratch_path(spark, "ranked")
    df.write.parquet(at)
    rows = spark.read.parquet(at)
    keys = [*partition_cols, order_col]
    names = {c: f"__ml_t{i}" for i, c in enumerate(keys)}
    hist = rows.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.count(F.lit(1)).alias("__ml_w"))
    value, groups = names[order_col], [names[c] for c in partition_cols]
    down = [value] if descending else []
    placed = positions(ranged(hist, [value, *groups], down, ranges), [value], groups, down, weight_col="__ml_w") \
        .select(*names.values(), (F.col(_IDX) + 1).cast("long").alias(out_col))
    return rows.join(placed, _same(rows, placed, names), "left").drop(*names.values())


__all__ = ["column_quantiles", "dist_ntile", "dist_rank", "grouped_quantiles", "positions", "ranged", "tile_of", "tiles"]
