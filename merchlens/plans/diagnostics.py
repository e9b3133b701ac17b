"""Plan diagnostics used by the bench: rows read by the scans of an
executed query (from the scan operators' SQL metrics), and the layout
comparison behind the partition-pruning numbers of the baseline notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.plans import entities as E
from merchlens.session import scratch_path
from merchlens.sources import sinks


def scanned_rows(df: DataFrame) -> int:
    """Run ``df`` (its result must be small) and return the rows its file
    scans produced, walking through adaptive query stages."""
    return scan_metric(df, "numOutputRows")


def scan_metric(df: DataFrame, metric: str, of: str = "") -> int:
    """Run ``df`` (its result must be small) and add a metric up over its file scans, those whose description holds ``of``."""
    df.collect()
    total = 0

    def walk(node) -> None:
        nonlocal total
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
            return
        if "QueryStage" in name:
            walk(node.plan())
            return
        if "Scan" in name and (not of or f"PartitionFilters: [isnotnull({of}" in node.simpleString(10000)):
            opt = node.metrics().get(metric)
            if opt.isDefined():
                total += int(opt.get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


def layout_pruning(spark: SparkSession, sf_dir: str, state: str, cuisine: str) -> dict[str, int]:
    """Rows scanned by the documented dashboard queries on the merchant
    performance mart written flat vs partitioned by state and clustered by
    cuisine (``sinks.write_layout``)."""
    perf = E.performance(spark, sf_dir)
    flat, lay = scratch_path(spark, "diag-flat"), scratch_path(spark, "diag-layout")
    total = sinks.write_table(perf, flat)
    sinks.write_layout(perf, lay, "state", ["primary_cuisine"], tiebreak=["business_id"])
    f = spark.read.parquet(flat)
    p = sinks.read_back(spark, lay, perf.schema)

    def top100(df):
        return df.filter(F.col("state") == state).orderBy(F.col("composite_score").desc_nulls_last(),
                                                          "business_id").limit(100)

    def drill(df):
        return df.filter((F.col("state") == state) & (F.col("primary_cuisine") == cuisine)) \
            .select("business_id", "composite_score")

    return {
        "mart_rows": total,
        "state_filter_rows_scanned_flat": scanned_rows(top100(f)),
        "state_filter_rows_scanned_partitioned": scanned_rows(top100(p)),
        "state_cuisine_rows_scanned_flat": scanned_rows(drill(f)),
        "state_cuisine_rows_scanned_partitioned_clustered": scanned_rows(drill(p)),
        "state_cuisine_rows_returned": drill(p).count(),
    }
