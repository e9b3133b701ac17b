"""Data-quality checks (DQ1-DQ13).

A suite is a list of ``Check`` specs. ``run_suite`` evaluates a table's row checks, row count and
first uniqueness check in one pass; partial aggregation combines a value repeated across a third of
the rows map-side. Results come back as a DataFrame ``(table_name, check_name, column_name,
observed, total_rows, success)``: for row checks ``observed`` is the number
of failing rows (NULLs are ignored by every check except not-null), for the
row-count check it is the row count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions import rules
from merchlens.session import at_once

RESULT_COLUMNS = ("table_name", "check_name", "column_name", "observed", "total_rows", "success")


@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | between | in_set | row_count
    column: str | None = None
    lo: float | None = None
    hi: float | None = None
    values: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{self.kind}" if self.column is None else f"{self.kind}:{self.column}"


def not_null(col: str) -> Check:
    return Check("not_null", col)


def unique(col: str) -> Check:
    return Check("unique", col)


def between(col: str, lo=None, hi=None) -> Check:
    return Check("between", col, lo, hi)


def in_set(col: str, values: Sequence) -> Check:
    return Check("in_set", col, values=tuple(values))


def row_count(lo=None, hi=None) -> Check:
    return Check("row_count", None, lo, hi)


def violation(check: Check) -> Column | None:
    """Row-level predicate that marks a failing row (NULL values pass
    everything except not-null)."""
    c = F.col(check.column) if check.column else None
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "between":
        parts = []
        if check.lo is not None:
            parts.append(c < F.lit(check.lo))
        if check.hi is not None:
            parts.append(c > F.lit(check.hi))
        return c.isNotNull() & reduce(lambda a, b: a | b, parts) if parts else F.lit(False)
    if check.kind == "in_set":
        return c.isNotNull() & ~c.isin(*check.values)
    return None


def _result(table: str, kind: str, column: str | None, observed: Column, total: Column, success: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(kind).alias("check_name"), F.lit(column).cast("string").alias("column_name"),
        observed.cast("long").alias("observed"), total.cast("long").alias("total_rows"), success.alias("success"))


def run_suite(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """DQ9: all checks of one table -> result rows (lazy), in one pass.

    Without uniqueness checks that is one global aggregate. Otherwise rows are first counted per value of
    the first unique column (map-side combined), with the row checks counted alongside, and the groups summed;
    only further unique columns need a pass of their own."""
    rows = [c for c in checks if c.kind in ("not_null", "between", "in_set")]
    keys = [c.column for c in checks if c.kind == "unique"]
    counts = [F.count(F.lit(1)).alias("__n")] + [F.count_if(violation(c)).alias(f"__v{i}") for i, c in enumerate(rows)]
    if keys:
        grouped = df.groupBy(F.col(keys[0]).alias("__key")).agg(*counts)
        twice = F.when(F.col("__key").isNotNull() & (F.col("__n") > 1), F.col("__n"))
        names = ["__n", *(f"__v{i}" for i in range(len(rows)))]
        one = grouped.agg(F.coalesce(F.sum(twice), F.lit(0)).alias("__twice"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    else:
        one = df.agg(*counts)
    total, entries = F.col("__n"), []
    entries += [_result(table, c.kind, c.column, F.col(f"__v{i}"), total, F.col(f"__v{i}") == 0) for i, c in enumerate(rows)]
    for c in checks:
        if c.kind == "row_count":
            ok = F.lit(True)
            if c.lo is not None:
                ok = ok & (total >= c.lo)
            if c.hi is not None:
                ok = ok & (total <= c.hi)
            entries.append(_result(table, "row_count", None, total, total, ok))
    if keys:
        entries.append(_result(table, "unique", keys[0], F.col("__twice"), total, F.col("__twice") == 0))
    out = one.select(F.inline(F.array(*entries)))
    return reduce(DataFrame.unionByName, [run_suite(df, table, [unique(k)]) for k in keys[1:]], out)


def failed_suite(spark, table: str, error: Exception) -> DataFrame:
    """The result of a suite that could not run: one failed row with the first line of the error as its column name."""
    said = f"{type(error).__name__}: {error}".splitlines()[0][:200]
    return spark.createDataFrame([(table, "suite_error", said, None, None, False)],
                                 "table_name string, check_name string, column_name string, observed long, total_rows long, success boolean")


def run_suites(suites: Sequence[tuple[str, DataFrame, Sequence[Check]]]) -> DataFrame:
    """All suites as one lazy frame; a suite that cannot be planned (say, a missing column) is a failed row and the others report."""
    parts = []
    for table, df, checks in suites:
        try:
            parts.append(run_suite(df, table, checks))
        except AnalysisException as e:
            parts.append(failed_suite(df.sparkSession, table, e))
    return reduce(DataFrame.unionByName, parts)


def evaluate(suites: Sequence[tuple[str, DataFrame, Sequence[Check]]], path: str) -> DataFrame:
    """Runs the suites side by side and stores their results under ``path``; one that fails while it runs is a failed row too."""
    def run(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
        try:
            run_suite(df, table, checks).write.mode("overwrite").parquet(f"{path}/{table}")
        except PySparkException as e:
            failed_suite(df.sparkSession, table, e).write.mode("overwrite").parquet(f"{path}/{table}")
        return df.sparkSession.read.parquet(f"{path}/{table}")

    return reduce(DataFrame.unionByName, at_once(suites[0][1].sparkSession, [partial(run, *suite) for suite in suites]))


def suite_summary(results: DataFrame) -> DataFrame:
    """Per table: checks passed, checks run, all passed."""
    return results.groupBy("table_name").agg(
        F.count_if(F.col("success")).alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        F.bool_and("success").alias("all_passed"),
    )


def gate(results: DataFrame) -> DataFrame:
    """DQ10: one row ``(all_passed, failed_checks)`` over every suite."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(False)).alias("all_passed"),
        F.count_if(~F.col("success")).alias("failed_checks"),
    )


class QualityGateError(RuntimeError):
    pass


def enforce(results: DataFrame, shown: int = 50) -> None:
    """Raise before anything downstream runs when a check fails; the error names the first ``shown`` and says how many there are."""
    row = gate(results).first()
    if row is None or not row["all_passed"]:
        failed = results.filter(~F.col("success")).select("table_name", "check_name", "column_name").orderBy("table_name", "check_name", "column_name").limit(shown).collect()
        raise QualityGateError(f"quality gate failed: {row['failed_checks'] if row else 0} checks, first {[tuple(r) for r in failed]}")


# ------------------------------------------------------------------ suites
# The check lists and bounds of the published silver suites.

def suite_businesses(min_rows: int = 100, max_rows: int | None = 500_000) -> list[Check]:
    """DQ6: 11 checks on staged businesses."""
    return [
        not_null("business_id"),
        not_null("business_name"),
        not_null("state"),
        not_null("stars"),
        not_null("primary_cuisine"),
        unique("business_id"),
        between("stars", 1.0, 5.0),
        between("review_count", 1, None),
        between("latitude", 18.0, 72.0),
        between("longitude", -180.0, -65.0),
        row_count(min_rows, max_rows),
    ]


def suite_reviews(min_year: int = 2015, max_year: int = 2026,
                  min_rows: int = 100, max_rows: int | None = 10_000_000) -> list[Check]:
    """DQ7: 8 checks on staged reviews."""
    return [
        not_null("review_id"),
        not_null("business_id"),
        not_null("review_date"),
        unique("review_id"),
        between("review_stars", 1.0, 5.0),
        between("review_year", min_year, max_year),
        in_set("sentiment_bucket", rules.SENTIMENTS),
        row_count(min_rows, max_rows),
    ]


def suite_orders(min_rows: int = 1_000, max_rows: int | None = 600_000) -> list[Check]:
    """DQ8: 6 checks on staged orders."""
    return [
        not_null("order_id"),
        not_null("business_id"),
        unique("order_id"),
        in_set("order_status", rules.ORDER_STATUSES),
        between("order_total_usd", 0.01, 500.0),
        row_count(min_rows, max_rows),
    ]


def source_tests_businesses() -> list[Check]:
    """DQ11 (business source): not_null, unique, accepted half-star values."""
    return [not_null("business_id"), unique("business_id"), not_null("name"), not_null("state"),
            not_null("stars"), in_set("stars", rules.HALF_STARS), not_null("review_count")]


def source_tests_reviews() -> list[Check]:
    return [not_null("review_id"), unique("review_id"), not_null("business_id"), not_null("stars"),
            not_null("review_date")]


def source_tests_checkins() -> list[Check]:
    return [not_null("business_id"), not_null("checkin_at")]


def source_tests_orders() -> list[Check]:
    return [not_null("order_id"), unique("order_id"), not_null("business_id"),
            in_set("order_status", rules.ORDER_STATUSES)]


def mart_tests_performance() -> list[Check]:
    """DQ12 (merchant performance mart)."""
    return [not_null("business_id"), unique("business_id"), not_null("state"),
            not_null("primary_cuisine"), not_null("performance_tier"),
            in_set("performance_tier", (1, 2, 3, 4, 5)),
            in_set("tier_label", [lab for _, lab in rules.TIER_LABELS])]


def mart_tests_market_share() -> list[Check]:
    return [not_null("state"), not_null("primary_cuisine"), not_null("merchant_count"),
            not_null("market_share_pct")]


def mart_tests_retention() -> list[Check]:
    return [not_null("cohort_month"), not_null("months_since_cohort"), not_null("retained_users"),
            not_null("retention_rate_pct")]


def mart_tests_delivery() -> list[Check]:
    return [not_null("business_id"), not_null("order_month"), in_set("_is_synthetic_data", (True,))]


def row_counts(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """DQ13 / SET1: ``(table_name, row_count)`` per table, as a UNION ALL of
    one global count each."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables]
    return reduce(lambda a, b: a.unionByName(b), parts)
