"""Column-level helpers: plain ``Column -> Column`` functions built from
``pyspark.sql.functions`` so Catalyst sees through them and they stay inside
whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlens.functions import rules


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def months_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar-month boundaries crossed from ``start`` to ``end``
    (Jan 31 -> Feb 1 is 1), computed as (year*12 + month) difference."""
    s, e = _c(start), _c(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def round_dp(c: Column | str, n: int) -> Column:
    """Round a double to ``n`` decimals by scaling, rounding half away from
    zero and unscaling; this matches SQL engines that round the binary value
    rather than its printed decimal (10.075 -> 10.07)."""
    scale = float(10 ** n)
    x = _c(c) * F.lit(scale)
    # from 2^52 on a double is whole
    whole = F.when(F.abs(x) < F.lit(float(2 ** 52)), round_long(x).cast("double")).otherwise(x.cast("double"))
    return whole / F.lit(scale)


def round_long(x: Column) -> Column:
    """A double to the nearest whole number, half away from zero: ``round(x)`` as a bigint, without the decimal that Spark's ``round``
    makes of every value. The fraction is exact in binary, and twice it, cut, is -1, 0 or 1."""
    cut = x.cast("long")
    return cut + ((x - cut) * F.lit(2.0)).cast("int")


def dow0(ts: Column | str) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(_c(ts)) - 1


def keyword_any(text: Column | str, keywords: Iterable[str]) -> Column:
    """True when the lower-cased text contains any keyword (NULL text -> NULL,
    which a filter drops)."""
    low = F.lower(_c(text))
    return reduce(lambda a, b: a | b, [low.contains(k) for k in keywords])


def taxonomy(
    text: Column | str,
    rule_list: Sequence[tuple[str, Sequence[str]]],
    default: Column | str | None = rules.CUISINE_DEFAULT,
) -> Column:
    """Ordered keyword rules: the first rule whose keywords all occur in the
    lower-cased text wins; otherwise ``default`` (a literal label or a Column)."""
    low = F.lower(_c(text))
    expr = None
    for label, words in rule_list:
        cond = reduce(lambda a, b: a & b, [low.contains(w) for w in words])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def sentiment_bucket(stars: Column | str) -> Column:
    """>= 4 positive, = 3 neutral, anything else (3.5, NULL) negative."""
    s = _c(stars)
    return (
        F.when(s >= 4, F.lit("positive"))
        .when(s == 3, F.lit("neutral"))
        .otherwise(F.lit("negative"))
    )


def tier_label(tier: Column | str) -> Column:
    t = _c(tier)
    expr = None
    for num, label in rules.TIER_LABELS:
        expr = F.when(t == num, F.lit(label)) if expr is None else expr.when(t == num, F.lit(label))
    return expr


def flag(pred: Column) -> Column:
    """Boolean that is never NULL: true only when ``pred`` is true."""
    return F.coalesce(pred, F.lit(False))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, NULL when den is NULL or 0."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def clamp(x: Column | str, lo=None, hi=None) -> Column:
    out = _c(x)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def null_unless(pred: Column, x: Column | str) -> Column:
    """``x`` where ``pred`` holds, else NULL."""
    return F.when(pred, _c(x))


def bin_floor(x: Column | str, width: float) -> Column:
    """Left edge of the fixed-width bin holding x."""
    return F.floor(_c(x) / F.lit(float(width))) * F.lit(float(width))


def weekday_name(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "EEEE")


def month_start(d: Column | str) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_c(d).cast("date"), "MM")


def weekday_rank(name: Column | str) -> Column:
    """Monday = 1 .. Sunday = 7 for custom ordering of weekday names."""
    n = _c(name)
    expr = None
    for i, day in enumerate(rules.WEEKDAYS, start=1):
        expr = F.when(n == day, F.lit(i)) if expr is None else expr.when(n == day, F.lit(i))
    return expr


def tier_rank(label: Column | str) -> Column:
    """Elite = 1 .. Low = 5 for custom ordering of tier labels."""
    n = _c(label)
    expr = None
    for i, (_, lab) in enumerate(rules.TIER_LABELS, start=1):
        expr = F.when(n == lab, F.lit(i)) if expr is None else expr.when(n == lab, F.lit(i))
    return expr


def date_label(d: Column | str, fmt: str = "yyyy-MM") -> Column:
    """Format a date as text (``%Y-%m`` style month label by default)."""
    return F.date_format(_c(d).cast("date"), fmt)


def exact_mean(c: Column | str, scale: int = 12) -> Column:
    """Mean of a double column whose sum does not depend on the order rows
    arrive in: values are summed as decimal(38, scale), then divided by the
    non-NULL count. A plain double ``avg`` can land on either side of a
    rounding tie depending on partitioning."""
    x = _c(c)
    return F.sum(x.cast(f"decimal(38,{scale})")).cast("double") / F.nullif(
        F.count(x).cast("double"), F.lit(0.0))
