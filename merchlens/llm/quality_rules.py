"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a Column over the text and every rule a row of a plain table, so the
whole filter is one ``select`` of built-in functions: no shuffle, no user function, no
state. A rule is (name, metric, low, high); a document passes it when the metric lies in
[low, high], either side may be open.

Defined results: a null text counts as empty, so it has no words and fails the base rule;
ratios over zero words or lines are 0; repeated rows are judged one by one; other
columns pass through untouched; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for with as it on this be are was by at from or an a "
    "der die das und in zu den von mit ist im des nicht ein eine für sich auch auf dem "
    "le la les de des du et un une en est que qui dans pour sur par au avec pas "
    "el los las y en que de un una por con no se del al es su para lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``metric`` has to lie within [low, high]; None leaves a side open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The threshold table.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 25.0),
    Rule("symbols", "symbol_ratio", None, 0.5),
    Rule("stop_words", "stop_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("line_length", "mean_line_words", 1.0, None),
)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once: as a lambda's variable it is not
    copied into each place that reads it, nor evaluated again per array element."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text."""

    def covered(starts: Column) -> Column:
        n = F.size(starts)
        steps = F.transform(starts, lambda s, i: F.when(i + 1 < n, F.least(F.lit(3), F.get(starts, i + 1) - s)).otherwise(F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(keys: Column) -> Column:
        same = F.filter(keys, lambda k, i: ((i > 0) & F.coalesce(F.get(keys, i - 1)["h"] == k["h"], F.lit(False))) | F.coalesce(F.get(keys, i + 1)["h"] == k["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda k: k["i"]))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) >= 4, bind(F.sort_array(windows), lambda keys: bind(repeated(keys), covered))).otherwise(F.lit(0).cast("long"))


def measures(text: Column, stop_words: tuple[str, ...] = tuple(STOP_WORDS)) -> Column:
    """A struct of all counts that the metrics need."""
    stops = sorted(set(stop_words))
    spoken = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    return F.struct(
        bind(F.filter(F.split(text, SPACE + "+"), lambda w: w != ""), of_words).alias("w"),
        bind(spoken, of_lines).alias("l"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )


def metric_columns(m: Column) -> dict[str, Column]:
    """The ratios that rules can name."""
    words, lines = m["w"]["n_words"], m["l"]["n_lines"]

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    return {
        "mean_word_chars": share(m["w"]["word_chars"], words),
        "symbol_ratio": share(m["n_symbols"], words),
        "stop_ratio": share(m["w"]["n_stop_words"], words),
        "dup_line_ratio": share(m["l"]["n_dup_lines"], lines),
        "mean_line_words": share(words, lines),
    }


def compile_rules(rules: tuple[Rule, ...], metrics: dict[str, Column]) -> Column:
    """The table as one boolean Column: every rule holds."""
    passed = F.lit(True)
    for rule in rules:
        value = metrics[rule.metric]
        if rule.low is not None:
            passed = passed & (value >= rule.low)
        if rule.high is not None:
            passed = passed & (value <= rule.high)
    return passed


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into``: the counts, ``base_failed`` and ``kept``."""
    judged = docs.withColumn(into, bind(measures(F.coalesce(F.col(text), F.lit(""))), lambda m: _verdict(m, rules)))
    return judged


def _verdict(m: Column, rules: tuple[Rule, ...]) -> Column:
    words, repeats = m["w"]["n_words"], m["w"]["n_repeat_words"]
    failed = (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)
    return F.struct(
        words.alias("n_words"), m["w"]["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"), repeats.alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & compile_rules(rules, metric_columns(m))).alias("kept"),
    )


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "quality.*")


def _sql_rules() -> str:
    tests = []
    for rule in RULES:
        tests += [f"{rule.metric} >= {rule.low}"] * (rule.low is not None) + [f"{rule.metric} <= {rule.high}"] * (rule.high is not None)
    return " and ".join(tests)


OP6_SQL = rf"""
with base as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), toks as (
  select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from base
), windows as (
  select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
  from (select r, ws, unnest(range(1, greatest(len(ws) - 1, 1))) as i from toks)
), twice as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1
), covered as (
  select r, count(distinct i + o) as n_repeat_words from twice, (values (0), (1), (2)) v(o) group by r
), counts as (
  select b.doc_id, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(ls) as n_lines,
         len(list_filter(ws, lambda x: lower(x) in ({", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))}))) as n_stop_words
  from base b join toks using (r) left join covered using (r)
), judged as (
  select *, (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) as base_failed,
         case when n_words > 0 then word_chars / n_words else 0 end as mean_word_chars,
         case when n_words > 0 then n_symbols / n_words else 0 end as symbol_ratio,
         case when n_words > 0 then n_stop_words / n_words else 0 end as stop_ratio,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio,
         case when n_lines > 0 then n_words / n_lines else 0 end as mean_line_words
  from counts
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (not base_failed and {_sql_rules()}) as kept from judged
"""
