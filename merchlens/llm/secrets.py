"""Secret scan in built-in functions: patterns plus sliding-window entropy.

Three base patterns give spans by themselves. Beyond them, every long run of key-like
characters with a letter and a digit is a candidate; its character class (hex, one-case
alphanumeric, mixed) sets a threshold, and the Shannon entropy of each window of
``WINDOW`` characters is kept up to date by counts: one character enters, one leaves, and
only their two terms of sum(c * log2 c) change. Terms are whole numbers (a table scaled
by 10^6), so the running sum is exact. Base spans are cut out of a candidate first; each piece
of ``WINDOW`` characters or more that is left is judged by itself. Windows above the threshold are
joined to one span, unless the allow list covers the piece.

Everything is one projection: no user function, no shuffle.

Defined results: null text counts as empty and has no span; positions are code points, end
exclusive; repeated rows are scanned one by one; other columns pass through; an empty table
gives an empty one.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.quality_rules import bind

# The base patterns and their least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)password|passwd|secret|token|api_?key"
ASSIGN_MIN = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % WINDOW
#: (class, pattern that its strings match, least entropy in bits of a window); the first that matches counts.
CLASSES = (
    ("hex", r"^[0-9A-Fa-f_-]+$", 2.9),
    ("one_case", r"^([0-9a-z_-]+|[0-9A-Z_-]+)$", 3.4),
    ("mixed", r"^[0-9A-Za-z+/_-]+$", 3.4),
)
#: Strings that are no secrets: identifiers of a public format, alphabets, place holders, paths, names with a number. Each entry has one
#: pattern that matches and others that don't; none repeats a group, so that strings of any length are matched without recursion.
ALLOW = (
    (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",),
    (r"(?i)example|sample|placeholder|changeme|dummy|xxxx|redacted",),
    (r"(?i)0123456789|abcdefghij|qwertyuiop",),
    (r"^/?[A-Za-z_-]+[0-9]{0,4}/", r"[^A-Za-z0-9_/-]", r"[0-9]{5}", r"[0-9][A-Za-z_-]"),
    (r"^[A-Za-z][A-Za-z_-]*[0-9]{1,4}$", r"[_-][_-]"),
)
SCALE = 10**6
TERMS = [round(SCALE * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def sum_limit(bits: float, window: int = WINDOW) -> int:
    """A window has at least ``bits`` of entropy when its sum of terms is at most this."""
    return math.floor(SCALE * window * (math.log2(window) - bits))


def _spans(text: Column, pattern: str, kind: int, value_group: int | None = None, least: int = 0) -> Column:
    """Leftmost matches with their places: what lies between them is found by splitting."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.arrays_zip(
        F.transform(gaps, lambda g: F.length(g).cast("long")).alias("gap"),
        F.transform(found, lambda m: F.length(m).cast("long")).alias("len"),
        (F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)), lambda v: F.length(v)) if value_group else F.transform(found, lambda m: F.lit(least))).alias("val"),
    )

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["len"]).alias("end"))
        return F.struct(
            (start + F.coalesce(x["len"], F.lit(0))).alias("at"),
            F.when(x["len"].isNotNull() & (x["val"] >= least), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))
    return F.aggregate(sizes, start, add, lambda s: s["out"])


def _where(text: Column, hint: str, spans: Column) -> Column:
    return F.when(text.rlike(hint), spans).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    return F.concat(
        _where(text, ASSIGN_HINT, _spans(text, ASSIGN, 0, 2, ASSIGN_MIN)),
        _where(text, ACCESS, _spans(text, ACCESS, 1)),
        _where(text, HEX, _spans(text, HEX, 2)),
    )


def _hot_windows(string: Column, most: Column) -> Column:
    """First and last window start of ``string`` whose sum of terms is at most ``most``."""
    codes = F.transform(F.split(string, ""), lambda c: F.ascii(c))
    terms = F.lit(TERMS)

    def run(cs: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            enter, leave = F.get(cs, i), F.when(i >= WINDOW, F.get(cs, i - WINDOW)).otherwise(F.lit(-1))
            more, less = F.get(s["n"], enter), F.coalesce(F.get(s["n"], F.when(leave >= 0, leave)), F.lit(0))
            now = F.when(enter == leave, s["sum"]).otherwise(
                s["sum"] - F.get(terms, more) + F.get(terms, more + 1) - F.get(terms, less) + F.get(terms, F.greatest(less - 1, F.lit(0)))
            )
            counts = F.transform(s["n"], lambda c, k: c + (k == enter).cast("int") - (k == leave).cast("int"))
            return bind(now, lambda total: F.struct(
                counts.alias("n"), total.alias("sum"),
                F.when((i >= WINDOW - 1) & (total <= most), F.coalesce(s["first"], i - (WINDOW - 1))).otherwise(s["first"]).alias("first"),
                F.when((i >= WINDOW - 1) & (total <= most), i + 1).otherwise(s["last"]).alias("last"),
            ))

        start = F.struct(F.array_repeat(F.lit(0), 128).alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
        return F.aggregate(F.sequence(F.lit(0), F.size(cs) - 1), start, step, lambda s: F.struct(s["first"], s["last"]))

    return bind(codes, run)


def entropy_spans(text: Column, base: Column) -> Column:
    """Spans of high entropy in what base spans (by start) leave of the candidates."""
    def suspicious(s: Column) -> Column:
        wanted = s.rlike("[0-9]") & s.rlike("[A-Za-z]")
        for pattern, *others in ALLOW:
            wanted = wanted & reduce(lambda found, o: found | s.rlike(o), others, ~s.rlike(pattern))
        return wanted

    def limit(s: Column) -> Column:
        out = F.lit(None).cast("long")
        for _, pattern, bits in reversed(CLASSES):
            out = F.when(s.rlike(pattern), F.lit(sum_limit(bits)).cast("long")).otherwise(out)
        return out

    def judge(c: Column) -> Column:
        s = F.substring(text, (c["start"] + 1).cast("int"), (c["end"] - c["start"]).cast("int"))
        return bind(s, lambda v: F.when(suspicious(v), bind(_hot_windows(v, limit(v)), lambda h: F.struct(
            (c["start"] + h["first"]).alias("start"), F.lit(3).alias("kind"), (c["start"] + h["last"]).alias("end")))))

    def pieces(c: Column) -> Column:
        def until(state: Column, end: Column) -> Column:
            piece = F.struct(state["at"].alias("start"), F.lit(3).alias("kind"), end.alias("end"))
            return F.when(end - state["at"] >= WINDOW, F.concat(state["out"], F.array(piece))).otherwise(state["out"])

        start = F.struct(c["start"].alias("at"), F.array().cast(SPAN).alias("out"))
        cut = lambda s, b: F.struct(F.greatest(s["at"], b["end"]).alias("at"), until(s, b["start"]).alias("out"))
        within = F.filter(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        return F.aggregate(within, start, cut, lambda s: until(s, c["end"]))

    free = F.flatten(F.transform(_spans(text, CANDIDATE, 3), pieces))
    return _where(text, CANDIDATE, F.filter(F.transform(free, judge), lambda h: h["start"].isNotNull()))


def scan_secrets(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with a struct column ``into``: ``base`` and ``spans``, arrays of (start, kind, end) by start, then kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = bind(t, lambda v: bind(F.array_sort(base_spans(v)), lambda base: F.struct(
        base.alias("base"), F.array_sort(F.concat(base, entropy_spans(v, base))).alias("spans"))))
    return docs.withColumn(into, found)


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each span (overlaps joined) replaced by ``mask``."""
    def add(s: Column, x: Column) -> Column:
        kept = F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
        return F.struct(
            F.when(x["start"] >= s["at"], F.concat(s["out"], kept, F.lit(mask))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, rest)).otherwise(text)


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.col("secrets.base")
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    return scan_secrets(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spelled(base), 256).alias("base_sha256"), spelled(F.col("secrets.spans")).alias("spans"),
    )


def _places_sql(kind: int, pattern: str, value: str = "2", least: int = 0) -> str:
    """Matches with their places: pieces between matches, added up."""
    quoted = pattern.replace("'", "''")
    group = f"regexp_extract_all(t, '{quoted}', {value})" if least else f"regexp_extract_all(t, '{quoted}')"
    return f"""
  select r, {kind} as kind, m, v, e - length(m) as s, e
  from (select r, m, v, sum(length(g) + length(m)) over (partition by r order by i) as e
        from (select r, unnest(regexp_extract_all(t, '{quoted}')) as m, unnest({group}) as v,
                     unnest(regexp_split_to_array(t, '{quoted}')[1 : len(regexp_extract_all(t, '{quoted}'))]) as g,
                     unnest(range(len(regexp_extract_all(t, '{quoted}')))) as i
              from texts where regexp_matches(t, '{quoted}')))
  where length(v) >= {least}"""


_LIMIT_SQL = " ".join(f"when regexp_matches(m, '{pattern}') then {sum_limit(bits)}" for _, pattern, bits in CLASSES)
_ALLOW_SQL = """regexp_matches(m, '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$')
    or regexp_matches(m, '(?i)example|sample|placeholder|changeme|dummy|xxxx|redacted') or regexp_matches(m, '(?i)0123456789|abcdefghij|qwertyuiop')
    or regexp_matches(m, '^/?[A-Za-z_-]+[0-9]{0,4}(/[A-Za-z_-]*[0-9]{0,4})+$') or regexp_matches(m, '^[A-Za-z]+([-_][A-Za-z]+)*[-_]?[0-9]{1,4}$')"""
_WINDOWS_SQL = f"""
  select r, c.s, i, ({' + '.join(f"{term} * len(list_filter(list_distinct(string_split(substr(m, i + 1, {WINDOW}), '')), lambda x: length(substr(m, i + 1, {WINDOW})) - length(replace(substr(m, i + 1, {WINDOW}), x, '')) = {n}))" for n, term in enumerate(TERMS) if term)}) as total,
         case {_LIMIT_SQL} end as most
  from (select *, unnest(range(length(m) - {WINDOW - 1})) as i from candidates) c"""
OP8_SQL = f"""
with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
base as ({_places_sql(0, ASSIGN, "2", ASSIGN_MIN)} union all {_places_sql(1, ACCESS)} union all {_places_sql(2, HEX.replace("(?<![0-9a-f])", ""))}),
whole as ({_places_sql(3, "[A-Za-z0-9+/_-]{%d,}" % WINDOW)}),
cuts as (
  select w.r, w.s as ws, w.e as we, b.s, b.e, coalesce(max(b.e) over (partition by w.r, w.s order by b.s, b.kind rows between unbounded preceding and 1 preceding), w.s) as after
  from whole w join base b on b.r = w.r and b.s < w.e and w.s < b.e
),
pieces as (
  select r, s, e from whole w where not exists (select 1 from cuts c where c.r = w.r and c.ws = w.s)
  union all select r, after, s from cuts
  union all select r, greatest(ws, max(e)), we from cuts group by r, ws, we
),
candidates as (
  select * from (select r, s, e, substr(t, s::bigint + 1, (e - s)::bigint) as m from pieces join texts using (r) where e - s >= {WINDOW})
  where regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Za-z]') and not ({_ALLOW_SQL})
),
spans as (
  select r, kind, s, e from base
  union all select r, 3, s + min(i), s + max(i) + {WINDOW} from ({_WINDOWS_SQL}) where total <= most group by r, s
),
named as (select *, ['assign', 'access', 'hex', 'entropy'][kind + 1] || ':' || s::bigint || ':' || e::bigint as said from spans)
select doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access, count(*) filter (where kind = 2) as n_hex,
       sha256(coalesce(string_agg(said, ',' order by s, kind) filter (where kind < 3), '')) as base_sha256,
       coalesce(string_agg(said, ',' order by s, kind), '') as spans
from texts left join named using (r) group by texts.r, doc_id
"""
