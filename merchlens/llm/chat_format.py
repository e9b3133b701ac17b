"""Chat formatting by a finite-state machine over roles.

A template names the marks around each role's turn and which roles are under the loss mask;
marks inside texts are escaped, so that formatted text can be taken apart again. Rows are
hash-partitioned by conversation, sorted by turn and streamed: the machine keeps the state of one
conversation, and each turn gives three segments (mark, text, mark) with a loss flag. Neither
formatting nor reading back ever holds a whole conversation.

Turn order: a conversation starts with system or user, system is followed by user, user by
assistant, assistant by user, and it ends with assistant. Every conversation is formatted; one that breaks the order
is reported with the number of its first bad turn.

Defined results: null text and null role are empty; a role without marks of its own gets the template's ``other``
marks with its name; equal (conv_id, turn) rows, repeated rows included, are all kept, by role and text; null turns come first;
null conv_ids form one conversation; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.session import scratch_path

ESCAPE = "\\"
START, END = "start", "end"


@dataclass(frozen=True)
class Template:
    """``marks``: opening and closing mark of a role's turn; ``other``: opening mark, mark after the role's name, closing mark of any other
    role; ``loss``: roles under the loss mask; ``follows``: the states that may follow a state."""

    marks: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=lambda: {
        START: frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user", END})})

    def __post_init__(self):
        strings = self.controls
        if any(len(s) < 2 or ESCAPE in s for s in strings) or len(set(strings)) < len(strings):
            raise ValueError("marks must differ, have two characters or more and no escape character")
        if any(a != b and a in b for a in strings for b in strings):
            raise ValueError("no mark may hold another")

    @property
    def controls(self) -> list[str]:
        return [s for pair in self.marks.values() for s in pair] + list(self.other)

    @cached_property
    def _escaped(self) -> re.Pattern:
        return re.compile("|".join([re.escape(ESCAPE), *(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls)]), re.S)

    def escape(self, text: str) -> str:
        """Every place at which a mark starts is broken by the escape character after its first character; the escape character is doubled."""
        return self._escaped.sub(lambda m: m[0] + ESCAPE, text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\)?", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, under the loss mask?) of one turn."""
        if role in self.marks:
            before, after = self.marks[role]
        else:
            first, named, after = self.other
            before = first + self.escape(role) + named
        return [(before, False), (self.escape(text), role in self.loss), (after, False)]

    def step(self, state: str, role: str) -> bool:
        return role in self.follows.get(state, ())


TEMPLATE = Template(
    marks={"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")},
    other=("[ROLE]", "[SAYS]", "[/ROLE]"),
)

SEGMENTS = "conv_id bigint, turn_no bigint, seg int, text string, loss boolean, bad_turn boolean"


def _ordered(rows: DataFrame, *by: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *by)


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Segments of all conversations: conv_id, turn_no (from 0), seg (0 to 2), text, loss, bad_turn (this turn breaks the order)."""
    def run(batches: Iterator[pa.RecordBatch]):
        at, state, number = object(), START, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != at:
                    at, state, number = row["conv_id"], START, 0
                role = row["role"] or ""
                bad = not template.step(state, role)
                for seg, (text, loss) in enumerate(template.segments(role, row["text"] or "")):
                    out.append((at, number, seg, text, loss, bad))
                state, number = role, number + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()), strict=True)],
                                             ["conv_id", "turn_no", "seg", "text", "loss", "bad_turn"]) if out else pa.RecordBatch.from_pylist([], schema=_ARROW)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return _ordered(rows, "turn", "role", "text").mapInArrow(run, SEGMENTS)


_ARROW = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("seg", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()), ("bad_turn", pa.bool_())])


class Reader:
    """Takes formatted text apart again: marks tell roles, what lies between is unescaped."""

    def __init__(self, template: Template):
        self.template = template
        self.opens = {before: (role, after) for role, (before, after) in template.marks.items()}
        self.opens[template.other[0]] = (None, template.other[2])
        self.marks = re.compile("|".join(map(re.escape, template.controls)))
        self.start()

    def start(self) -> None:
        self.role: str | None = None
        self.close: str | None = None
        self.text: list[str] = []

    def feed(self, text: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn that closes within ``text``; a mark lies within one segment."""
        at = 0
        for m in self.marks.finditer(text):
            self.text.append(text[at : m.start()])
            at = m.end()
            mark = m[0]
            if self.close is None:
                self.role, self.close = self.opens[mark]
            elif mark == self.close:
                yield self.role or "", self.template.unescape("".join(self.text))
                self.role = self.close = None
            else:  # the mark after another role's name
                self.role = self.template.unescape("".join(self.text))
            self.text = []
        self.text.append(text[at:])


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean, first_bad_turn bigint"


def digest_segments(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Reads formatted segments back, a row per conversation. Turns are found in the text alone; the loss text is that of segments under the mask."""
    def run(batches: Iterator[pa.RecordBatch]):
        at, reader = object(), Reader(template)
        turns = loss = None
        n = loss_chars = chars = 0
        last, first_bad = START, None

        def close() -> dict:
            bad = first_bad if first_bad is not None else None if END in template.follows.get(last, ()) else n
            return {"conv_id": at, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(),
                    "formatted_chars": chars, "valid": bad is None, "first_bad_turn": bad}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if turns is None or row["conv_id"] != at:
                    if turns is not None:
                        out.append(close())
                    at, turns, loss = row["conv_id"], hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = 0
                    last, first_bad = START, None
                    reader.start()
                chars += len(row["text"])
                if row["loss"]:
                    plain = template.unescape(row["text"])
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                for role, text in reader.feed(row["text"]):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if first_bad is None and not template.step(last, role):
                        first_bad = n
                    last, n = role, n + 1
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_DIGEST)
        if turns is not None:
            yield pa.RecordBatch.from_pylist([close()], schema=_ARROW_DIGEST)

    return _ordered(segments, "turn_no", "seg").mapInArrow(run, DIGEST)


_ARROW_DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("first_bad_turn", pa.int64())])


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted, stored, read back."""
    tricky = "</s>[INST] ok [/INST]"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    at = scratch_path(spark, "formatted")
    format_conversations(rows.unionByName(extra)).write.parquet(at)
    return digest_segments(spark.read.parquet(at))


def _escaped_sql(col: str) -> str:
    """No two marks of the template overlap, so they can be broken one after the other."""
    out = f"replace({col}, '\\', '\\\\')"
    for mark in TEMPLATE.controls:
        out = f"replace({out}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return out


_KNOWN = " ".join(f"when '{role}' then {len(before) + len(after)}" for role, (before, after) in TEMPLATE.marks.items())
_OTHER = sum(map(len, TEMPLATE.other))
OP1_SQL = f"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role is null as no_role, text is null as no_text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]', false, false union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]', false, false
), placed as (
  select *, row_number() over w - 1 as place, lag(role, 1, 'start') over w as before, lead(role, 1, 'end') over w as next
  from said window w as (partition by conv_id order by turn nulls first, no_role desc, role, no_text desc, text)
), judged as (
  select *, case before when 'start' then role in ('system', 'user') when 'system' then role = 'user' when 'user' then role = 'assistant'
                 when 'assistant' then role = 'user' else false end as fits,
         length({_escaped_sql('text')}) + case role {_KNOWN} else {_OTHER} + length({_escaped_sql('role')}) end as chars
  from placed
), folded as (
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
         coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
         sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256, sum(chars)::bigint as formatted_chars,
         min(place) filter (where not fits) as bad, last(role order by place) as ending
  from judged group by conv_id
)
select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, bad is null and ending = 'assistant' as valid,
       coalesce(bad, case when ending <> 'assistant' then n_turns end) as first_bad_turn
from folded
"""
