"""Licence scan by a generalised suffix automaton of licence tokens.

The automaton holds every run of tokens of all templates and base phrases. A document's
tokens are streamed through it; its state gives, at each place, the longest template run
that ends there (the matching statistics). A base phrase ends wherever the run is long
enough and has the phrase as its suffix. Runs that cannot be extended and have at least
``MIN_MATCH`` tokens are chained per template, in order of document and template, into
covered template spans; a template that is covered by at least ``MIN_COVER`` of its tokens
gives its label.

Only stretches whose neighbouring tokens are all neighbours in some template are streamed:
elsewhere the matching statistics are 1 or 0.

Defined results: null texts have no words; documents are scanned one by one, repeated ones
too; places are words from 0; ``score`` is 1 with a base phrase, else the best covered share,
0 without any; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.license_templates import PHRASES, TEMPLATES
from merchlens.llm.words import Words, chunks, raw_texts, word_hashes

MIN_MATCH = 3
MIN_COVER = 0.6
MAX_GAP = 12

SCHEMA = "doc_id bigint, n_words bigint, base array<struct<start:bigint,label:string>>, spans array<struct<start:bigint,end:bigint,label:string,covered:double>>"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("base", pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("covered", pa.float64())]))),
])


class SuffixAutomaton:
    """Of several token sequences. State 0 is empty; ``next``, ``link`` and ``size`` are as usual; ``ends`` has, per state,
    the (sequence, end) pairs at which its runs end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.ends = [-1], [0], [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, token in enumerate(sequence, 1):
                last = self._extend(last, token)
                self.ends[last].add((number, end))
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, size: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, p: int, token: int) -> int:
        """The state of the run of p's longest string and ``token``, set apart from longer ones if need be."""
        q = self.next[p][token]
        if self.size[q] == self.size[p] + 1:
            return q
        own = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = own
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = own
            p = self.link[p]
        return own

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:  # an earlier sequence has it
            return self._split(last, token)
        new = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        self.link[new] = self._split(p, token) if p >= 0 else 0
        return new

    def stream(self, tokens: list[int]):
        """(state, length of the longest run that ends here) for each token."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            yield state, length


class Licences:
    """Templates and phrases, compiled."""

    def __init__(self, phrases: dict[str, str], templates: tuple[tuple[str, str], ...]):
        texts = [*phrases, *(t for _, t in templates)]
        hashes = [word_hashes(t) for t in texts]
        self.vocabulary = np.unique(np.concatenate(hashes))
        sequences = [np.searchsorted(self.vocabulary, h).tolist() for h in hashes]
        self.labels, self.n_phrases = [*phrases.values(), *(label for label, _ in templates)], len(phrases)
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences)
        self.follows = np.zeros((len(self.vocabulary) + 1, len(self.vocabulary) + 1), bool)
        for s in sequences:
            self.follows[s[:-1], s[1:]] = True
        a = self.automaton
        #: per state, the phrases that end its runs, with their lengths
        self.closing = [
            [(n, self.sizes[n]) for n, end in ends if n < self.n_phrases and end == self.sizes[n] and a.size[a.link[state]] < end <= a.size[state]] if state else []
            for state, ends in enumerate(a.ends)
        ]
        for state in sorted(range(1, len(a.size)), key=lambda s: a.size[s]):
            up = self.closing[a.link[state]] if a.link[state] > 0 else []
            self.closing[state] = sorted({*self.closing[state], *up})
        self.places = [sorted((n, end) for n, end in ends if n >= self.n_phrases) for ends in a.ends]

    def scan(self, at: int, tokens: list[int], base: list[tuple[int, int]], matches: list[tuple[int, int, int]]) -> None:
        """Adds (start, phrase) and the maximal matches (end, length, state) of one stretch."""
        before = (0, 0)
        for i, (state, length) in enumerate(self.automaton.stream(tokens)):
            for phrase, size in self.closing[state]:
                if length >= size:
                    base.append((at + i + 1 - size, phrase))
            if before[1] >= MIN_MATCH and length <= before[1]:
                matches.append((at + i, before[1], before[0]))
            before = (state, length)
        if before[1] >= MIN_MATCH:
            matches.append((at + len(tokens), before[1], before[0]))

    def chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, str, float]]:
        """Per template, runs of matches in order: (start, end, label, covered share)."""
        open_: dict[int, list[int]] = {}
        out = []

        def close(n: int) -> None:
            start, end, _, covered = open_.pop(n)
            if covered >= MIN_COVER * self.sizes[n]:
                out.append((start, end, self.labels[n], covered / self.sizes[n]))

        for end, length, state in matches:
            done = set()
            for n, to in self.places[state]:
                if n in done:
                    continue
                have = open_.get(n)
                if have and end - length - have[1] <= MAX_GAP and to > have[2]:
                    new = min(length, to - have[2], end - have[1])
                    if new > 0:
                        open_[n] = [have[0], end, to, have[3] + new]
                        done.add(n)
                        continue
                elif have and end - length - have[1] <= MAX_GAP and have[3] >= length:
                    continue
                if have:
                    close(n)
                open_[n] = [end - length, end, to, length]
                done.add(n)
        for n in list(open_):
            close(n)
        return sorted(out)


@lru_cache(maxsize=4)
def compiled(phrases: tuple = tuple(PHRASES.items()), templates: tuple = TEMPLATES) -> Licences:
    return Licences(dict(phrases), templates)


def scan_batch(batch: pa.RecordBatch, know: Licences) -> pa.RecordBatch:
    words = Words(raw_texts(batch))
    token = np.searchsorted(know.vocabulary, words.hash)
    token[np.append(know.vocabulary, np.uint64(0))[token] != words.hash] = len(know.vocabulary)
    tied = know.follows[token[:-1], token[1:]] & (words.doc[:-1] == words.doc[1:]) if len(token) else np.zeros(0, bool)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], tied, [False]]).astype(np.int8)))
    base: dict[int, list] = {}
    matches: dict[int, list] = {}
    for start, end in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist(), strict=True):
        doc = int(words.doc[start])
        know.scan(start - int(words.first[doc]), token[start:end].tolist(), base.setdefault(doc, []), matches.setdefault(doc, []))
    n = batch.num_rows
    spans = {doc: know.chain(m) for doc, m in matches.items() if m}
    return pa.RecordBatch.from_arrays([
        batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(words.first).astype(np.int64)),
        pa.array([[{"start": s, "label": know.labels[p]} for s, p in sorted(base.get(i, ()))] for i in range(n)], _ARROW.field("base").type),
        pa.array([[dict(zip(("start", "end", "label", "covered"), s, strict=True)) for s in spans.get(i, ())] for i in range(n)], _ARROW.field("spans").type),
    ], schema=_ARROW)


def scan_licences(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: tuple = TEMPLATES) -> DataFrame:
    """Per document: words, places of base phrases, covered template spans."""
    key = tuple(phrases.items()), tuple(templates)

    def run(batches):
        know = compiled(*key)
        for batch in chunks(batches):
            yield scan_batch(batch, know)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licences(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    label = lambda c: F.transform(F.col(c), lambda x: x["label"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).alias("first_word"), F.array_max(F.transform("base", lambda x: x["start"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(label("base"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(label("base"), label("spans"))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("spans", lambda x: x["covered"])), F.lit(0.0)))).alias("score"),
    )
