"""Toxicity of de-obfuscated text: a noisy channel, then a linear model.

Language model: counts of letter 4-grams (a-z, accents folded, one mark between words) over all
documents, summed by Spark, smoothed by backing off to shorter contexts.

Channel: a token becomes a lattice. A letter stands for itself, or for nothing where it
repeats the one before; digits and signs may stand for look-alike letters; where single
letters are spelled out, the gaps between them may stand for nothing. Viterbi
decoding over states of three letters finds the likeliest text. A token whose lattice has one path
is its own decoding, so only tokens with look-alikes, doubled letters, or spelled-out
letters are decoded.

Score: presence of words and word beginnings (4 to 6 letters) of the restored text, chosen and
weighted on a sample of at most ``MAX_TRAIN`` labelled documents outside the held-out fifth,
one of each group of near copies: the larger of a logistic regression and of the surest feature's share of
toxic documents (the lower bound of its confidence interval).

Defined results: null and empty texts have no features and score the bias; a null doc_id counts as '' for
the held-out remainder; label rows with nulls are left out and the larger label counts for repeated ids;
without training rows every score is the prior, below 0.5; repeated documents are scored one by one; an
empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
import unicodedata
from array import array
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.decontaminate import _stored_rows
from merchlens.llm.words import chunks
from merchlens.session import scratch_path

MARK = 26
BASE = 27
MAX_TRAIN = 20_000
MAX_FEATURES = 2_000
MIN_POSITIVE = 3
HELD_OUT = 5
#: A sure feature has at least this lower bound and this share in the sample; the bound's width in standard errors.
SURE, PURE, SPREAD = 0.75, 0.995, 3.0
#: Letters of the words by which near copies are told.
LONG, MARKS = 7, 3
#: Tokens with words that a task keeps at most, four times as many without, and the length of a kept one.
MAX_DECODED, KEPT = 50_000, 64
#: Characters of a stretch that are decoded at a time, and of them those shared with the part before.
PART, PART_OVERLAP = 256, 64

# What look-alike characters may stand for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
GAPS = " .-_*"
#: Costs in natural log units of reading a sign as a letter, of dropping a repeated letter, of dropping a gap, a sign between words.
COST_SIGN, COST_REPEAT, COST_GAP, COST_BREAK = 1.0, 0.5, 0.3, 2.5


@lru_cache(maxsize=1)
def folds() -> np.ndarray:
    """0 to 25 for each code point that is a letter a-z after case and accents go, else ``MARK``."""
    out = np.full(0x110000, MARK, np.uint8)
    for c in (*range(0x2000), *range(0xFF21, 0xFF5B)):
        first = unicodedata.normalize("NFKD", chr(c).lower())[:1]
        if "a" <= first <= "z":
            out[c] = ord(first) - 97
    out[ord("ß")] = ord("s") - 97
    return out


def fold(text: str) -> str:
    table = folds()
    return "".join([chr(97 + v) if (v := int(table[ord(c)])) < MARK else " " for c in text])


def letter_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): counts of 4-grams of folded letters over all texts, a run of other characters being one mark."""
    def run(batches):
        total = np.zeros(BASE**4, np.int64)
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            s = folds()[np.frombuffer(("   " + "".join(t + "   " for t in texts)).encode("utf-32-le", "surrogatepass"), np.uint32)]
            between = np.zeros(len(s), bool)  # three marks between texts, so that counts don't depend on the batch
            ends = np.cumsum([0, *(len(t) + 3 for t in texts)])
            between[(ends[:, None] + np.arange(3)).ravel()] = True
            s = s[between | np.concatenate([[True], (s[1:] != MARK) | (s[:-1] != MARK)])].astype(np.int64)
            total += np.bincount(((s[:-3] * BASE + s[1:-2]) * BASE + s[2:-1]) * BASE + s[3:], minlength=BASE**4)
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(total[grams])], ["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


class LetterModel:
    """log P(letter | three before), from stored counts."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, pull: float = 5.0):
        counts = np.zeros(BASE**4)
        counts[grams] = n
        share = np.full(BASE, 1 / BASE)
        for order in range(4):
            c = counts.reshape((-1,) + (BASE,) * (order + 1)).sum(axis=0)
            share = (c + pull * share) / (c.sum(axis=-1, keepdims=True) + pull)
        self.log = array("d", np.log(share).reshape(-1).tobytes())

    def decode(self, lattice: list[list[tuple[int | None, float]]]) -> str:
        """The likeliest path: each step offers (letter, mark, or None for nothing, cost)."""
        best = {(MARK, MARK, MARK): (0.0, "")}
        for step in (*lattice, [(MARK, 0.0)]):
            now: dict[tuple[int, int, int], tuple[float, str]] = {}
            for (a, b, c), (score, out) in best.items():
                for letter, cost in step:
                    if letter is None or letter == MARK == c:
                        key, value, text = (a, b, c), score - cost, out
                    else:
                        value = score - cost + self.log[((a * BASE + b) * BASE + c) * BASE + letter]
                        key, text = (b, c, letter), out + (chr(97 + letter) if letter < MARK else " ")
                    if key not in now or value > now[key][0]:
                        now[key] = (value, text)
            best = now
        return max(best.values())[1].strip()


def lattice(token: str, spaced: bool = False) -> list[list[tuple[int | None, float]]]:
    """Steps of a token; ``spaced``: gaps may stand for nothing."""
    steps, before = [], -1
    for c in token:
        letter = _folded(c)
        if letter < MARK:
            steps.append(_AGAIN[letter] if letter == before else _ONCE[letter])
        elif c in LOOK_ALIKE:
            steps.append(_SIGN[c])
        else:
            steps.append(_GAP if spaced else _BREAK)
        before = letter
    return steps


@lru_cache(maxsize=4096)
def _folded(c: str) -> int:
    return int(folds()[ord(c)])


_ONCE = [[(x, 0.0)] for x in range(MARK)]
_AGAIN = [[(x, 0.0), (None, COST_REPEAT)] for x in range(MARK)]
_SIGN = {c: [*((ord(x) - 97, COST_SIGN) for x in letters), (MARK, COST_BREAK)] for c, letters in LOOK_ALIKE.items()}
_GAP, _BREAK = [(None, COST_GAP), (MARK, COST_BREAK)], [(MARK, 0.0)]


_SIGNS = np.zeros(0x110000, bool)
_SIGNS[[ord(c) for c in LOOK_ALIKE]] = True
_GAPS = np.zeros(0x110000, bool)
_GAPS[[ord(c) for c in GAPS]] = True


class Letters:
    """Folded letters of a batch of texts, their words, and the stretches whose lattices have several paths."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.points = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offset = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))])
        self.symbol = np.concatenate([folds()[self.points], np.full(6, MARK, np.uint8)])
        letter = self.symbol[: len(self.points)] < MARK
        edge = np.flatnonzero(np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        self.letter = letter

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offset, at, "right") - 1

    def beginnings(self) -> np.ndarray:
        """The first four letters of each word as a number, marks after a shorter one's end."""
        code = np.zeros(len(self.start), np.int64)
        for i in range(4):
            at = self.start + i
            code = code * BASE + np.where(at < self.end, self.symbol[at], MARK)
        return code

    def word(self, i: int) -> str:
        return (self.symbol[self.start[i] : self.end[i]] + np.uint8(97)).tobytes().decode()

    def doubtful(self) -> list[tuple[int, str, bool]]:
        """(text, token, spelled out?) of the stretches to decode."""
        n = len(self.points)
        p, letter, s = self.points, self.letter, self.symbol
        out: list[tuple[int, str, bool]] = []
        white = (p == 32) | ((p >= 9) & (p <= 13))
        sign = _SIGNS[p]
        twice = np.zeros(n, bool)
        twice[1:] = letter[1:] & (s[1:n] == s[: n - 1])
        cut = np.flatnonzero(np.concatenate([[True], white]))  # tokens lie between white space
        count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.append(cut, n)])
        signs = count(sign)
        # a letter and a look-alike, several look-alikes, or a doubled letter
        token = np.flatnonzero(((signs > 0) & (count(letter) > 0)) | (signs > 1) | (count(twice) > 0))
        docs, first = self.doc_of(cut[token]), cut[token]
        last = np.append(cut, n)[token + 1]
        for doc, a, b in zip(docs.tolist(), (first - self.offset[docs]).tolist(), (last - self.offset[docs]).tolist(), strict=True):
            out.append((doc, self.texts[doc][a:b].strip(), False))
        # single letters or look-alikes with gaps between, three at least, a letter among them
        solid = letter | (sign & ~_GAPS[p])
        edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        wide = np.concatenate([[0], np.cumsum(~_GAPS[p])])
        single = (end - start) == 1
        tied = single[1:] & single[:-1] & (wide[start[1:]] == wide[end[:-1]]) & (self.doc_of(start[1:]) == self.doc_of(start[:-1]))
        edge = np.flatnonzero(np.diff(np.concatenate([[False], tied, [False]]).astype(np.int8)))
        for first, last in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if last - first >= 2:
                a, b = int(start[first]), int(end[last])
                if letter[a:b].any():
                    doc = int(self.doc_of(np.array([a]))[0])
                    out.append((doc, self.texts[doc][a - int(self.offset[doc]) : b - int(self.offset[doc])], True))
        return out


class Openings:
    """The first letters of wanted words as a trie, walked along all paths of a lattice at once."""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word[:4]:
                node = node.setdefault(ord(c) - 97, {})
            node[None] = True

    def reached(self, steps: list[list[tuple[int | None, float]]]) -> bool:
        """Whether some path spells a word that begins like a wanted one. A word begins at the first step or after a mark."""
        now = {id(self.root): self.root}
        for step in steps:
            then: dict[int, dict] = {}
            for letter, _ in step:
                if letter is None:
                    then.update(now)
                elif letter == MARK:
                    then[id(self.root)] = self.root
                else:
                    for node in now.values():
                        child = node.get(letter)
                        if child is not None:
                            if None in child:
                                return True
                            then[id(child)] = child
            now = then
        return False


_EDGE_RUNS = "".join(LOOK_ALIKE)


def trimmed(token: str) -> str:
    """A token without the runs of three or more equal signs, or closing marks, at its edges."""
    def cut(t: str) -> str:
        while t and not t[-1].isalnum():
            run = len(t) - len(t.rstrip(t[-1]))
            if t[-1] in _EDGE_RUNS and t[-1] != "!" and run < 3:
                break
            t = t[: len(t) - run]
        return t

    return cut(cut(token)[::-1])[::-1]


class Restorer:
    """Decodes doubtful tokens and keeps what ``read`` makes of their words. With ``openings`` only those of which some reading begins like a wanted word are
    decoded: no other can hold one. Tables are bounded by the number of tokens and their lengths."""

    def __init__(self, model: LetterModel, openings: Openings | None = None, read: Callable[[list[str]], Any] = list):
        self.model, self.openings, self.read = model, openings, read
        self.nothing = read([])
        self.known: dict[tuple[str, bool], Any] = {}
        self.idle: set[tuple[str, bool]] = set()

    def __call__(self, token: str, spaced: bool) -> Any:
        key = (token, spaced)
        if key in self.idle:
            return self.nothing
        if key in self.known:
            return self.known[key]
        words = self._decoded(token, spaced)
        found = self.read(words)
        if len(token) <= KEPT:
            if found:
                if len(self.known) >= MAX_DECODED:
                    self.known.clear()
                self.known[key] = found
            else:
                if len(self.idle) >= 4 * MAX_DECODED:
                    self.idle.clear()
                self.idle.add(key)
        return found

    def _decoded(self, token: str, spaced: bool) -> list[str]:
        body = token if spaced else trimmed(token)
        steps = lattice(body, spaced)
        if self.openings and not self.openings.reached(steps):
            return []
        words: list[str] = []
        for at in range(0, max(1, len(body) - PART_OVERLAP), PART - PART_OVERLAP):  # a longer stretch is decoded in parts that overlap
            words += self.model.decode(lattice(body[at : at + PART], spaced) if at else steps[:PART]).split()
        return words


def features(word: str) -> list[str]:
    """A word with its end marked, and its beginnings."""
    if len(word) < 3:
        return []
    return [f"{word}$", *(word[:k] for k in (4, 5, 6) if len(word) >= k)]


def restorer(counts_at: str, *args: Any) -> Restorer:
    """For one task; its tables go with it."""
    rows = list(_stored_rows(counts_at, ["gram", "n"]))
    grams, n = (np.concatenate([b.column(i).to_numpy() for b in rows] or [np.zeros(0, np.int64)]) for i in (0, 1))
    return Restorer(LetterModel(grams, n), *args)


def _held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def _mark(words: set[str]) -> int:
    """Of the ``MARKS`` least hashes of a text's long words, all of its words if none is long: near copies mostly share them, other texts don't."""
    long = [w for w in words if len(w) >= LONG] or words
    least = sorted(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in long)[:MARKS]
    return int.from_bytes(hashlib.blake2b(b"".join(least), digest_size=8).digest(), "little", signed=True)


def training_rows(docs: DataFrame, labels: DataFrame, counts_at: str, most: int = MAX_TRAIN) -> DataFrame:
    """(y, features): at most ``most`` labelled documents outside the held-out fifth, one for each mark and label: that of the least features, so that
    two runs learn from the same rows."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).dropna().filter(~_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    # at most `most` rows of 12 bytes, so safe to broadcast
    sample = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))

    def run(batches):
        restore = restorer(counts_at)
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            letters = Letters(texts)
            found: list[set[str]] = [set() for _ in texts]
            docs_of = letters.doc_of(letters.start)
            for i, doc in enumerate(docs_of.tolist()):
                found[doc].add(letters.word(i))
            for doc, token, spaced in letters.doubtful():
                found[doc].update(restore(token, spaced))
            marks = [_mark(words) for words in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.int64()), batch.column("y"), pa.array([sorted({f for w in ws for f in features(w)}) for ws in found], pa.list_(pa.string()))],
                ["mark", "y", "features"])

    rows = docs.join(sample, "doc_id").select("text", "y").mapInArrow(run, "mark bigint, y int, features array<string>")
    once = rows.groupBy("mark", "y").agg(F.min("features").alias("features"))
    return once.orderBy("mark", "y").limit(most).select("y", "features")


def logistic(rows: list[list[int]], y: np.ndarray, width: int, ridge: float = 0.1, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression over presence features, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.fromiter((c for r in rows for c in r), np.int64, len(row))
    weight, bias, ahead, ahead_bias = np.zeros(width), 0.0, np.zeros(width), 0.0
    most = max([len(r) for r in rows], default=0) + 1
    rate = 4.0 / (most * max(1, len(rows)) ** 0.5 + ridge)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, ahead[column], minlength=len(rows)) + ahead_bias, -30, 30)))
        error = p - y
        new = ahead - rate * (np.bincount(column, error[row], minlength=width) + ridge * ahead)
        new_bias = ahead_bias - rate * error.sum()
        k = (step - 1) / (step + 2)
        ahead, ahead_bias = new + k * (new - weight), new_bias + k * (new_bias - bias)
        weight, bias = new, new_bias
    return weight, bias


def lower_bound(part: np.ndarray, whole: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    """Of the confidence interval of a share."""
    p, z = part / whole, spread * spread / whole
    return (p + z / 2 - np.sqrt(z * (p * (1 - p) + z / 4))) / (1 + z)


@dataclass(frozen=True)
class Model:
    """``weights``: feature to (weight, sure share or 0); ``counts_at``: the stored letter counts."""

    weights: dict[str, tuple[float, float]]
    bias: float
    counts_at: str

    def score(self, found: set[str]) -> float:
        total = self.bias + math.fsum(self.weights[f][0] for f in sorted(found))
        return max([1 / (1 + math.exp(-max(-30.0, min(30.0, total)))), *(self.weights[f][1] for f in found)])


def fit(rows: DataFrame, counts_at: str, most: int = MAX_FEATURES) -> Model:
    """Chooses and weights features; rows: (y, features), a bounded number of them."""
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    prior = (positive + 1) / (n + 4)
    if not positive or positive == n:
        return Model({}, min(math.log(prior / (1 - prior)), -0.1), counts_at)
    counted = rows.select("y", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("y").alias("pos")).filter(F.col("pos") >= MIN_POSITIVE)
    expected = F.col("n") * F.lit(positive / n)
    gain = (F.col("pos") - expected) / F.sqrt(expected)
    chosen = counted.filter(F.col("pos") > 2 * expected).orderBy(gain.desc(), "f").limit(most).collect()
    place = {r["f"]: i for i, r in enumerate(chosen)}
    kept = rows.select("y", F.array_intersect("features", F.lit(list(place)) if place else F.array().cast("array<string>")).alias("f")).collect()
    y = np.array([r["y"] for r in kept], float)
    weight, bias = logistic([[place[f] for f in r["f"]] for r in kept], y, len(chosen))
    part, whole = (np.array([r[k] for r in chosen], float) for k in ("pos", "n"))
    sure = np.where(part >= PURE * whole, lower_bound(part, whole), 0.0)
    return Model({f: (float(weight[i]), float(sure[i]) if sure[i] >= SURE else 0.0) for f, i in place.items()}, float(bias), counts_at)


def score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """``docs``, which need a column text, with a column ``into`` (in place of one of that name)."""
    from pyspark.sql import types as T

    docs = docs.drop(into)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())])

    def run(batches):
        restore = restorer(model.counts_at, Openings(f.rstrip("$") for f in model.weights),
                           lambda words: [f for word in words for f in features(word) if f in model.weights])
        wanted = np.zeros(BASE**4, bool)
        for f in model.weights:
            code = 0
            for c in f.rstrip("$")[:4].ljust(4, "{"):
                code = code * BASE + ord(c) - 97
            wanted[code] = True
        none = model.score(set())
        for batch in chunks(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            letters = Letters(texts)
            found: dict[int, set[str]] = {}
            hits = np.flatnonzero(wanted[letters.beginnings()])
            for i, doc in zip(hits.tolist(), letters.doc_of(letters.start[hits]).tolist(), strict=True):
                found.setdefault(doc, set()).update(f for f in features(letters.word(i)) if f in model.weights)
            for doc, token, spaced in letters.doubtful():
                if hits_of := restore(token, spaced):
                    found.setdefault(doc, set()).update(hits_of)
            scores = [model.score(found[i]) if i in found else none for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts letters over all documents, then fits on the bounded sample."""
    counts_at, rows_at = scratch_path(docs.sparkSession, "letter-counts"), scratch_path(docs.sparkSession, "toxic-rows")
    letter_counts(docs).write.parquet(counts_at)
    training_rows(docs, labels, counts_at).write.parquet(rows_at)
    return fit(docs.sparkSession.read.parquet(rows_at), counts_at)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
