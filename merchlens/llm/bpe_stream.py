"""Byte-pair encoding as a bounded-lookahead streaming transducer, and streaming decoding.

A merge list has a sufficient lookahead L: once L more symbols have been read, no later symbol changes a
token. ``lookahead`` computes an upper bound from the list alone. ``Transducer`` takes one pre-token, of any length, in parts. It
holds at most 2 L symbols and as many as the longest token (at least L) has: when they are full it merges them, emits the tokens
that end L symbols or more before the end, and goes on with the rest; at the end of the pre-token everything is stable.

``Stream`` takes texts in parts of at most ``PART`` code points, however long they are. A part ends where
normalisation and the cutter of pre-tokens can start anew (``safe_cut``); a pre-token that goes on in the next part stays in its
transducer. Beside the part, an encoder holds that one transducer and tables of at most twice ``KNOWN`` short pre-tokens
with the ids that a transducer gave them. Only what normalisation can't divide, a run of combining marks, is held whole.

``Decoder`` is the incremental byte-to-text machine: token ids in parts of any size to text, an unfinished UTF-8
sequence carried from call to call. The vocabulary's own form has token strings with spaces between; ``Bpe.plain`` gives the text's bytes.

Defined results: null texts are empty (no ids, empty decoded text); special strings in a text get their ids;
bytes that are no UTF-8 decode to U+FFFD; repeated rows are encoded one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from merchlens.llm.pretokens import LETTER, OTHER, Points, byte_alphabet, normalised, split_special
from merchlens.llm.words import chunks

#: Code points of a part.
PART = 1 << 19
#: Pre-tokens in each of the two tables of those met lately; longer ones than KNOWN_BYTES are not remembered.
KNOWN = 1 << 16
KNOWN_BYTES = 64


def lookahead(pairs: list[tuple[int, int]], merged: list[int], size: dict[int, int]) -> int:
    """Symbols after which a token is stable, an upper bound.

    Suppose two texts agree up to some place. Merges go by rank, so a difference moves left past a token v only when a
    pair (v, t) merges in one text and not in the other, t being what starts at the present border; after that the
    border is at v or vt, and only later ranks count. ``reach[t]`` is the farthest a border at t can still move; going
    through the ranks from the last to the first, each rule adds its own step."""
    reach: dict[int, int] = {}
    for (v, t), vt in zip(reversed(pairs), reversed(merged), strict=True):
        beyond = reach.get(vt, 0)
        moved = size[v] + max(reach.get(v, 0), beyond)
        reach[t] = max(reach.get(t, 0), moved)
        reach[v] = max(reach.get(v, 0), beyond)
    return max(reach.values(), default=0)


class Merges:
    """A merge list over the byte alphabet; the last symbol of a pre-token carries ``suffix``."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        pairs, merged = [], []
        for a, b in merges:
            pairs.append((vocabulary[a], vocabulary[b]))
            merged.append(vocabulary[a + b])
        letters = byte_alphabet()
        self.inner = np.array([vocabulary.get(c, -1) for c in letters], np.int32)
        self.final = np.array([vocabulary.get(c + suffix, -1) for c in letters], np.int32)
        #: Rank of a pair of ids, left << 32 | right; the first of equal rules counts.
        self.rank = {a << 32 | b: r for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.merged = np.array(merged, np.int32)
        self.key = np.array(sorted(self.rank), np.int64)
        self.key_rank = np.array([self.rank[k] for k in self.key.tolist()], np.int32)
        size = {i: max(1, len(t.removesuffix(suffix) if suffix else t)) for t, i in vocabulary.items()}
        self.lookahead = lookahead(pairs, merged, size)
        self.longest = max(size.values(), default=1)
        self.size = size

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of one sequence of symbols, by a queue of pairs."""
        n = len(symbols)
        rank, merged = self.rank, self.merged
        queue = [(r, i) for i in range(n - 1) if (r := rank.get(symbols[i] << 32 | symbols[i + 1])) is not None]
        if not queue:
            return symbols
        symbols = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if symbols[i] < 0 or j >= n or rank.get(symbols[i] << 32 | symbols[j]) != r:
                continue
            symbols[i], symbols[j] = int(merged[r]), GONE
            after[i] = right = after[j]
            if right < n:
                before[right] = i
                if (new := rank.get(symbols[i] << 32 | symbols[right])) is not None:
                    heapq.heappush(queue, (new, i))
            left = before[i]
            if left >= 0 and (new := rank.get(symbols[left] << 32 | symbols[i])) is not None:
                heapq.heappush(queue, (new, left))
        return [x for x in symbols if x != GONE]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.full(len(left), NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.key_rank[at], NONE)

    def merge_all(self, tails: list[bytes]) -> list[np.ndarray]:
        """Ids of the last bytes of many pre-tokens, side by side: each round merges, in every one that still has a pair, the leftmost of least rank."""
        flat = np.frombuffer(b"".join(tails), np.uint8)
        size = np.fromiter(map(len, tails), np.int64, len(tails))
        last = np.cumsum(size) - 1
        symbol = self.inner[flat]
        symbol[last] = self.final[flat[last]]
        lane = np.repeat(np.arange(len(tails)), size)
        rank = np.full(len(symbol), NONE, np.int32)
        rank[:-1] = np.where(lane[1:] == lane[:-1], self._ranks(symbol[:-1], symbol[1:]), NONE)
        ids, lanes = [], []
        while len(symbol):
            first = np.flatnonzero(np.diff(lane, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(lane)))
            over = least == NONE
            if over.any():  # nothing left to merge there
                ids.append(symbol[over])
                lanes.append(lane[over])
                symbol, lane, rank, least = symbol[~over], lane[~over], rank[~over], least[~over]
            hit = np.flatnonzero(rank == least)
            hit = hit[np.diff(lane[hit], prepend=-1) != 0]
            symbol[hit] = self.merged[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))
            symbol, lane, rank = symbol[keep], lane[keep], rank[keep]
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = NONE
            changed = changed[changed + 1 < len(lane)]
            changed = changed[lane[changed] == lane[changed + 1]]
            rank[changed] = self._ranks(symbol[changed], symbol[changed + 1])
        ids, lanes = np.concatenate(ids), np.concatenate(lanes)
        return np.split(ids[np.argsort(lanes, kind="stable")], np.cumsum(np.bincount(lanes, minlength=len(tails)))[:-1])


#: Rank of what is no pair.
NONE = np.int32(2**31 - 1)
#: A place whose symbol went into the one before it; -1 is a byte without a symbol.
GONE = -2


class Transducer:
    """Encodes one pre-token that comes in parts: ``feed`` gives the ids that are stable, ``finish`` the rest."""

    def __init__(self, merges: Merges, ahead: int | None = None):
        self.merges, self.ahead = merges, merges.lookahead if ahead is None else ahead
        self.most = 2 * self.ahead + max(self.ahead, merges.longest)
        self.held: list[int] = []
        self.last = b""  # its symbol depends on whether it ends the pre-token

    def feed(self, part: bytes) -> list[int]:
        part = self.last + part
        self.last, out, at = part[-1:], [], 0
        symbols = self.merges.inner[np.frombuffer(part[:-1], np.uint8)].tolist()
        while at < len(symbols):
            room = self.most - len(self.held)
            self.held += symbols[at : at + room]
            at += room
            if len(self.held) >= self.most:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        out, at = [], 0
        for token in self.merges.merge(self.held):
            end = at + self.merges.size[token]
            if end > len(self.held) - self.ahead:
                break
            out.append(token)
            at = end
        self.held = self.held[at:]
        return out

    def finish(self) -> list[int]:
        out = self.merges.merge([*self.held, int(self.merges.final[self.last[0]])]) if self.last else []
        self.held, self.last = [], b""
        return out


def transduce(merges: Merges, pieces: list[bytes]) -> list[np.ndarray]:
    """Ids of whole pre-tokens, none empty. What a transducer holds at its end is at most a window; the ends of all are merged side by side."""
    stable, tails = {}, list(pieces)
    for i, piece in enumerate(pieces):
        if len(piece) > merges.longest + merges.lookahead:  # a shorter one fills no window
            machine = Transducer(merges)
            stable[i] = machine.feed(piece)
            tails[i] = piece[len(piece) - len(machine.held) - 1 :]
    out = merges.merge_all(tails)
    for i, ids in stable.items():
        out[i] = np.concatenate([np.array(ids, np.int32), out[i]])
    return out


class Decoder:
    """Token ids to text: the bytes of each token in turn, ``between`` them, to UTF-8. The state is an unfinished character and whether a token has come."""

    def __init__(self, table: list[bytes], between: bytes = b""):
        self.table, self.between, self.started = table, between, False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        raw = self.between.join([self.table[i] for i in ids])
        raw, self.started = (self.between + raw if self.started else raw), True
        return self.machine.decode(raw)

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


def _plain(token: str, suffix: str, back: dict[str, int]) -> bytes:
    """The bytes that a token stands for; a suffix is a space, a special string itself."""
    body, end = (token.removesuffix(suffix), b" ") if suffix and token.endswith(suffix) else (token, b"")
    return (bytes(back[c] for c in body) if all(c in back for c in body) else body.encode()) + end


def _divides(text: str, at: int, special: Iterable[str]) -> bool:
    """Whether what lies before ``at`` and what follows can be normalised and cut by themselves, but for a run of letters or of others
    that goes on. No mark or jamo may compose with what lies before, no ending may follow an apostrophe, no special string be cut."""
    c = text[at]
    if unicodedata.category(c)[0] == "M" or unicodedata.combining(c) or 0x1160 <= ord(c) <= 0x11FF:
        return False
    if c == "'":  # it begins a run of others, or that run is no ending
        if text[at : at + 2] != "''" and not (text[at - 1].isascii() and text[at - 1].isalnum() or text[at - 1] in " \n\t"):
            return False
    elif (c.isalpha() or not c.isascii()) and "'" in text[max(0, at - 3) : at]:
        return False
    return not any(s in text[max(0, at - len(s) + 1) : at + len(s) - 1] for s in special)


def safe_cut(text: str, start: int, most: int, special: Iterable[str] = ()) -> int:
    """Where the part that starts at ``start`` ends: the last place within ``most`` code points that divides the text, white space if there
    is any in the second half; else the first place beyond."""
    if len(text) - start <= most:
        return len(text)
    to = start + most
    white = max(text.rfind(c, start + most // 2 + 1, to + 1) for c in " \n\t")
    if white > start and _divides(text, white, special):
        return white
    down = next((at for at in range(to, start, -1) if _divides(text, at, special)), None)
    return next((at for at in range(to + 1, len(text)) if _divides(text, at, special)), len(text)) if down is None else down


class Known:
    """Ids of pre-tokens met lately. When the new table is full it becomes the old one; what is asked for again moves back."""

    def __init__(self, most: int = KNOWN):
        self.most, self.new, self.old = most, {}, {}

    def put(self, key: int, ids: bytes) -> None:
        if len(self.new) >= self.most:
            self.new, self.old = {}, self.new
        self.new[key] = ids

    def get(self, keys: list[int]) -> list[bytes | None]:
        found = []
        for key in keys:
            ids = self.new.get(key)
            if ids is None and (ids := self.old.pop(key, None)) is not None:
                self.put(key, ids)
            found.append(ids)
        return found


class Bpe:
    """A vocabulary file: merges, special strings, and the bytes of each token as the vocabulary spells it and as text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        model = known["model"]
        suffix = model["end_of_word_suffix"] or ""
        self.merges = Merges(model["vocab"], model["merges"], suffix)
        self.special = {t["content"]: t["id"] for t in known["added_tokens"]}
        spelling = {i: t for t, i in (model["vocab"] | self.special).items()}
        every = [spelling.get(i, "") for i in range(max(spelling, default=-1) + 1)]
        back = {c: b for b, c in enumerate(byte_alphabet())}
        self.spelled = [t.encode() for t in every]
        self.bytes = [_plain(t, suffix, back) for t in every]
        self.known = Known()

    def joined(self) -> Decoder:
        """As the vocabulary's library decodes: token strings with a space between."""
        return Decoder(self.spelled, b" ")

    def plain(self) -> Decoder:
        return Decoder(self.bytes)


class Stream:
    """Encodes texts one after another, part by part."""

    def __init__(self, bpe: Bpe, part: int = PART):
        self.bpe, self.part = bpe, part
        self.open: Transducer | None = None
        self.kind = OTHER  # of the open pre-token
        self.held = 0  # most symbols held between two parts, most code points of a part
        self.longest = 0

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """For each text, in order, the ids that became stable, in one or more parts; True with its last part."""
        parts: list[tuple[str, bool]] = []
        size = 0
        for text in texts:
            at = 0
            while True:
                room = self.part - size
                if parts and len(text) - at > room:  # a text is cut only where a part begins with it
                    yield from self._part(parts)
                    parts, size = [], 0
                    continue
                end = safe_cut(text, at, room, self.bpe.special)
                parts.append((text[at:end], end == len(text)))
                size, at = size + end - at, end
                if at == len(text):
                    break
        if parts:
            yield from self._part(parts)

    def _part(self, parts: list[tuple[str, bool]]) -> Iterator[tuple[np.ndarray, bool]]:
        """Ids of a part: the ends of texts and whole texts, the last of them perhaps unfinished."""
        segments, owner, marks = [], [], []
        before: list[int] = []  # ids of the pre-token that was open
        for i, (text, _) in enumerate(parts):
            pieces = split_special(text, self.bpe.special)
            for piece in pieces:
                if isinstance(piece, int):
                    marks.append((len(segments), i, piece))
                else:
                    segments.append(normalised(piece))
                    owner.append(i)
            unfinished = bool(text) and not parts[i][1] and isinstance(pieces[-1], str)
        points = Points(segments)
        starts, ends = points.word_level()
        machine, self.open = self.open, None
        goes_on = False
        if machine:
            at_start = not (marks and marks[0][0] == 0) and len(starts) > 0 and starts[0] == 0 and points.kind[0] == self.kind
            if at_start:
                before += machine.feed(points.strings(starts[:1], ends[:1])[0].encode("utf-8", "surrogatepass"))
                goes_on = unfinished and len(segments) == 1 and ends[0] == len(points.points)
                starts, ends = starts[1:], ends[1:]
            if goes_on:
                self.open = machine
            else:
                before += machine.finish()
        after: list[int] = []
        if unfinished and len(starts) and ends[-1] == len(points.points) and points.kind[-1] in (LETTER, OTHER):
            self.open, self.kind = Transducer(self.bpe.merges), points.kind[-1]
            after = self.open.feed(points.strings(starts[-1:], ends[-1:])[0].encode("utf-8", "surrogatepass"))
            starts, ends = starts[:-1], ends[:-1]
        self.longest = max(self.longest, sum(len(text) for text, _ in parts))
        if self.open:
            self.held = max(self.held, len(self.open.held) + 1)
        ids, done = self._pieces(points, starts, ends)
        place = done[np.searchsorted(starts, points.offset)]
        border = place[np.searchsorted(owner, np.arange(len(parts) + 1))]
        put = [(0, 0, before)] + [(int(place[s]), i, [x]) for s, i, x in marks] + [(len(ids), len(parts) - 1, after)]
        for i, (_, ended) in enumerate(parts):
            own, at = [], int(border[i])
            for where, of, new in put:
                if of == i and new:
                    own += [ids[at:where], np.array(new, np.uint32)]
                    at = where
            yield np.concatenate([*own, ids[at : int(border[i + 1])]]), ended

    def _pieces(self, points: Points, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole pre-tokens, and the number of ids before each and after all."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        known = self.bpe.known
        keys, first, which = np.unique(points.hashes(starts, ends), return_index=True, return_inverse=True)
        found = self.bpe.known.get(keys.tolist())
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            at = first[missing]
            raw = [x.encode("utf-8", "surrogatepass") for x in points.strings(starts[at], ends[at])]
            for i, piece, ids in zip(missing, raw, transduce(self.bpe.merges, raw), strict=True):
                found[i] = ids.astype(np.uint32).tobytes()
                if len(piece) <= KNOWN_BYTES:
                    self.bpe.known.put(int(keys[i]), found[i])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        table = np.frombuffer(b"".join(found), np.uint32)
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        long = size[which]
        done = np.concatenate([[0], np.cumsum(long)])
        return table[np.repeat(begin[which] - done[:-1], long) + np.arange(done[-1])], done


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with a column ``ids``, array of int, in place of one of that name."""
    from pyspark.sql import types as T

    docs = docs.drop("ids")
    schema = docs.schema

    def run(batches):
        for batch in chunks(batches, text):
            stable, sizes = [np.zeros(0, np.uint32)], [0]
            for ids, ended in Stream(loaded(vocabulary)).encode(t or "" for t in batch.column(text).to_pylist()):
                stable.append(ids)
                sizes[-1] += len(ids)
                sizes += [0] * ended
            column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int32)), pa.array(np.concatenate(stable).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "ids"])

    return docs.mapInArrow(run, T.StructType([*schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


class Digests:
    """Of one text's ids as they become stable, and of what they decode to."""

    def __init__(self, bpe: Bpe):
        self.n, self.ids, self.text, self.decoder = 0, hashlib.sha256(), hashlib.sha256(), bpe.joined()

    def feed(self, ids: np.ndarray) -> None:
        self.n += len(ids)
        self.ids.update(ids.astype("<u4").tobytes())
        self.text.update(self.decoder.feed(ids.tolist()).encode())

    def finish(self) -> tuple[int, str, str]:
        self.text.update(self.decoder.finish().encode())
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: doc_id, n_tokens, digests of the ids and of the decoded text."""
    def run(batches):
        bpe = loaded(vocabulary)
        for batch in chunks(batches):
            done, digests = [], Digests(bpe)
            for ids, ended in Stream(bpe).encode(t or "" for t in batch.column("text").to_pylist()):
                digests.feed(ids)
                if ended:
                    done.append(digests.finish())
                    digests = Digests(bpe)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x) for x in zip(*done, strict=True))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe_stream(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
