"""Phrases whose words keep together, counted in quotient filters.

1. ``shards``: tasks cut whole texts into words and keep a shard's word list, counts and word sequence (breaks between pieces) as a row per
   language. Ranges of all word lists are added up; words of ``least`` occurrences or more are numbered (no phrase of that count holds another
   word), and each shard is answered with the numbers of its own words, so no dictionary is shipped whole.
2. ``Filter``: n-grams of packed word numbers are permuted one to one and split into a quotient and the full remainder. A filter holds
   its entries in order: run lengths of the quotients as bits (two a slot), remainders in as many bytes as they need, counts in one byte or nine.
   Nothing is lost; permuted back, the entries are the n-grams. Permuted values are even, so quotient ranges deal the entries evenly, whatever
   n-gram is frequent, and a shard sends one entry per different n-gram.
3. ``merged``: filters of one quotient range from all shards are merged in order and their counts added.
   First for pairs; each shard learns which of its pairs are frequent, and then counts the phrases of 3 to 5 words all of whose pairs are.
4. ``collocations``: scores, inclusion and ranks are joins and groups over the frequent phrases.

Up to 2^32 different words of ``least`` occurrences can be numbered; more raise an error. Defined results: null texts and languages are "" and ``und``; an empty table
gives no rows; repeated rows count again; texts and words may have any length.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.llm.words import chunks, mix
from merchlens.session import scratch_path

LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text in a shard, words of all shards' lists in a range of them, and entries of a quotient range, both on average.
SHARD, LIST, RANGE = 32 << 20, 1 << 19, 1 << 22

_BREAK = b"\n"
_TABLE = bytes(10 if i in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))


# ---------------------------------------------------------------- shards

SHARDS = "shard long, lang string, n_words long, n_different long, words array<binary>, counts array<long>, sequence binary"
LISTS = "part int, shard long, lang string, words array<binary>, counts array<long>, places binary"
NUMBERS = "part int, shard long, places binary, numbers binary, number long, lang string, word binary, n long"


def squeezed(ids: np.ndarray) -> bytes:
    """32-bit numbers, small ones mostly, by planes of bytes."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(ids).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueezed(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 4 * n, codec="zstd", asbytes=True) if n else b"", np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


class _Shard:
    """Words of one language in a task, numbered as they come."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[b""], self.numbers[_BREAK]
        self.ids: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> None:
        tokens = _BREAK.join([*(t.translate(_TABLE) for t in texts), b""]).replace(_BREAK, b" \n ").split(b" ")
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.uint32, len(tokens))
        self.ids.append(ids[ids > 0] - np.uint32(1))  # 0 is a break

    def row(self, shard: int, lang: str) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        counts = np.bincount(ids, minlength=len(self.numbers) - 1)[1:]
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([lang], pa.string()), pa.array([int(counts.sum())], pa.int64()), pa.array([len(counts)], pa.int64()),
             pa.array([list(self.numbers)[2:]], pa.list_(pa.binary())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([squeezed(ids)], pa.binary())],
            ["shard", "lang", "n_words", "n_different", "words", "counts", "sequence"])


def _shard_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, size = TaskContext.get().partitionId() << 32, 0
    held: defaultdict[str, _Shard] = defaultdict(_Shard)
    for part in chunks(batches):
        by_lang = defaultdict(list)
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
            by_lang[lang].append(text)
            size += len(text)
        for lang, texts in by_lang.items():
            held[lang].add(texts)
        if size >= SHARD:
            for lang in list(held):
                yield held.pop(lang).row(number, lang)
                number += 1
            size = 0
    for lang, shard in held.items():
        yield shard.row(number, lang)
        number += 1


def shards(docs: DataFrame) -> DataFrame:
    """A row per ``SHARD`` bytes of text, or the rest of a task's, and language; the number of a shard is fixed once the frame is stored."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_shard_batch, SHARDS)


def _split_lists(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """A shard's word list by ranges of the words' crc32."""
    for batch in batches:
        for i in range(batch.num_rows):
            words, counts = batch.column("words")[i].values, np.asarray(batch.column("counts")[i].values, np.int64)
            if not len(words):
                continue
            part = np.fromiter(map(crc32, words.to_pylist()), np.int64, len(words)) >> (32 - top)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange((1 << top) + 1))
            found = np.flatnonzero(np.diff(edges))
            cuts = pa.array(np.append(edges[found], len(order)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), pa.array([batch.column("shard")[i].as_py()] * len(found), pa.int64()), pa.array([batch.column("lang")[i].as_py()] * len(found), pa.string()),
                 pa.ListArray.from_arrays(cuts, words.take(pa.array(order))), pa.ListArray.from_arrays(cuts, pa.array(counts[order])),
                 pa.array([(order[edges[p] : edges[p + 1]] + 1).astype("<u4").tobytes() for p in found.tolist()], pa.binary())],
                ["part", "shard", "lang", "words", "counts", "places"])


def _number_words(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part. The frequent words of a part, numbered from 1, and for each shard its places of them with their numbers."""
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("places", pa.binary()), ("numbers", pa.binary()), ("number", pa.int64()),
                        ("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
    held: list[dict] = []

    def result() -> Iterator[pa.RecordBatch]:
        total: defaultdict[str, defaultdict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        for row in held:
            own = total[row["lang"]]
            for word, n in zip(row["words"], row["counts"], strict=True):
                own[word] += n
        frequent = [(lang, word) for lang in sorted(total) for word in sorted(w for w, n in total[lang].items() if n >= least)]
        if not frequent:
            return
        part, number = held[0]["part"], {lang: {} for lang in total}
        for i, (lang, word) in enumerate(frequent, 1):
            number[lang][word] = i
        rows = [{"part": part, "number": i, "lang": lang, "word": word, "n": total[lang][word]} for i, (lang, word) in enumerate(frequent, 1)]
        for row in held:
            known = np.fromiter((number[row["lang"]].get(w, 0) for w in row["words"]), np.uint32, len(row["words"]))
            at = np.flatnonzero(known)
            if len(at):
                rows.append({"part": part, "shard": row["shard"], "places": np.frombuffer(row["places"], "<u4")[at].tobytes(), "numbers": known[at].tobytes()})
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    for row in _rows(batches):
        if held and held[0]["part"] != row["part"]:
            yield from result()
            held = []
        held.append(row)
    if held:
        yield from result()


def _renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's sequence in numbers of its own frequent words from 1 (0: break or rare word), and the dictionary's numbers of these."""
    for row in _rows(batches):
        ids = unsqueezed(row["sequence"])
        places = np.concatenate([np.frombuffer(k["places"], "<u4") for k in row["known"]])
        numbers = np.concatenate([np.frombuffer(k["numbers"], "<u4").astype("<u8") + np.uint64(k["before"]) for k in row["known"]])
        order = np.argsort(places)
        table = np.zeros(int(max(ids.max(initial=0), places.max())) + 1, np.uint32)
        table[places[order]] = np.arange(1, len(places) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["shard"]], pa.int64()), pa.array([squeezed(table[ids])], pa.binary()), pa.array([numbers[order].tobytes()], pa.binary())],
            ["shard", "sequence", "known"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def numbered_shards(rows: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Of stored ``shards``: (shard, sequence, known), the sequences in frequent words; (number, lang, word, n), the frequent words numbered from 1.

    Answers grow with the corpus and Spark can't tell how large binary values are, so they are never broadcast.
    Word lists go to ranges of crc32, are added up there, and the answers go back to the shards. Both tables are stored."""
    entries = rows.agg(F.sum("n_different")).first()[0] or 0
    top = max(0, int(entries // LIST).bit_length())
    lists = rows.select("shard", "lang", "words", "counts").mapInArrow(partial(_split_lists, top=top), LISTS)
    answers = _stored(lists.repartition("part").sortWithinPartitions("part").mapInArrow(partial(_number_words, least=least), NUMBERS), "numbers")
    found = answers.filter("shard is null")
    sizes = found.groupBy("part").agg(F.max("number").alias("size"))
    before = _stored(sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before")), "before")
    words = _stored(found.join(before, "part").select((F.col("number") + F.col("before")).alias("number"), "lang", F.col("word").cast("string").alias("word"), "n"), "words")
    known = answers.filter("shard is not null").join(before, "part").groupBy("shard").agg(F.collect_list(F.struct("before", "places", "numbers")).alias("known"))
    return _stored(rows.select("shard", "sequence").join(known.hint("merge"), "shard").mapInArrow(_renumber, "shard long, sequence binary, known binary"), "numbered"), words


# ---------------------------------------------------------------- quotient filters

ODD = 0x9E3779B97F4A7C15


def limbs(order: int, bits: int) -> list[int]:
    """Bits of the parts that a packed n-gram of so many words is held in: two words a part."""
    return [2 * bits] * (order // 2) + [bits] * (order % 2)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def _spread(parts: list[np.ndarray], i: int, turn: int) -> np.ndarray:
    other = np.uint64((turn * 8 + i + 1) * ODD & (1 << 64) - 1)
    for k, x in enumerate(parts):
        if k != i:
            other = mix(other ^ x)
    return other


def permute(parts: list[np.ndarray], widths: list[int]) -> list[np.ndarray]:
    """One to one: each part in turn takes up a hash of the others, an odd factor and its own high bits."""
    parts = [x.astype(np.uint64) for x in parts]
    for turn in range(2):
        for i, width in enumerate(widths):
            x = parts[i]
            if len(parts) > 1:
                x = x ^ (_spread(parts, i, turn) & _mask(width))
            x = (x * np.uint64(ODD)) & _mask(width)
            parts[i] = x ^ (x >> np.uint64((width + 1) // 2))
    return parts


def restore(parts: list[np.ndarray], widths: list[int]) -> list[np.ndarray]:
    """The inverse of ``permute``."""
    parts = [x.astype(np.uint64) for x in parts]
    for turn in (1, 0):
        for i in range(len(widths) - 1, -1, -1):
            width = widths[i]
            x = parts[i] ^ (parts[i] >> np.uint64((width + 1) // 2))
            x = (x * np.uint64(pow(ODD, -1, 1 << 64))) & _mask(width)
            if len(parts) > 1:
                x = x ^ (_spread(parts, i, turn) & _mask(width))
            parts[i] = x
    return parts


def _added(parts: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries in order, equal ones added up. Runs that are sorted already are merged by the stable sort."""
    if not len(counts):
        return parts, counts
    order = np.argsort(parts[0], kind="stable") if len(parts) == 1 else np.lexsort(parts[::-1])
    parts, counts = [x[order] for x in parts], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in parts])
    at = np.flatnonzero(new)
    return [x[at] for x in parts], np.add.reduceat(counts, at)


def _to_bytes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (width + 7) // 8]).tobytes()


def _from_bytes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    size = (width + 7) // 8
    if size:
        out[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return out.reshape(-1).view("<u8").astype(np.uint64)


class Filter:
    """A counting quotient filter over one range of permuted values: the range's number is the first ``top`` bits of the first part."""

    @staticmethod
    def pack(parts: list[np.ndarray], counts: np.ndarray, widths: list[int], top: int) -> bytes:
        n, left = len(counts), widths[0] - top
        q = min(left, max(0, int(n).bit_length() - 1))
        low = parts[0] & _mask(left)
        slots = (low >> np.uint64(left - q)).astype(np.int64) + np.arange(n) if q else np.arange(n)
        runs = np.zeros(n + (1 << q), np.uint8)  # a 1 per entry, a 0 after each quotient's run
        runs[slots] = 1
        big = counts >= 255
        return b"".join([
            np.array([n, q], "<u4").tobytes(), np.packbits(runs).tobytes(), _to_bytes(low & _mask(left - q), left - q),
            *[_to_bytes(x, w) for x, w in zip(parts[1:], widths[1:], strict=True)],
            np.where(big, 255, counts).astype(np.uint8).tobytes(), counts[big].astype("<u8").tobytes()])

    @staticmethod
    def unpack(data: bytes, widths: list[int], top: int, part: int) -> tuple[list[np.ndarray], np.ndarray]:
        n, q = np.frombuffer(data, "<u4", 2).tolist()
        left, at = widths[0] - top, 8
        size = (n + (1 << q) + 7) // 8
        slots = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at))[: n + (1 << q)])
        at += size
        quotient = (slots - np.arange(n)).astype(np.uint64)
        out = []
        for i, width in enumerate([left - q, *widths[1:]]):
            x = _from_bytes(data[at : at + n * ((width + 7) // 8)], n, width)
            at += n * ((width + 7) // 8)
            out.append(x | quotient << np.uint64(left - q) | np.uint64(part << left) if i == 0 else x)
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.uint64)
        big = counts == 255
        counts[big] = np.frombuffer(data, "<u8", int(big.sum()), at + n)
        return out, counts


# ---------------------------------------------------------------- counting

FILTERS = "part int, shard long, `order` int, filter binary"
MERGED = "shard long, pairs binary, gram array<long>, f long"


def _sequence(row: dict) -> np.ndarray:
    """A shard's sequence in the numbers of the dictionary; 0: break or rare word."""
    return np.concatenate([np.zeros(1, np.uint64), np.frombuffer(row["known"], "<u8")])[unsqueezed(row["sequence"])]


def _emit(shard: int, order: int, grams: list[np.ndarray], bits: int, top: int) -> Iterator[pa.RecordBatch]:
    widths = limbs(order, bits)
    parts = [grams[i] << np.uint64(bits) | grams[i + 1] if i + 1 < order else grams[i] for i in range(0, order, 2)]
    parts, counts = _added(permute(parts, widths), np.ones(len(parts[0]), np.uint64))
    piece = parts[0] >> np.uint64(widths[0] - top)
    edges = np.searchsorted(piece, np.arange((1 << top) + 1, dtype=np.uint64))
    found = np.flatnonzero(np.diff(edges))
    if len(found):
        blobs = [Filter.pack([x[edges[p] : edges[p + 1]] for x in parts], counts[edges[p] : edges[p + 1]], widths, top) for p in found.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array([shard] * len(found), pa.int64()), pa.array([order] * len(found), pa.int32()), pa.array(blobs, pa.binary())],
            ["part", "shard", "order", "filter"])


def _pairs(batches: Iterator[pa.RecordBatch], bits: int, top: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        ids = _sequence(row)
        both = (ids[:-1] > 0) & (ids[1:] > 0)
        yield from _emit(row["shard"], 2, [ids[:-1][both], ids[1:][both]], bits, top)


def _longer(batches: Iterator[pa.RecordBatch], bits: int, top: int, longest: int) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        ids = _sequence(row)
        widths = limbs(2, bits)
        frequent = np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in row["pairs"]]))
        joined = permute([ids[:-1] << np.uint64(bits) | ids[1:]], widths)[0]
        good = (ids[:-1] > 0) & (ids[1:] > 0)
        at = np.minimum(np.searchsorted(frequent, joined), len(frequent) - 1)
        good &= frequent[at] == joined
        run = good
        for order in range(3, longest + 1):
            run = run[:-1] & good[order - 2 :] if len(run) else run
            start = np.flatnonzero(run)
            yield from _emit(row["shard"], order, [ids[start + i] for i in range(order)], bits, top)


def _merge(batches: Iterator[pa.RecordBatch], bits: int, top: int, least: int, answer: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (part, order); the filters of one range are merged at a time."""
    schema = pa.schema([("shard", pa.int64()), ("pairs", pa.binary()), ("gram", pa.list_(pa.int64())), ("f", pa.int64())])
    held: list[tuple[int, list[np.ndarray], np.ndarray]] = []
    at = None

    def result() -> Iterator[pa.RecordBatch]:
        part, order = at
        widths = limbs(order, bits)
        parts, counts = _added([np.concatenate(x) for x in zip(*[p for _, p, _ in held], strict=True)], np.concatenate([c for _, _, c in held]))
        keep = np.flatnonzero(counts >= least)
        parts, counts = [x[keep] for x in parts], counts[keep]
        if not len(keep):
            return
        grams = []
        for x, width in zip(restore(parts, widths), widths, strict=True):
            grams += [x >> np.uint64(bits), x & _mask(bits)] if width > bits else [x]
        flat = np.stack(grams, axis=1).astype(np.int64).ravel()
        lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, order, dtype=np.int32), pa.array(flat))
        none = len(keep)
        yield pa.RecordBatch.from_arrays([pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary()), lists, pa.array(counts.astype(np.int64))], schema=schema)
        if answer:
            rows = []
            for shard, (own, *_), _ in held:
                i = np.minimum(np.searchsorted(parts[0], own), len(keep) - 1)
                own = own[parts[0][i] == own]
                if len(own):
                    rows.append({"shard": shard, "pairs": own.astype("<u8").tobytes()})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    for row in _rows(batches):
        if at != (row["part"], row["order"]):
            if held:
                yield from result()
            at, held = (row["part"], row["order"]), []
        held.append((row["shard"], *Filter.unpack(row["filter"], limbs(row["order"], bits), top, row["part"])))
    if held:
        yield from result()


def _stored(df: DataFrame, name: str) -> DataFrame:
    at = scratch_path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def merged(filters: DataFrame, bits: int, top: int, least: int, answer: bool) -> DataFrame:
    """The sum of all filters: frequent n-grams, and with ``answer`` the frequent pairs (permuted) of each shard."""
    dealt = filters.repartition("part").sortWithinPartitions("part", "order")
    return _stored(dealt.mapInArrow(partial(_merge, bits=bits, top=top, least=least, answer=answer), MERGED), "merged")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gram, f): phrases of 2 to ``longest`` words with ``least`` occurrences or more, as numbers of (number, lang, word, n), the frequent words; and
    (lang, total): words in all. All are stored tables."""
    spark = docs.sparkSession
    rows = _stored(shards(docs), "shards")
    totals = _stored(rows.groupBy("lang").agg(F.sum("n_words").alias("total")), "totals")
    numbered, words = numbered_shards(rows, least)
    size, tokens = words.agg(F.max("number")).first()[0] or 0, totals.agg(F.sum("total")).first()[0] or 0
    bits = max(1, int(size).bit_length())
    if bits > 32:
        raise ValueError(f"{size} frequent words; 2^32 can be numbered")
    top = min(2 * bits, max(0, int(tokens // RANGE).bit_length()))
    pairs = merged(numbered.mapInArrow(partial(_pairs, bits=bits, top=top), FILTERS), bits, top, least, True)
    own = pairs.filter("shard is not null").groupBy("shard").agg(F.collect_list("pairs").alias("pairs"))
    longer = numbered.join(own.hint("merge"), "shard").mapInArrow(partial(_longer, bits=bits, top=top, longest=longest), FILTERS)
    more = merged(longer, bits, top, least, False)
    grams = pairs.filter("shard is null").select("gram", "f").unionByName(more.select("gram", "f"))
    return grams, words, totals


def exact_score(a: str, n: str, l: str, r: str) -> Column:
    """floor(1000 a n / (l r)) in whole numbers of up to 38 digits."""
    a, n, l, r = (F.col(c).cast("decimal(19,0)") for c in (a, n, l, r))
    above = (a * F.lit(1000).cast("decimal(4,0)")).cast("decimal(20,0)") * n.cast("decimal(18,0)")
    return F.call_function("div", above, l * r)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the ``top`` phrases of 2 to ``longest`` words by score = floor(1000 a n / (l r)) of the
    lowest-scoring cut, without those inside a longer phrase of the same count."""
    grams, words, totals = frequent_phrases(docs, least, longest)
    counts = grams.unionByName(words.select(F.array("number").alias("gram"), F.col("n").alias("f")))
    inner = grams.filter(F.size("gram") > 2).select("f", F.explode(F.expr(
        "flatten(transform(sequence(2, size(gram) - 1), k -> transform(sequence(1, size(gram) - k + 1), i -> slice(gram, i, k))))")).alias("gram")) \
        .groupBy("gram").agg(F.max("f").alias("over"))
    kept = grams.join(inner, "gram", "left").filter("over is null or over < f").select("gram", "f")
    cuts = kept.select("gram", "f", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.expr("slice(gram, 1, k)"), "tail": F.expr("slice(gram, k + 1, size(gram) - k)")})
    cuts = cuts.join(counts.toDF("head", "l"), "head").join(counts.toDF("tail", "r"), "tail")
    first = words.select(F.col("number").alias("first"), "lang").join(totals, "lang")
    cuts = cuts.withColumn("first", F.col("gram")[0]).join(first, "first")
    scored = cuts.withColumnRenamed("total", "n").withColumn("score", exact_score("f", "n", "l", "r"))
    best = scored.groupBy("gram", "lang", "f", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    spelled = best.select("gram", F.posexplode("gram").alias("at", "number")).join(words.select("number", "word"), "number") \
        .groupBy("gram").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rows = best.join(spelled, "gram").select("lang", "phrase", F.col("f").alias("a"), "b.l", "b.r", "n", "b.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return rows.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _gram_sql(k: int) -> str:
    words = " || ' ' || ".join(f"lead(word, {i}) over p" for i in range(k))
    return (f"select lang, {words} as phrase, {k} as k from words "
            "window p as (partition by lang, row_no, piece order by pos) qualify lead(word, " f"{k - 1}) over p is not null")


#: The same rows in DuckDB, every phrase counted as a string.
OP13_SQL = f"""
with docs as (
    select row_number() over () as row_no, coalesce(lang, 'und') as lang,
           translate(coalesce(text, ''), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}', '{"abcdefghijklmnopqrstuvwxyz"}') as text from documents),
pieces as (select lang, row_no, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) as body, generate_subscripts(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]'), 1) as piece from docs),
words as (
    select lang, row_no, piece, unnest(list) as word, generate_subscripts(list, 1) as pos
    from (select lang, row_no, piece, list_filter(string_split_regex(body, '[\\x20\\x09]'), lambda x: x <> '') as list from pieces)),
n_of as (select lang, count(*) as n from words group by 1),
grams as (select lang, phrase, k, count(*) as a from ({" union all ".join(_gram_sql(k) for k in range(1, 6))}) group by all having count(*) >= {LEAST}),
cuts as (
    select g.lang, g.phrase, g.a, c.k, n,
           array_to_string(string_split(phrase, ' ')[1:c.k], ' ') as head, array_to_string(string_split(phrase, ' ')[c.k + 1:], ' ') as tail
    from grams g join n_of using (lang), (select unnest(range(1, 5)) as k) c where c.k < g.k and g.k > 1),
scored as (
    select u.lang, u.phrase, u.a, u.n, u.k, x.a as l, y.a as r, (1000::hugeint * u.a * u.n) // (x.a::hugeint * y.a) as score
    from cuts u join grams x on x.lang = u.lang and x.phrase = u.head join grams y on y.lang = u.lang and y.phrase = u.tail),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_ones as (
    select distinct s.lang, s.phrase from grams s join (
        select g.lang, g.a, array_to_string(string_split(phrase, ' ')[i.i:i.i + j.j - 1], ' ') as part
        from grams g, (select unnest(range(1, 5)) as i) i, (select unnest(range(2, 5)) as j) j where j.j < g.k and i.i + j.j - 1 <= g.k) b
    on s.lang = b.lang and s.phrase = b.part and 100 * b.a >= 100 * s.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from best b where not exists (select 1 from inner_ones i where i.lang = b.lang and i.phrase = b.phrase)
qualify rank <= {TOP}"""
