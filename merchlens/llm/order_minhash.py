"""Near-duplicate classes by Order MinHash.

A text is the sequence of its 5-word shingles, each labelled with its occurrence number, so
that no two are equal. One sketch takes the ``ORDER`` labelled shingles of least hash and keeps
them in text order; two texts share it when those shingles and their order agree, which
follows edit similarity, not only set overlap. ``SKETCHES`` sketches are the keys of buckets.

Candidates are stars first: the members of a bucket with its most connected member, so their number is linear in
members, whatever the size of a bucket. What the stars link is one component. Buckets that still hold several are units of a
second step, which verifies inside the unit: a pair between two components that shares ``AGREE`` least shingles is compared in the
unit of the first sketch that it shares, and nowhere else, unless links found there have joined the two already. So no pair
is written, and a unit returns fewer links than it holds components. A candidate is
verified by banded alignment: the longest common subsequence of the two shingle sequences
among places at most (1 - ``SIMILARITY``) of the longer text apart; it is a link when that has at least
``SIMILARITY`` of the longer text's shingles. As labelled shingles are unique, the alignment is
a longest increasing subsequence of places, n log n. Classes are the connected components of links,
found by alternating large and small stars over stored tables.

Texts with equal words (A-Z as a-z) are one node, so copies are never paired. Nodes are 64-bit
digests: 10^9 different texts hold one false copy with a chance of about 3 in 100.

Defined results: a null text counts as empty; texts without words are copies only if their bytes
are equal; a text of under five words is one shingle; repeated rows and equal ids get one class;
``class_id`` is the least doc_id of the class, null if all are null; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.words import Words, chunks, mix, raw_texts, seeds
from merchlens.session import scratch_path

SHINGLE = 5
SKETCHES = 24
ORDER = 3
SIMILARITY = 0.8
#: Marks (least shingles) that a pair between components shares: two texts at the limit share 16 of 24 on average, fewer than 10 twice in 1000 pairs.
AGREE = 10
#: Rows and shingles of a block: larger buckets are compared block by block.
MOST = 4096
HEAVY = 1 << 21
#: Buckets with more blocks than that beside those of their largest component are split by marks first.
WIDE = 8
#: Hashes held at a time for one text.
BLOCK = 1 << 21

_MIXERS = seeds(SHINGLE, 11) | np.uint64(1)
_ORDERS = seeds(64, 13) | np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Occurrence-labelled shingle hashes of 32-bit words, in text order."""
    n = min(SHINGLE, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    wide = words.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += wide[i : i + len(total)] * _MIXERS[i]
    total = mix(total)
    order = np.argsort(total, kind="stable")
    run = total[order]
    new = np.concatenate([[True], run[1:] != run[:-1]])
    if new.all():
        return total
    at = np.arange(len(run))
    label = np.empty(len(run), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(total + label * np.uint64(0x632BE59BD9B4E019))


def sketch(keys: np.ndarray, n: int = SKETCHES, order: int = ORDER) -> tuple[np.ndarray, bytes]:
    """``n`` hashes, each of the ``order`` least keys under its own hash order, taken in text order; and a byte of each order's least key."""
    take, salts = min(order, len(keys)), seeds(n, 17)
    out, marks = np.empty(n, np.uint64), np.empty(n, np.uint8)
    step = max(1, BLOCK // len(keys))
    for first in range(0, n, step):
        salt = salts[first : first + step, None]
        rank = (keys[None, :] ^ salt) * (salt | np.uint64(1))
        rank ^= rank >> np.uint64(32)
        rank *= np.uint64(0x9E3779B97F4A7C15)
        at, rows = np.empty((len(rank), take), np.int64), np.arange(len(rank))
        for i in range(take):
            at[:, i] = rank.argmin(axis=1)
            rank[rows, at[:, i]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        marks[first : first + step] = keys[at[:, 0]].astype(np.uint8)
        at.sort(axis=1)
        out[first : first + step] = mix((keys[at] * _ORDERS[:take]).sum(axis=1, dtype=np.uint64) + salt[:, 0])
    return out, marks.tobytes()


def increasing(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence."""
    if len(places) < 2 or (places[1:] > places[:-1]).all():
        return len(places)
    tails: list[int] = []
    for p in places.tolist():
        i = bisect_left(tails, p)
        if i == len(tails):
            tails.append(p)
        else:
            tails[i] = p
    return len(tails)


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Share of the longer sequence's labelled shingles in the banded alignment of both."""
    longer = max(len(a), len(b))
    if not longer or min(len(a), len(b)) < similarity * longer:
        return 0.0
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(in_a) < similarity * longer:
        return 0.0
    near = np.abs(in_a - in_b) <= (1 - similarity) * longer
    in_a, in_b = in_a[near], in_b[near]
    return increasing(in_b[np.argsort(in_a)]) / longer


def _digest(words: np.ndarray, raw: bytes) -> int:
    data = b"w" + words.tobytes() if len(words) else b"r" + raw
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, n, keys, marks): the text's digest, its number of shingles, its sketches and their marks."""
    def run(batches):
        for batch in chunks(batches):
            texts = raw_texts(batch)
            words = Words(texts)
            nodes, sizes, keys, marks = [], [], [], []
            for i, raw in enumerate(texts):
                own = words.hash[words.first[i] : words.first[i + 1]]
                parts = shingles(own.astype(np.uint32))
                nodes.append(_digest(own, raw or b""))
                sizes.append(len(parts))
                own_keys, own_marks = sketch(parts) if len(parts) else (np.zeros(0, np.uint64), b"")
                keys.append(own_keys.view(np.int64))
                marks.append(own_marks)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "text_key", "node", "n", "keys", "marks"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return source.mapInArrow(run, "doc_id bigint, text_key bigint, node bigint, n bigint, keys array<bigint>, marks binary")


def members(nodes: DataFrame) -> DataFrame:
    """(key, place, node, n, hub): rows of buckets that several nodes share, ``place`` the sketch's number; nodes: (node, n, keys). ``hub`` adds up the
    sizes of a node's buckets: an original shares more than its variants do."""
    rows = nodes.select("node", "n", F.posexplode("keys").alias("place", "key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = _stored(rows.join(sizes, "key"), "buckets")
    hubs = shared.groupBy("node").agg(F.sum("size").alias("hub"))
    return _stored(shared.drop("size").join(hubs, "node"), "members")


def stars(rows: DataFrame) -> DataFrame:
    """(node, head): each member of a bucket with the bucket's best connected member, if of like length; each pair once."""
    heads = rows.groupBy("key").agg(F.max(F.struct("hub", "node", "n")).alias("head"))
    short, long = F.least("n", "head.n"), F.greatest("n", "head.n")
    found = rows.join(heads, "key").filter((F.col("node") != F.col("head.node")) & (short >= SIMILARITY * long))
    return found.select("node", F.col("head.node").alias("head")).distinct()


def verified_stars(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (node, head) that align; texts: (node, words), one row per node. A head's text is sent once for about ``MOST`` of its pairs."""
    counts = pairs.groupBy("head").agg(F.ceil(F.count("*") / MOST).alias("parts"))
    dealt = pairs.join(counts, "head").select("node", "head", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    heads = counts.select(F.col("head").alias("node"), "head", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    both = heads.withColumn("side", F.lit(0)).unionByName(dealt.withColumn("side", F.lit(1))).join(texts, "node")

    def run(batches):
        head, first = None, shingles(np.zeros(0, np.uint32))
        for batch in batches:
            keep = []
            for h, side, words in zip(*(batch.column(c).to_pylist() for c in ("head", "side", "words")), strict=True):
                parts = shingles(np.frombuffer(words, np.uint32))
                if side == 0:
                    head, first = h, parts
                keep.append(side == 1 and h == head and aligned(parts, first) >= SIMILARITY)
            yield batch.select(["node", "head"]).filter(pa.array(keep, pa.bool_()))

    ordered = both.repartition("head", "part").sortWithinPartitions("head", "part", "side").select("node", "head", "side", "words")
    return ordered.mapInArrow(run, "node bigint, head bigint")


def units(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows of buckets that hold several components, as units that fit a task; rows: (key, node, root, n, marks, ...).

    Adds ``unit``, ``side`` and ``split``. A bucket of up to ``most`` rows and ``HEAVY`` shingles is a unit, all of side 0. A larger one is cut into blocks, a
    component of more than a block into blocks of its own, and every two blocks of different components are a unit, those of the one with side 0, those of
    the other with side 1; a block met with itself has side 0 only. Buckets of very many blocks are split before by each of the first marks of which a
    pair of ``AGREE`` shares one: ``split`` is that mark's number, else -1."""
    most = most or MOST
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_ = rows.join(sizes.select("key", "size", "weight"), "key").withColumn("large", (F.col("size") > most) | (F.col("weight") > HEAVY)).drop("size", "weight")
    small = open_.filter("not large").select(*rows.columns, F.col("key").alias("unit"), F.lit(0).alias("side"), F.lit(-1).alias("split"))
    large = open_.filter("large").drop("large").withColumn("split", F.lit(-1))
    near, many = _blocks(large, most)
    split = F.explode(F.sequence(F.lit(0), F.lit(SKETCHES - AGREE)))
    apart = rows.join(many, "key").withColumn("split", split).withColumn("bucket", F.col("key"))
    apart = apart.withColumn("key", F.xxhash64("key", "split", F.substring("marks", F.col("split") + 1, F.lit(1))))
    far = _met(apart, _parts(apart, most)).withColumn("key", F.col("bucket")).drop("bucket")
    return small.unionByName(_met(large.join(many, "key", "left_anti"), near)).unionByName(far)


def _parts(rows: DataFrame, most: int) -> DataFrame:
    """(key, root, parts, pool): blocks of a component, and of those components of the bucket that fill no block."""
    whole = lambda c, n, to: F.greatest(F.ceil(F.col(c) / most), F.ceil(F.col(n) / HEAVY)).alias(to)
    own = rows.groupBy("key", "root").agg(F.count("*").alias("own"), F.sum("n").alias("weight")).select("key", "root", "own", "weight", whole("own", "weight", "parts"))
    rest = F.when(F.col("parts") == 1, F.col("own")), F.when(F.col("parts") == 1, F.col("weight"))
    pools = own.groupBy("key").agg(F.coalesce(F.sum(rest[0]), F.lit(0)).alias("rest"), F.coalesce(F.sum(rest[1]), F.lit(0)).alias("rest_n"), F.count("*").alias("roots"))
    return own.join(pools.filter("roots > 1").select("key", whole("rest", "rest_n", "pool")), "key").select("key", "root", "parts", "pool")


def _blocks(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The parts of the buckets, and the keys of those with more than ``WIDE`` blocks beside their largest component's."""
    parts = _stored(_parts(rows, most), "parts")
    total = F.sum(F.when(F.col("parts") > 1, F.col("parts")).otherwise(0)) + F.max("pool") - F.max(F.when(F.col("parts") > 1, F.col("parts")).otherwise(0))
    return parts, parts.groupBy("key").agg(total.alias("beside")).filter(F.col("beside") > WIDE).select("key")


def _met(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of large buckets in all units of two blocks."""
    block = F.when(F.col("parts") > 1, F.xxhash64("root", F.pmod(F.xxhash64("node"), "parts"))).otherwise(F.pmod(F.xxhash64("root"), F.greatest("pool", F.lit(1))))
    placed = rows.join(parts, ["key", "root"]).withColumn("block", block).drop("parts", "pool")
    blocks = placed.groupBy("key", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    both = blocks.toDF("key", "block", "low", "high").join(blocks.toDF("key", "other", "other_low", "other_high"), "key")
    both = both.filter((F.col("block") <= F.col("other")) & (F.least("low", "other_low") < F.greatest("high", "other_high")))
    pairs = both.select("key", "block", "other", F.xxhash64("key", "block", "other").alias("unit"))
    side = lambda c, n: F.struct(F.col(c).alias("block"), F.lit(n).alias("side"))
    sides = F.when(F.col("block") == F.col("other"), F.array(side("block", 0))).otherwise(F.array(side("block", 0), side("other", 1)))
    dealt = pairs.select("key", "unit", F.inline(sides))
    return placed.join(dealt, ["key", "block"]).drop("block")


def alike(root: np.ndarray, n: np.ndarray, marks: np.ndarray, heads: int):
    """Pairs (a, b) of rows of a unit, b before a, of two components, like length and ``AGREE`` marks; the first ``heads`` rows are of side 0 and
    meet only those of side 1, all rows meet if there is no side 1."""
    low = heads if heads < len(root) else 1
    across = heads < len(root)
    places = np.ascontiguousarray(marks.T)
    while low < len(root):
        high = min(low + 256, len(root))
        upto = heads if across else high
        fits = (root[low:high, None] != root[None, :upto]) & (np.minimum(n[low:high, None], n[None, :upto]) >= SIMILARITY * np.maximum(n[low:high, None], n[None, :upto]))
        if not across:
            fits &= np.arange(low, high)[:, None] > np.arange(upto)
        if fits.any():
            agree = np.zeros(fits.shape, np.uint8)
            for own in places:
                agree += own[low:high, None] == own[None, :upto]
            a, b = np.nonzero(fits & (agree >= AGREE))
            yield a + low, b
        low = high


def _grouped(batches):
    """Tables of one unit each."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column("unit").to_numpy()
        edges = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
        for start, end in zip(edges, edges[1:], strict=False):
            if held and unit[start] != last:
                yield held[0] if len(held) == 1 else pa.concat_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = unit[start]
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def _marks(rows: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint8).reshape(-1, SKETCHES)


def _shared(keys: np.ndarray, a: np.ndarray, b: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """For each pair: whether its rows agree at one of the first ``upto`` columns."""
    found = np.zeros(len(a), bool)
    for i in range(int(upto.max(initial=0))):
        own = np.flatnonzero((upto > i) & ~found)
        found[own] = keys[a[own], i] == keys[b[own], i]
    return found


def live(rows: DataFrame) -> DataFrame:
    """(unit, side, node, root, marks) of the rows that have a pair to verify in their unit; rows: ``units`` with ``keys`` and ``place``."""
    def run(batches):
        out = []
        for unit in _grouped(batches):
            root, n, place, split = (unit.column(c).to_numpy() for c in ("root", "n", "place", "split"))
            if len(root) < 2 or root.min() == root.max():
                continue
            marks, keys = _marks(unit), None
            wanted = np.zeros(len(root), bool)
            for a, b in alike(root, n, marks, int((unit.column("side").to_numpy() == 0).sum())):
                if not len(a):
                    continue
                keys = unit.column("keys").flatten().to_numpy().reshape(-1, SKETCHES) if keys is None else keys
                ours = ~_shared(keys, a, b, place[a])
                if split[0] >= 0:
                    ours &= ~_shared(marks, a, b, split[a])
                wanted[a[ours]] = wanted[b[ours]] = True
            if wanted.any():
                out.append(unit.select(["unit", "side", "node", "root", "marks"]).filter(pa.array(wanted)))
            if len(out) >= 512 or sum(x.num_rows for x in out[-1:]) >= MOST:
                yield pa.concat_batches(out)
                out = []
        if out:
            yield pa.concat_batches(out)

    ordered = rows.repartition("unit").sortWithinPartitions("unit", "side").select("unit", "side", "node", "root", "n", "marks", "keys", "place", "split")
    return ordered.mapInArrow(run, "unit bigint, side int, node bigint, root bigint, marks binary")


def _spanning(parts: list[np.ndarray], root: np.ndarray, marks: np.ndarray, heads: int) -> list[tuple[int, int]]:
    """Pairs of rows that align, no more than join their components."""
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    names, flat = np.unique(np.concatenate(parts), return_inverse=True)
    seen, comp, out = np.zeros(len(names), bool), root.copy(), []
    for rows, heads_of in alike(root, np.diff(first), marks, heads):
        for a in np.unique(rows):
            others = heads_of[rows == a]
            others = others[comp[others] != comp[a]]
            if not len(others):
                continue
            seen[flat[first[a] : first[a + 1]]] = True
            for low in range(0, len(others), 512):
                some = others[low : low + 512]
                sizes = first[some + 1] - first[some]
                ends = np.cumsum(sizes)
                at = np.arange(ends[-1]) + np.repeat(first[some] - ends + sizes, sizes)
                common = np.add.reduceat(seen[flat[at]].astype(np.int64), ends - sizes)
                for b in some[common >= SIMILARITY * np.maximum(sizes, len(parts[a]))]:
                    if comp[a] != comp[b] and aligned(parts[a], parts[b]) >= SIMILARITY:
                        out.append((int(a), int(b)))
                        comp[comp == comp[a]] = comp[b]
            seen[flat[first[a] : first[a + 1]]] = False
    return out


def spanning(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, head, root, head_root): links between components, verified inside the units; rows: ``live``."""
    def run(batches):
        for unit in _grouped(batches):
            root, node = unit.column("root").to_numpy(), unit.column("node").to_numpy()
            parts = [shingles(np.frombuffer(w, np.uint32)) for w in unit.column("words").to_pylist()]
            found = _spanning(parts, root, _marks(unit), int((unit.column("side").to_numpy() == 0).sum()))
            if found:
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (node[a], node[b], root[a], root[b])], PAIR)

    ordered = rows.join(texts, "node").repartition("unit").sortWithinPartitions("unit", "side").select("unit", "side", "node", "root", "marks", "words")
    return ordered.mapInArrow(run, ", ".join(f"{c} bigint" for c in PAIR))


PAIR = ["node", "head", "root", "head_root"]


def words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, words) of the documents that stand for the wanted nodes: (doc_id, text_key, node)."""
    def run(batches):
        for batch in chunks(batches):
            words = Words(raw_texts(batch))
            own = [words.hash[words.first[i] : words.first[i + 1]].astype(np.uint32).tobytes() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(own, pa.binary())], ["node", "words"])

    source = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("key"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    once = F.row_number().over(Window.partitionBy("id", "key").orderBy("key"))
    return source.join(wanted, same).withColumn("copy", once).filter("copy = 1").select("node", "text").mapInArrow(run, "node bigint, words binary")


def _stored(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    at = scratch_path(spark, name)
    frame.write.parquet(at)
    return spark.read.parquet(at)


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node with the least node of its component; links: (node, head)."""
    edges = _stored(links.select(F.greatest("node", "head").alias("u"), F.least("node", "head").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
        edges = _stored(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct(), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def links_of(docs: DataFrame, marked: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Stored tables of the verified links (node, head), and (node, root) of the nodes that share buckets: stars, then units between components."""
    nodes = marked.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("row"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("marks").alias("marks"))
    nodes = _stored(nodes, "nodes")
    rows = members(nodes.filter("n > 0").select("node", "n", "keys"))
    shared = rows.select("node").distinct()
    texts = _stored(words_of(docs, nodes.join(shared, "node").select("node", "row.doc_id", "row.text_key")), "texts")
    links = [_stored(verified_stars(stars(rows), texts), "verified")]
    roots = shared.select("node", F.col("node").alias("root"))
    if links[0].isEmpty():
        roots = _stored(roots, "roots")
    else:
        roots = _stored(roots.join(components(links[0]).toDF("node", "top"), "node", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    met = units(rows.drop("hub").join(roots, "node").join(nodes.select("node", "marks"), "node")).join(nodes.select("node", "keys"), "node")
    found = _stored(spanning(live(met), texts), "spanning")
    if found.isEmpty():
        return links, roots
    moved = components(found.select(F.col("root").alias("node"), F.col("head_root").alias("head"))).toDF("root", "top")
    return [*links, found.select("node", "head")], _stored(roots.join(moved, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, text_key (its text's 64-bit hash), class_id, class_size, n_links (verified links of its text),
    kept (one (doc_id, text_key) of each class)."""
    marked = _stored(sketches(docs), "sketches")
    found, roots = links_of(docs, marked)
    links = reduce(DataFrame.unionByName, found)
    degree = links.select("node").union(links.select("head")).groupBy("node").agg(F.count("*").alias("n_links"))
    placed = marked.select("doc_id", "text_key", "node").join(roots, "node", "left").join(degree, "node", "left").select(
        "doc_id", "text_key", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    first = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min(F.struct("doc_id", "text_key")).alias("first"), F.count("*").alias("class_size"))
    return placed.join(first, "root").select(
        "doc_id", "text_key", "class_id", "class_size", "n_links", F.struct("doc_id", "text_key").eqNullSafe(F.col("first")).alias("kept"))


def op3_order_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "class_size", "n_links")
