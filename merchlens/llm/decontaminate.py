"""Benchmark decontamination on a distributed positional inverted index.

Index: each task turns a run of documents into one shard of postings, (term, ascending
positions), delta-coded and compressed, and Spark stores the shards as a table in the
shared folder. All postings of a document lie in one shard, so intersecting lists needs no
shuffle and a frequent term is spread over all shards by itself. Where the test terms are
few enough (``MAX_TERMS``, counted first) only their postings are kept, else all.

Search: the windows of the test items are a stored table too; tasks stream it in blocks of
``BLOCK`` rows against each shard, so neither side is broadcast. A window starts from the
list of its rarest term in the shard; the other lists, rarest first, are intersected after
their offsets are taken off: equal places are phrase matches, places at most ``slop`` apart
are proximity matches.

Defined results: null texts have no words; items without words are skipped, a null item id
reads as ''; repeated documents are judged one by one, repeated items count once per id; no
window leaves its document; words are compared by 64-bit hashes; an empty table on either
side gives uncontaminated documents, or none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.words import Words, chunks, files_at, raw_texts
from merchlens.session import scratch_path

WINDOW = 10
SLOP = 2
MAX_TERMS = 2_000_000
BLOCK = 1 << 16
SHARD_BYTES = 4 << 20

SHARD = "doc_ids array<bigint>, text_keys array<bigint>, first array<bigint>, terms binary, counts binary, positions binary"
RESULT = "doc_id bigint, text_key bigint, n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>, near array<string>"
_ARROW_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.string())), ("near", pa.list_(pa.string())),
])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, terms): each distinct window of an item; terms are its words' hashes, 8 bytes each."""
    def cut(batches):
        for batch in chunks(batches):
            words, ids = Words(raw_texts(batch)), batch.column("item_id").to_pylist()
            rows: dict[tuple[str, bytes], None] = {}
            for i, item in enumerate(ids):
                own = words.hash[words.first[i] : words.first[i + 1]]
                for at in range(max(1, len(own) - window + 1)) if len(own) else ():
                    rows["" if item is None else item, own[at : at + window].tobytes()] = None
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["item_id", "terms"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.mapInArrow(cut, "item_id string, terms binary").distinct()


def _stored_rows(uri: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    fs, path = files_at(uri)
    import pyarrow.fs as pafs

    for info in sorted(fs.get_file_info(pafs.FileSelector(path)), key=lambda x: x.path):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as file:
                yield from pq.ParquetFile(file).iter_batches(BLOCK, columns=columns)


def stored_terms(windows_at: str, spark, most: int = MAX_TERMS) -> str | None:
    """Where the distinct test terms are stored, or None where they are too many to hold in each task."""
    def split(batches):
        for batch in batches:
            terms = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(terms)], ["term"])

    at = scratch_path(spark, "test-terms")
    spark.read.parquet(windows_at).select("terms").mapInArrow(split, "term bigint").distinct().write.parquet(at)
    return at if spark.read.parquet(at).count() <= most else None


_cache: dict[str, object] = {}


def _wanted(uri: str) -> np.ndarray:
    if _cache.get("terms_at") != uri:
        found = [b.column(0).to_numpy() for b in _stored_rows(uri, ["term"])]
        _cache.update(terms_at=uri, terms=np.sort(np.concatenate(found or [np.zeros(0, np.int64)]).view(np.uint64)))
    return _cache["terms"]


def build_index(docs: DataFrame, terms_at: str | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard. ``first[i]``: words before document i; the last entry is the number of words."""
    def shard(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches, most=shard_bytes):
            words = Words(raw_texts(batch))
            if terms_at is None:
                terms, term = np.unique(words.hash, return_inverse=True)
                at = np.arange(len(term), dtype=np.uint32)
            else:
                wanted = _wanted(terms_at)
                term = np.searchsorted(wanted, words.hash)
                known = np.append(wanted, np.uint64(0))[term] == words.hash
                known &= term < len(wanted)
                at, term, terms = np.flatnonzero(known).astype(np.uint32), term[known], wanted
            order = np.argsort(term.astype(np.uint16 if len(terms) < 1 << 16 else np.uint32), kind="stable")
            counts = np.bincount(term, minlength=len(terms)).astype(np.uint32)
            at = at[order]
            yield pa.RecordBatch.from_arrays([
                *(pa.array([batch.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("doc_id", "text_key")), pa.array([words.first], pa.list_(pa.int64())),
                pa.array([terms[counts > 0].tobytes()]), pa.array([counts[counts > 0].tobytes()]),
                pa.array([pack.compress(np.diff(at, prepend=np.uint32(0)).tobytes())]),
            ], ["doc_ids", "text_keys", "first", "terms", "counts", "positions"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(shard, SHARD)


class Shard:
    """Postings of a run of documents."""

    def __init__(self, first, terms: bytes, counts: bytes, positions: bytes):
        self.first = np.asarray(first, np.int64)
        self.terms, self.counts = np.frombuffer(terms, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)
        raw = zstandard.ZstdDecompressor().decompress(positions) if int(self.counts.sum()) else b""
        self.at = np.cumsum(np.frombuffer(raw, np.uint32), dtype=np.uint32).astype(np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.counts)])

    def find(self, windows: np.ndarray, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each row of ``windows`` with matches: its number, the starts of phrase matches, those of proximity matches."""
        if not len(self.terms):
            return
        place = np.minimum(np.searchsorted(self.terms, windows), len(self.terms) - 1)
        for w in np.flatnonzero((self.terms[place] == windows).all(axis=1)):
            lists = place[w]
            order = np.argsort(self.counts[lists], kind="stable")
            starts = exact = None
            for offset in order:
                own = self.at[self.begin[lists[offset]] : self.begin[lists[offset] + 1]]
                if starts is None:
                    starts = own - offset
                    exact = np.ones(len(starts), bool)
                    continue
                here = starts + offset
                if slop:
                    i = np.searchsorted(own, here - slop)
                    near = np.append(own, np.iinfo(np.int64).max)[i] <= here + slop
                    starts, exact, here = starts[near], exact[near], here[near]
                i = np.searchsorted(own, here)
                same = np.append(own, -1)[i] == here
                if slop:
                    exact &= same
                else:
                    starts, exact = starts[same], exact[same]
                if not len(starts):
                    break
            if len(starts):
                doc = np.searchsorted(self.first, starts, "right") - 1
                whole = (starts >= 0) & (starts + windows.shape[1] <= self.first[np.clip(doc + 1, 0, len(self.first) - 1)])
                if whole.any():
                    yield int(w), starts[whole & exact], starts[whole]

    def doc_of(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, starts, "right") - 1


def _blocks(windows_at: str) -> Iterator[tuple[np.ndarray, list[list[str]]]]:
    """Windows of equal length as a matrix, with the ids of the items that hold them."""
    for batch in _stored_rows(windows_at, ["item_id", "terms"]):
        by_size: dict[int, dict[bytes, list[str]]] = {}
        for item, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_size.setdefault(len(terms) // 8, {}).setdefault(terms, []).append(item)
        for size, found in by_size.items():
            yield np.frombuffer(b"".join(found), np.uint64).reshape(-1, size), list(found.values())


def _all_blocks(windows_at: str) -> Iterator[tuple[np.ndarray, list[list[str]]]]:
    """The blocks; a set of one file batch stays in the task's memory, a larger one is streamed again for each shard."""
    if _cache.get("windows_at") != windows_at:
        kept: list | None = []
        rows = 0
        for block in _blocks(windows_at):
            rows += len(block[1])
            kept = kept if rows <= BLOCK else None
            if kept is None:
                break
            kept.append(block)
        _cache.update(windows_at=windows_at, windows=kept)
    yield from _blocks(windows_at) if _cache["windows"] is None else _cache["windows"]


def search(index: DataFrame, windows_at: str, slop: int = SLOP) -> DataFrame:
    """A row per document: its text's 64-bit hash, its words, merged runs of hit words, items with phrase matches, items with proximity matches."""
    def look(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["first"], row["terms"], row["counts"], row["positions"])
                n = len(row["doc_ids"])
                items: dict[int, set[str]] = {}
                near: dict[int, set[str]] = {}
                spans: list[np.ndarray] = []
                for windows, ids in _all_blocks(windows_at):
                    for w, exact, close in shard.find(windows, slop):
                        for into, starts in ((items, exact), (near, close)):
                            for doc in np.unique(shard.doc_of(starts)).tolist():
                                into.setdefault(doc, set()).update(ids[w])
                        if len(exact):
                            spans.append(np.stack([exact, exact + windows.shape[1]]))
                hits: dict[int, list[dict]] = {}
                if spans:
                    start, end = np.concatenate(spans, axis=1)
                    order = np.argsort(start, kind="stable")
                    start, end = start[order], np.maximum.accumulate(end[order])
                    doc = shard.doc_of(start)
                    new = np.flatnonzero(np.concatenate([[True], (start[1:] > end[:-1]) | (doc[1:] != doc[:-1])]))
                    last = np.concatenate([new[1:], [len(start)]]) - 1
                    for d, s, e in zip(doc[new].tolist(), start[new].tolist(), end[last].tolist(), strict=True):
                        hits.setdefault(d, []).append({"start": s - row["first"][d], "end": e - row["first"][d]})
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["text_keys"], pa.int64()), pa.array(np.diff(shard.first)), pa.array([hits.get(i, []) for i in range(n)], _ARROW_RESULT.field("hits").type),
                    pa.array([sorted(items.get(i, ())) for i in range(n)], pa.list_(pa.string())), pa.array([sorted(near.get(i, ())) for i in range(n)], pa.list_(pa.string())),
                ], schema=_ARROW_RESULT)

    return index.mapInArrow(look, RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP) -> DataFrame:
    """Stores the windows and the index in the shared folder, then searches: one row per document."""
    spark = docs.sparkSession
    windows_at, index_at = scratch_path(spark, "test-windows"), scratch_path(spark, "postings")
    item_windows(benchmark).write.parquet(windows_at)
    build_index(docs, stored_terms(windows_at, spark)).write.parquet(index_at)
    return search(spark.read.parquet(index_at), windows_at, slop)


def hit_words(hits):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", hit_words(F.col("hits")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5_SQL = f"""
with items as (
  select coalesce(item_id::varchar, '') as item, {_WORDS} as ws from benchmark
), wins as (
  select distinct item, least(len(ws), {WINDOW}) as k, array_to_string(ws[i : i + least(len(ws), {WINDOW}) - 1], ' ') as g
  from (select item, ws, unnest(range(1, greatest(len(ws) - {WINDOW} + 2, 2))) as i from items where len(ws) > 0)
), docs as (
  select row_number() over () as r, doc_id, {_WORDS} as ws from documents
), places as (
  select r, k, i, array_to_string(ws[i : i + k - 1], ' ') as g
  from (select r, ws, k, unnest(range(1, len(ws) - k + 2)) as i from docs, (select distinct k from wins) where len(ws) >= k)
), found as (
  select r, i, k, item from places join wins using (k, g)
), hit as (
  select r, count(distinct i + o) as n_hit from (select distinct r, i, unnest(range(0, k)) as o from found) group by r
), who as (
  select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as names from found group by r
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (r) left join who using (r)
"""
