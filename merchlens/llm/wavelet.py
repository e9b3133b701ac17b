"""Token ids in wavelet-matrix files: one succinct, compressed file per shard.

A file holds the ids of a run of documents as bit-planes, highest bit first; after each plane the
ids are put in order of its bit, zeros first, order otherwise kept. Each plane is cut into blocks of
``BLOCK_BITS``, every block compressed by itself with the number of ones before it beside it, so
that access, rank (count) and select (occurrences) read only the blocks they touch. Documents'
ids and lengths stand beside the planes.

File: 8 bytes magic, the planes' blocks, then a compressed tail (document ids, lengths, zeros per plane,
block ends, ones before blocks), and the tail's size and the numbers that give its layout as 8-byte integers.

Writing: rows are range-partitioned by doc_id, so that files in order of (partition, number) hold documents in
ascending order; each task streams its rows and closes a file after ``SHARD_TOKENS`` ids. A manifest
names the files that count, so a task that runs again leaves no trace in the result.

Defined results: null texts are empty and hold only the end id; null doc_ids come first; equal ids are ordered by
their texts; repeated rows are all stored; an empty table gives no files and no rows.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.piece_encoder import PieceEncoder
from merchlens.llm.pretokens import all_spelled
from merchlens.llm.words import chunks, files_at, write_once
from merchlens.session import scratch_path

MAGIC = b"WAVELET1"
BLOCK_BITS = 1 << 16
BLOCK_BYTES = BLOCK_BITS // 8
SHARD_TOKENS = 4_000_000
END_ID = 0
NULL_ID = -(1 << 63)
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def divided(values: np.ndarray, plane: np.ndarray, zeros: int) -> np.ndarray:
    """Values whose bit is 0, then those whose bit is 1; block by block, so that places stay in the cache."""
    out, low, high = np.empty_like(values), 0, zeros
    for first in range(0, len(values), BLOCK_BITS):
        own, bit = values[first : first + BLOCK_BITS], plane[first : first + BLOCK_BITS]
        a, b = np.flatnonzero(~bit), np.flatnonzero(bit)
        out[low : low + len(a)], out[high : high + len(b)] = own.take(a), own.take(b)
        low, high = low + len(a), high + len(b)
    return out


def joined(values: np.ndarray, plane: np.ndarray, zeros: int) -> np.ndarray:
    """Undoes ``divided``."""
    out, low, high = np.empty_like(values), 0, zeros
    for first in range(0, len(values), BLOCK_BITS):
        own, bit = out[first : first + BLOCK_BITS], plane[first : first + BLOCK_BITS]
        a, b = np.flatnonzero(~bit), np.flatnonzero(bit)
        own[a], own[b] = values[low : low + len(a)], values[high : high + len(b)]
        low, high = low + len(a), high + len(b)
    return out


def pack(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray):
    """The bytes of a file, part by part."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    squeeze = zstandard.ZstdCompressor(level=1)
    zeros, ends, ones, at = [], [], [], len(MAGIC)
    yield MAGIC
    for bit in range(bits - 1, -1, -1):
        plane = (now >> now.dtype.type(bit) & now.dtype.type(1)).astype(bool)
        raw = np.packbits(plane)
        before = 0
        for first in range(0, len(raw), BLOCK_BYTES):
            block = raw[first : first + BLOCK_BYTES]
            small = squeeze.compress(block.tobytes())
            at += len(small)
            ends.append(at)
            ones.append(before)
            before += int(np.bitwise_count(block).sum())
            yield small
        zeros.append(len(now) - before)
        if bit:
            now = divided(now, plane, zeros[-1])
    tail = squeeze.compress(b"".join(np.asarray(x, np.int64).tobytes() for x in (doc_ids, lengths, zeros, ends, ones)))
    yield tail
    yield np.array([len(ids), len(doc_ids), bits, len(ends), len(tail)], np.int64).tobytes()


class WaveletFile:
    """Reads a file written from ``pack``: ``read(offset, size)`` gives its bytes, ``size`` is its length."""

    def __init__(self, read, size: int):
        self.read = read
        self.n, docs, self.bits, blocks, tail = np.frombuffer(read(size - 40, 40), np.int64).tolist()
        self.unpack = zstandard.ZstdDecompressor()
        raw = np.frombuffer(self.unpack.decompress(read(size - 40 - tail, tail)), np.int64)
        self.doc_ids, self.lengths, self.zeros, self.ends, self.ones = np.split(raw, np.cumsum([docs, docs, self.bits, blocks]))
        self.begins = np.concatenate([[len(MAGIC)], self.ends[:-1]]) if blocks else self.ends
        self.per_plane = -(-self.n // BLOCK_BITS)
        self._block = lru_cache(maxsize=64)(self._load)

    def _load(self, number: int) -> np.ndarray:
        return np.frombuffer(self.unpack.decompress(self.read(int(self.begins[number]), int(self.ends[number] - self.begins[number]))), np.uint8)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - int(self.zeros[plane])
        number = plane * self.per_plane + i // BLOCK_BITS
        block, inside = self._block(number), i % BLOCK_BITS
        whole = int(self.ones[number]) + int(_ONES[block[: inside // 8]].sum())
        return whole + int(_ONES[block[inside // 8] >> (8 - inside % 8)] if inside % 8 else 0)

    def access(self, i: int) -> int:
        """The id at place i."""
        out = 0
        for plane in range(self.bits):
            block, inside = self._block(plane * self.per_plane + i // BLOCK_BITS), i % BLOCK_BITS
            bit = int(block[inside // 8]) >> (7 - inside % 8) & 1
            out = out << 1 | bit
            ones = self._rank1(plane, i)
            i = int(self.zeros[plane]) + ones if bit else i - ones
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` within [low, high) lie after the last plane."""
        for plane in range(self.bits):
            a, b = self._rank1(plane, low), self._rank1(plane, high)
            low, high = (int(self.zeros[plane]) + a, int(self.zeros[plane]) + b) if token >> (self.bits - 1 - plane) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of ``token`` within [low, high)."""
        if token >> self.bits or not self.n:
            return 0
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def _select(self, plane: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) ``bit`` of a plane."""
        own = slice(plane * self.per_plane, (plane + 1) * self.per_plane)
        ones = self.ones[own]
        before = ones if bit else np.arange(self.per_plane) * BLOCK_BITS - ones
        number = int(np.searchsorted(before, k, "right")) - 1
        set_ = np.unpackbits(self._block(plane * self.per_plane + number))
        return number * BLOCK_BITS + int(np.flatnonzero(set_ == bit)[k - int(before[number])])

    def select(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of ``token``."""
        at = self._range(token, 0, self.n)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._select(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def occurrences(self, token: int):
        for k in range(self.count(token)):
            yield self.select(token, k)

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        out = None
        for plane in range(self.bits - 1, -1, -1):
            raw = [self._load(b) for b in range(plane * self.per_plane, (plane + 1) * self.per_plane)]
            bit = np.unpackbits(np.concatenate(raw or [np.zeros(0, np.uint8)]), count=self.n).astype(bool)
            before = np.zeros(self.n, kind) if out is None else joined(out, bit, int(self.zeros[plane]))
            out = before | bit.astype(kind) << kind(self.bits - 1 - plane)
        return out if out is not None else np.zeros(0, kind)


def open_file(uri: str, name: str) -> WaveletFile:
    fs, path = files_at(uri)
    file = fs.open_input_file(f"{path}/{name}")

    def read(offset: int, size: int) -> bytes:
        file.seek(offset)
        return file.read(size)

    return WaveletFile(read, file.size())


@lru_cache(maxsize=1)
def library_encoder(vocabulary: str) -> PieceEncoder:
    """Byte-level encoder of the tokenizers library, piece by piece."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    model = tokenizer.model
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    return PieceEncoder("byte_level", lambda pieces: [[t.id for t in model.tokenize(p)] for p in all_spelled(pieces)], special)


MANIFEST = "part int, number int, file string, n_docs bigint, n_tokens bigint"


def write_shards(docs: DataFrame, vocabulary: str, uri: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the files and returns their manifest."""
    def run(batches):
        encode, part = library_encoder(vocabulary), TaskContext.get().partitionId()
        ids, keys, sizes, held, number = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            all_ids, all_keys, all_sizes = np.concatenate(ids), np.concatenate(keys), np.concatenate(sizes)
            name = write_once(uri, f"tokens-{part:06d}-{number:06d}.wm", pack(all_ids, all_keys, all_sizes))
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": name, "n_docs": len(all_keys), "n_tokens": len(all_ids)}], schema=pa.schema([
                ("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in chunks(batches, most=4 << 20):
            flat, n = encode([t or "" for t in batch.column("text").to_pylist()])
            ids.append(np.insert(flat, np.cumsum(n), end_id).astype(np.uint32))
            keys.append(batch.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False))
            sizes.append(n + 1)
            held += len(ids[-1])
            if held >= shard_tokens:
                yield close()
                ids, keys, sizes, held, number = [], [], [], 0, number + 1
        if keys:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(run, MANIFEST)


def read_shards(manifest: DataFrame, uri: str) -> DataFrame:
    """A row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = open_file(uri, row["file"])
                ids, ends = shard.tokens().astype("<u4"), np.cumsum(shard.lengths)
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), shard.lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.doc_ids, pa.int64(), mask=shard.doc_ids == NULL_ID), pa.array(row["before"] + ends - shard.lengths),
                    pa.array(shard.lengths), pa.array(sums, pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])

    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("before", before)
    return files.repartition(max(1, manifest.count())).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op9_wavelet(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    uri, at = scratch_path(spark, "wavelet"), scratch_path(spark, "wavelet-manifest")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), uri).write.parquet(at)
    return read_shards(spark.read.parquet(at), uri)
