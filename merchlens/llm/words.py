"""Words of whole batches as numpy arrays, and the stored files of tasks.

Texts of a batch are laid end to end as UTF-8 bytes and cut into words at once. A word is
known by a 64-bit polynomial hash of its bytes (random byte values, odd base, final mix),
so two of 10^9 different words share a hash with a chance of about 3 in 100.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs

SEGMENT = 1 << 20
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * np.uint64(0x9E3779B97F4A7C15))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_tables: dict[str, np.ndarray] = {}


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        _tables["up"], _tables["down"] = _powers(_BASE, SEGMENT + 1), _powers(_INVERSE, SEGMENT + 1)
    return _tables["up"], _tables["down"]


def _lower_values(count: int, salt: int) -> np.ndarray:
    values = seeds(count, salt)
    values[65:91] = values[97:123]
    return values


#: Value of each byte, A-Z as a-z, and of each code point's two halves for code-point texts.
BYTE_VALUES = _lower_values(256, 7)
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased.
WORD_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def segment_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the pieces [start, end) of a sequence of 64-bit values; a piece of any length."""
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    up, down = _power_tables()
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        if ends[first] - base > SEGMENT:  # one piece longer than a segment: fold it up
            total, scale = 0, 1
            for at in range(int(base), int(ends[first]), SEGMENT):
                part = values[at : min(at + SEGMENT, int(ends[first]))]
                total = (total + scale * int(np.sum(part * up[: len(part)], dtype=np.uint64))) % (1 << 64)
                scale = scale * int(up[SEGMENT]) % (1 << 64)
            out[first] = total
            first += 1
            continue
        part = values[base : ends[last - 1]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[e] - sums[s]) * down[s]
        first = last
    return mix(out)


class Words:
    """Words of several texts: ``doc`` (index of the text), ``start``/``end`` (bytes of ``data``) and ``hash`` of each
    word; ``first[i]`` is the number of words before text i, with one more entry at the end."""

    def __init__(self, texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        self.data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside = np.concatenate([[False], WORD_BYTES[self.data], [False]])
        flips = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = flips[::2], flips[1::2]
        self.hash = segment_hashes(BYTE_VALUES[self.data], self.start, self.end)
        self.first = np.searchsorted(self.start, self.offset)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))


def word_hashes(text: str) -> np.ndarray:
    return Words([text.encode()]).hash


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of ``column`` each, a row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0), np.int64))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
            yield batch.slice(at, to - at)
            at, done = to, sizes[to - 1]


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def files_at(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, reached from a task."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:/") else f"file://{os.path.abspath(uri)}")


def write_once(uri: str, name: str, parts: Iterator[bytes]) -> str:
    """Writes a file of its own for this attempt; the caller's manifest names the attempt that counts, so that a task that
    runs again neither finds nor spoils an earlier file."""
    fs, path = files_at(uri)
    fs.create_dir(path, recursive=True)
    own = f"{name}-{uuid.uuid4().hex[:12]}"
    with fs.open_output_stream(f"{path}/{own}") as out:
        for part in parts:
            out.write(part)
    return own
