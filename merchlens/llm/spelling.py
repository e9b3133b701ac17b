"""Spelling variants: words of a corpus that are one edit apart, by dynamic programming along sorted lists.

* ``vocabulary``: Spark counts the letter runs of whole texts.
* ``near_words``: two words one edit apart share the first or the last half of their characters, so each word goes to the lists of its halves,
  four in all. In a sorted list every word of the list is a query; the rows of its edit matrix (a band of three cells) are kept per depth and
  reused through the common prefix of neighbours, and once a row exceeds one edit, all words that share that prefix are skipped. All queries
  of a batch take their steps together, as arrays. A pair is reported by one list alone: the first half if that is shared, else the last.
* A list of more than ``MOST`` words is cut without loss: a pair that shares its first h characters either shares the next one too (the lists of h + 1
  characters), or differs there and agrees in all that follows (lists of one word each letter at that place). This repeats until all are small.
* ``spelling_groups``: the form of a word is its near word of largest count, where that is ``RATIO`` times its own; forms are followed to the
  last by doubling steps, whose number the largest count bounds, as counts grow by ``RATIO`` at each.

Defined results: null texts have no words, a null id counts as the empty text in the crc32, repeated rows count again, an empty table gives no rows;
words of any length and any letters are compared by code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.session import scratch_path

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: Words in a list at most, and rows that are scanned together.
MOST, BATCH = 4096, 1 << 16

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYED = "key string, last boolean, exact boolean, h int, m int, w string, n long"


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int | None = None) -> DataFrame:
    """word, n: runs of letters, A-Z lower-cased, of ``min_length`` code points and ``min_count`` occurrences or more. ``drop_every``: if it divides
    h = crc32 of "<doc_id>:<run>", the run's code point h % length goes (planted misspellings)."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"))
    word = F.col("run")
    if drop_every:
        runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
        word = F.when(F.col("h") % drop_every == 0, cut).otherwise(word)
    return runs.select(word.alias("word")).filter(F.length("word") >= min_length) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _lists(words: DataFrame) -> DataFrame:
    """Every word under its first and its last half (``last``: reversed), as the longer word of a pair (m = length) and as the shorter one."""
    sides = words.withColumn("last", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("m", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    w = F.when(F.col("last"), F.reverse("word")).otherwise(F.col("word"))
    return sides.select("last", F.lit(False).alias("exact"), F.floor(F.col("m") / 2).cast("int").alias("h"), "m", w.alias("w"), "n").select(
        F.concat_ws(" ", F.col("last").cast("string"), "m", F.substring(F.col("w"), F.lit(1), F.col("h"))).alias("key"), "*")


def _cut_lists(keyed: DataFrame, most: int) -> DataFrame:
    """Lists of more than ``most`` words by one more character, or by all that follows it."""
    spark = keyed.sparkSession
    done, deeper = [], keyed
    while True:
        at, hot_at = scratch_path(spark, "lists"), scratch_path(spark, "long-lists")
        deeper.write.parquet(at)
        stored = spark.read.parquet(at)
        stored.groupBy("key").count().filter(F.col("count") > most).select("key").write.parquet(hot_at)
        hot = spark.read.parquet(hot_at)
        if hot.isEmpty():
            done.append(stored)
            break
        done.append(stored.join(hot, "key", "left_anti").select(stored.columns))
        rows = stored.join(hot, "key", "left_semi")
        prefix, rest = F.substring(F.col("w"), F.lit(1), F.col("h")), F.col("m") - 1 - F.col("h")
        tail = F.substring(F.col("w"), F.length("w") - rest + 1, rest)
        longer = rows.filter(F.length("w") > F.col("h")).withColumns({"h": F.col("h") + 1, "key": F.concat_ws(
            " ", F.col("last").cast("string"), "m", F.substring(F.col("w"), F.lit(1), F.col("h") + 1))})
        exact = rows.withColumns({"exact": F.lit(True), "key": F.concat_ws(" ", F.col("last").cast("string"), "m", prefix, tail)})
        done.append(exact.select(stored.columns))
        deeper = longer.select(stored.columns)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


class SortedLists:
    """Sorted lists laid end to end, and the scan of each list by each of its words. ``start[i]`` is a depth that a list's words
    share, short of their lengths."""

    def __init__(self, words: list[str], group: np.ndarray, start: np.ndarray):
        n = len(words)
        self.n, self.h = n, start.astype(np.int64)
        self.length = np.fromiter(map(len, words), np.int64, n)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.points = np.concatenate([np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.zeros(2, np.uint32)])
        first = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, bool)
        self.head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        self.lcp = np.full(n, -1, np.int64)  # with the next word of the list; -1 after the last
        live = np.flatnonzero(~first) - 1
        self.lcp[live] = self.h[live]
        while len(live):
            d = self.lcp[live]
            live = live[(d < self.length[live]) & (d < self.length[live + 1]) &
                        (self.points[self.offset[live] + d] == self.points[np.minimum(self.offset[live + 1] + d, len(self.points) - 1)])]
            self.lcp[live] += 1
        self.next_smaller = np.zeros(n, np.int64)
        stack: list[int] = []
        lcp = self.lcp.tolist()
        for i in range(n - 1, -1, -1):
            while stack and lcp[stack[-1]] >= lcp[i]:
                stack.pop()
            self.next_smaller[i] = stack[-1] if stack else n
            stack.append(i)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) of indexes, one edit apart."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        room = self.length - self.h + 3
        base = np.concatenate([[0], np.cumsum(room)])[:-1] - self.h  # row of depth d of query q: base[q] + d
        rows = np.full((int(room.sum()), 3), 9, np.int8)
        rows[base + self.h] = (1, 0, 1)
        rows[base + self.h, 2] = np.where(self.length > self.h, 1, 9)
        q, j, d = np.arange(self.n), self.head.copy(), self.h.copy()
        skip = np.zeros(self.n, bool)  # on the way to the next word whose common prefix is shorter than d
        found_q, found_j = [], []
        while len(q):
            move = skip.copy()
            step = np.flatnonzero(~skip)
            if len(step):
                sq, sj, sd = q[step], j[step], d[step]
                old = rows[base[sq] + sd]
                c, at, end = self.points[self.offset[sj] + sd], self.offset[sq] + sd, self.length[sq]
                new = np.full_like(old, 9)
                new[:, 0] = np.where(sd <= end, np.minimum(old[:, 0] + (self.points[at - 1] != c), old[:, 1] + 1), 9)
                new[:, 1] = np.where(sd + 1 <= end, np.minimum(np.minimum(old[:, 1] + (self.points[at] != c), old[:, 2] + 1), new[:, 0] + 1), 9)
                new[:, 2] = np.where(sd + 2 <= end, np.minimum(old[:, 2] + (self.points[np.minimum(at + 1, len(self.points) - 1)] != c), new[:, 1] + 1), 9)
                sd = sd + 1
                d[step] = sd
                dead = new.min(axis=1) > 1
                alive = ~dead
                rows[base[sq[alive]] + sd[alive]] = new[alive]
                over = alive & (sd == self.length[sj])
                k = end - sd + 1
                hit = np.flatnonzero(over & (k >= 0) & (k <= 2))
                hit = hit[new[hit, k[hit]] == 1]
                found_q.append(sq[hit])
                found_j.append(sj[hit])
                move[step] = dead | over
                skip[step] = dead
                d[step[over]] = np.iinfo(np.int64).max  # the next word, whatever it shares
            at = np.flatnonzero(move)
            to = self.lcp[j[at]]
            far = to >= d[at]
            hop = at[far]
            j[hop] = self.next_smaller[j[hop]]
            skip[hop] = True
            here = at[~far]
            d[here] = to[~far]
            j[here] += 1
            skip[here] = False
            keep = d >= 0
            if not keep.all():
                q, j, d, skip = q[keep], j[keep], d[keep], skip[keep]
        return np.concatenate(found_q), np.concatenate(found_j)


def _scan(rows: pa.Table) -> pa.RecordBatch:
    words = rows.column("w").to_pylist()
    group = np.unique(np.asarray(rows.column("key").to_pylist(), object), return_inverse=True)[1]
    m, h, n = (np.asarray(rows.column(c), np.int64) for c in ("m", "h", "n"))
    last, exact = (np.asarray(rows.column(c)) for c in ("last", "exact"))
    a, b = SortedLists(words, group, np.where(exact, 0, np.maximum(h - 1, 0))).near()
    ok = (np.maximum(np.fromiter(map(len, words), np.int64, len(words))[a], np.fromiter(map(len, words), np.int64, len(words))[b]) == m[a])
    out: tuple[list, list, list] = ([], [], [])
    for i, k in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
        u, v = words[i], words[k]
        if exact[i] and _common(u, v) != h[i]:
            continue
        if last[i]:
            u, v = u[::-1], v[::-1]
            if _common(u, v) >= m[i] // 2:  # the lists of first halves have it
                continue
        for column, value in zip(out, (u, v, int(n[k])), strict=True):
            column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["word", "near", "near_n"])


def _common(u: str, v: str) -> int:
    n = 0
    for x, y in zip(u, v, strict=False):
        if x != y:
            break
        n += 1
    return n


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, w); whole lists are scanned together, some ``BATCH`` rows at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < BATCH:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column("key").to_pylist()
        cut = len(keys)
        while cut and keys[cut - 1] == keys[-1]:
            cut -= 1
        if cut:
            yield _scan(table.slice(0, cut))
            held = table.slice(cut).to_batches()
    if held:
        yield _scan(pa.Table.from_batches(held))


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, near, near_n: all ordered pairs of words (word, n) that differ by one inserted, deleted or replaced code point."""
    lists = _cut_lists(_lists(words), most)
    alone = lists.repartition("key").sortWithinPartitions("key", "w")
    return alone.mapInArrow(_scan_batches, "word string, near string, near_n long")


def spelling_groups(words: DataFrame, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words`` (word, n)."""
    spark = words.sparkSession
    vocabulary_at, formed_at = scratch_path(spark, "vocabulary"), scratch_path(spark, "forms")
    words.write.parquet(vocabulary_at)
    words = spark.read.parquet(vocabulary_at)
    best = near_words(words, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    far = -F.col("best.minus") >= F.col("n") * ratio
    words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best.near")).alias("form"),
        F.when(far, -F.col("best.minus")).alias("form_n")).write.parquet(formed_at)
    formed = spark.read.parquet(formed_at)
    most_n = formed.agg(F.max("n")).first()[0] or 1
    steps = 1 + int(log(most_n, ratio))  # forms that can follow one another
    roots = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    reach = 1
    while True:
        at = scratch_path(spark, "roots")
        roots.write.parquet(at)
        roots = spark.read.parquet(at)
        if reach >= steps:
            break
        on = roots.toDF("root", "further")
        roots = roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        reach *= 2
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet"), drop_every=199))
