"""Phrase collocations against brute force, and the filters against plain counts."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from merchlens.llm import collocations as C


def expected(rows, least, longest=5, top=2000):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    cand = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= least}
    out = []
    for (lang, p), a in cand.items():
        if any(la == lang and len(q) > len(p) and n >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (la, q), n in cand.items()):
            continue
        score, _, l, r = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, l, r, total[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    ranked, at = [], Counter()
    for lang, *rest in out:
        at[lang] += 1
        if at[lang] <= top:
            ranked.append((lang, at[lang], *rest))
    return ranked


def corpus(seed=1, n=300):
    r = random.Random(seed)
    words = ["of", "The", "new", "YORK", "city", "état", "d'or", "x" * 300, "ss", "ß", "a b", "日本"]
    text = lambda: "".join(r.choice([w + " ", w + "\t", w + ". ", w + "\n", "new york city ", "New  York "]) for w in r.choices(words, k=r.randint(0, 60)))
    return [(r.choice(["en", "en", "en", "fr", None]), text()) for _ in range(n)] + [("en", None), (None, ""), ("fr", "new york " * 20000), ("de", "one two")]


def got(df):
    return sorted((x.lang, x.rank, x.phrase, x.a, x.l, x.r, x.n, x.score) for x in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la) for i, (la, t) in enumerate(rows)], "doc_id long, text string, lang string").selectExpr("*", "1 as gram", "2 as n", "'q' as word", "3 as f")


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    want = sorted(expected(rows, 20))
    assert len({len(x[2].split(" ")) for x in want}) > 2 and len({x[0] for x in want}) == 3
    assert got(C.collocations(frame(spark, rows).repartition(3), 20)) == want
    monkeypatch.setattr(C, "RANGE", 64)  # many quotient ranges
    monkeypatch.setattr(C, "LIST", 4)
    monkeypatch.setattr(C, "SHARD", 3000)
    assert got(C.collocations(frame(spark, rows).repartition(7), 20, top=5)) == sorted(expected(rows, 20, top=5))


def test_empty_and_rare(spark):
    assert got(C.collocations(frame(spark, [("en", "a b")]).filter("false"))) == []
    assert got(C.collocations(frame(spark, [("en", "a b"), (None, None)]))) == []


@pytest.mark.parametrize("order", [2, 3, 4, 5])
@pytest.mark.parametrize("bits", [1, 7, 17, 32])
def test_filters_lose_nothing(order, bits):
    r = np.random.default_rng(order * 100 + bits)
    widths, top = C.limbs(order, bits), min(2, 2 * bits)
    grams = [r.integers(0, 1 << bits, 3000, dtype=np.uint64) for _ in range(order)]
    parts = [grams[i] << np.uint64(bits) | grams[i + 1] if i + 1 < order else grams[i] for i in range(0, order, 2)]
    assert all((a == b).all() for a, b in zip(C.restore(C.permute(parts, widths), widths), parts, strict=True))
    counts = r.choice(np.array([1, 2, 254, 255, 256, 1 << 40], np.uint64), 3000)
    want = Counter()
    for *key, c in zip(*[p.tolist() for p in C.permute(parts, widths)], counts.tolist(), strict=True):
        want[tuple(key)] += c
    p, c = C._added(C.permute(parts, widths), counts)
    piece = p[0] >> np.uint64(widths[0] - top)
    have = {}
    for i in range(1 << top):
        own = np.flatnonzero(piece == i)
        q, d = C.Filter.unpack(C.Filter.pack([x[own] for x in p], c[own], widths, top), widths, top, i)
        have |= {tuple(k): n for *k, n in zip(*[x.tolist() for x in q], d.tolist(), strict=True)}
    assert have == want


def test_permuted_values_are_even():
    """Small numbers, as frequent words have, fill all quotient ranges alike."""
    a, b = np.meshgrid(np.arange(1, 400, dtype=np.uint64), np.arange(1, 400, dtype=np.uint64))
    x = C.permute([(a << np.uint64(17) | b).ravel()], [34])[0]
    n = np.bincount((x >> np.uint64(30)).astype(int), minlength=16)
    assert n.min() > 0.5 * n.mean() and n.max() < 1.5 * n.mean()


def test_exact_scores_beyond_64_bits(spark):
    rows = [(10**13, 10**16, 10**13 + 7, 10**13 + 9), (10**15 - 1, 10**17 + 3, 10**15 + 1, 10**15), (100, 10**17, 100, 101), (7, 11, 13, 10**6)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(C.exact_score("a", "n", "l", "r")).collect()
    assert [x[0] for x in got] == [1000 * a * n // (l * r) for a, n, l, r in rows]


def test_sql_says_the_same():
    rows = corpus(4)
    con = duckdb.connect()
    con.register("documents", pa.table({"text": [t for _, t in rows], "lang": [la for la, _ in rows]}))
    assert sorted(con.execute(C.OP13_SQL).fetchall()) == sorted(expected(rows, 100))
