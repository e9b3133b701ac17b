"""Spelling variants against brute force."""

import random
import re
import zlib

import numpy as np
import pytest

from merchlens.llm import spelling as S


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def expected(counts):
    near = {w: sorted(v for v in counts if one_edit(w, v)) for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts)


def words_of(seed, n=400):
    r = random.Random(seed)
    base = ["".join(r.choice("abcé") for _ in range(r.randint(6, 11))) for _ in range(n // 4)]
    out = set(base)
    while len(out) < n:
        w = list(r.choice(base))
        for _ in range(r.randint(1, 2)):
            at = r.randrange(len(w) + 1)
            kind = r.randrange(3)
            w[at:at + (kind > 0)] = [] if kind == 1 else [r.choice("abcéÿ")]
        if len(w) >= 6:
            out.add("".join(w))
    return {w: 5 ** r.randint(1, 6) + r.randint(0, 3) for w in out}


def test_sorted_lists_find_all_pairs():
    for seed in range(8):
        words = sorted(words_of(seed, 120))
        a, b = S.SortedLists(words, np.zeros(len(words), int), np.zeros(len(words), int)).near()
        assert sorted(zip(a.tolist(), b.tolist())) == [(i, j) for i, u in enumerate(words) for j, v in enumerate(words) if one_edit(u, v)]


@pytest.mark.parametrize("most", [S.MOST, 3])
def test_groups_equal_brute_force_with_whole_and_cut_lists(spark, most):
    counts = words_of(99)
    rows = S.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long"), most=most).collect()
    assert sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows) == expected(counts)
    assert sum(r.form is not None and r.root != r.form for r in rows) > 5


def test_vocabulary_with_dropped_letters(spark, odd, none):
    r = random.Random(3)
    rows = [(i if i % 7 else None, " ".join(r.choice(["Éclairs", "straße!", "tomorrow", "Tomorow", "a-b", "morgen×÷", "ABCDEF", "éclair"]) for _ in range(90))) for i in range(80)]
    rows += [(5, None), (6, ""), (7, "tomorrow " * 30000)]
    counts = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 3 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] = counts.get(run, 0) + 1
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as run", "4 as h")
    got = {x.word: x.n for x in S.vocabulary(df, drop_every=3).collect()}
    assert got == {w: n for w, n in counts.items() if n >= 5} and len(got) > 5
    assert S.spelling_groups(S.vocabulary(none)).count() == 0
    assert [tuple(x) for x in S.spelling_groups(S.vocabulary(odd, min_count=1)).filter("word = 'brown'").collect()] == []
    long = {"x" * 3000: 5, "x" * 3001: 25, "y" * 6: 7}
    got = S.spelling_groups(spark.createDataFrame(list(long.items()), "word string, n long")).collect()
    assert sorted((x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in got) == expected(long)


def test_query_equals_brute_force(spark):
    import pyarrow.parquet as pq

    from tests.conftest import SF_SMALL

    counts = {}
    for d in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d["text"] or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{d['doc_id']}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] = counts.get(run, 0) + 1
    rows = S.op11_spelling(spark, SF_SMALL).collect()
    assert sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows) == expected({w: n for w, n in counts.items() if n >= 5})
