import random
import re

import pytest

from merchlens.llm import decontaminate as q

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - q.WINDOW + 1)) if own else ():
            windows.setdefault(tuple(own[i : i + q.WINDOW]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                ids = windows.get(tuple(own[i : i + size]))
                if ids:
                    hit |= set(range(i, i + size))
                    found |= ids
        out.append((doc, len(own), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [q.MAX_TERMS, 0])
def test_equal_to_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(q.stored_terms, "__defaults__", (most,))  # 0: postings of all terms
    rng = random.Random(most + 2)
    pool = ["a", "b", "the", "É", "x1"]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(i, text(rng.randrange(0, 16))) for i in range(25)] + [(3, "a b"), (None, "the the the x1"), (40, None), (41, "!!")]
    docs = [(i, text(rng.randrange(0, 80))) for i in range(120)] + [(200 + i, f"{text(5)} {t} {text(7)}") for i, t in items[:25]] + [(None, None), (1, "a b"), (1, "a b")]
    got = q.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    said = sorted(((r.doc_id, r.n_words, sum(h.end - h.start for h in r.hits), r["items"]) for r in got), key=str)
    assert said == brute(docs, items)


def test_proximity(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, item), (2, item.replace("five", "five extra")), (3, "ten nine eight seven six five four three two one"), (4, item.replace("five", "5"))]
    got = {r.doc_id: r for r in q.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert [(got[i]["items"], got[i].near) for i in (1, 2, 3, 4)] == [(["9"], ["9"]), ([], ["9"]), ([], []), ([], [])]


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "same text twice in the table")], "item_id long, text string").selectExpr("*", "1 as terms", "2 as doc_id")
    got = q.decontaminate(odd, items).collect()
    assert len(got) == odd.count() and sum(bool(r.hits) for r in got) == 2
    assert q.decontaminate(none, items).count() == 0
    assert all(not r.hits for r in q.decontaminate(odd, items.limit(0)).collect())
