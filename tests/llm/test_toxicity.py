import itertools
import math
import random

import numpy as np
import pytest

from merchlens.llm import toxicity as q
from tests.conftest import SF_MID


@pytest.fixture(scope="module")
def model():
    words = "the idiot moron clown stupid is a worthless thing and that pathetic loser".split()
    counts = {}
    for w in words * 20:
        s = [q.MARK] * 3 + [ord(c) - 97 for c in w] + [q.MARK]
        for i in range(len(s) - 3):
            code = 0
            for x in s[i : i + 4]:
                code = code * q.BASE + x
            counts[code] = counts.get(code, 0) + 1
    return q.LetterModel(np.array(list(counts)), np.array(list(counts.values())))


@pytest.mark.parametrize("said, meant, spaced", [
    ("1d10t", "idiot", False), ("idiiiiot", "idiot", False), ("i d i o t", "idiot", True), ("$tup1d!!!", "stupid", False), ("m.o.r.o.n", "moron", True),
    ("path3t1c", "pathetic", False), ("and$$$", "and", False), ("", "", False), ("%%%", "", False)])
def test_restored(model, said, meant, spaced):
    assert " ".join(q.Restorer(model)(said, spaced)) == meant


def test_viterbi_is_the_best_path(model):
    rng = random.Random(4)
    for _ in range(60):
        steps = q.lattice("".join(rng.choice("1d0oit3s5 ") for _ in range(rng.randrange(1, 7))), rng.random() < 0.5)
        best = None
        for path in itertools.product(*steps):
            score, context, out = 0.0, (q.MARK,) * 3, ""
            for letter, cost in (*path, (q.MARK, 0.0)):
                score -= cost
                if letter is None or letter == q.MARK == context[2]:
                    continue
                code = 0
                for x in (*context, letter):
                    code = code * q.BASE + x
                score += model.log[code]
                context, out = (*context[1:], letter), out + (chr(97 + letter) if letter < q.MARK else " ")
            best = max(best or (score, out.strip()), (score, out.strip()))
        assert model.decode(steps) == best[1]


def test_openings_are_reached_by_any_path():
    """The trie walk says yes if and only if one of all readings holds a word that begins like a wanted one."""
    rng, seen = random.Random(8), set()
    wanted = ["idio", "too", "so", "stud", "ooze"]
    trie = q.Openings(w + "rest" if len(w) == 4 else w for w in wanted)
    for _ in range(400):
        token, spaced = "".join(rng.choice("1d0oits5 zeu3-") for _ in range(rng.randrange(1, 8))), rng.random() < 0.5
        steps = q.lattice(token, spaced)
        readings = {"".join("" if x is None else chr(97 + x) if x < q.MARK else " " for x, _ in path) for path in itertools.product(*steps)}
        want = any(word.startswith(w) for r in readings for word in r.split() for w in wanted)
        assert trie.reached(steps) == want, (token, spaced)
        seen.add(want)
    assert seen == {True, False}


def test_two_runs_learn_the_same(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    a, b = q.learn(docs, labels), q.learn(docs.repartition(7), labels.repartition(3))
    assert a.weights == b.weights and a.bias == b.bias and len(a.weights) > 5


def test_letter_counts(spark):
    texts = ["Ab, ábc", None, "", "a  b"]
    grams = {}
    for words in (["ab", "abc"], [], [], ["a", "b"]):
        s = [q.MARK] * 3 + [x for w in words for x in [*(ord(c) - 97 for c in w), q.MARK]]
        s += [q.MARK] * (2 if words else 3)
        for i in range(len(s) - 3):
            code = 0
            for x in s[i : i + 4]:
                code = code * q.BASE + x
            grams[code] = grams.get(code, 0) + 1
    for parts in (1, 4):
        df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
        assert {r.gram: r.n for r in q.letter_counts(df).collect()} == grams


def test_doubtful_stretches():
    found = q.Letters(["an 1d10t and ann", "so i.d.i.o.t is", "nooo", "a b", "100 x2"]).doubtful()
    assert ("1d10t" in [t.strip() for _, t, _ in found]) and (1, "i.d.i.o.t", True) in found and any(t.strip() == "nooo" for _, t, _ in found)
    assert not any(d == 3 for d, _, _ in found)


def test_logistic_separates():
    rows, y = [[0], [0, 1], [1], [2], []] * 20, np.array([1, 1, 0, 0, 0] * 20, float)
    weight, bias = q.logistic(rows, y, 3)
    p = [1 / (1 + math.exp(-(bias + sum(weight[c] for c in r)))) for r in rows[:5]]
    assert [x >= 0.5 for x in p] == [True, True, False, False, False]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    scored = q.score(docs, q.learn(docs, labels)).join(labels, "doc_id").withColumn("held_out", q._held_out(q.F.col("doc_id"))).filter("held_out").collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in scored)
    assert right >= 0.9 * len(scored)


def test_odd_rows_and_labels(spark, odd, none):
    labels = spark.createDataFrame([(None, None, 1), (3, None, None), (4, 1, 1), (4, 1, 0), (4, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    for docs, known in ((odd, labels), (odd, labels.limit(0)), (odd, labels.filter("toxic = 1")), (none, labels)):
        got = q.score(docs, q.learn(docs.select("doc_id", "text"), known)).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        assert all(r.score < 0.5 for r in got if not (r.text or "").strip())


def test_spellings_reach_the_score(spark, tmp_path):
    at = str(tmp_path / "counts")
    known = "the idiot moron clown stupid is a worthless thing and that pathetic loser so kill them shit".split()
    q.letter_counts(spark.createDataFrame([(" ".join(known),)] * 50, "text string")).write.parquet(at)
    learned = q.Model({f"{w}$": (9.0, 0.9) for w in ("idiot", "moron", "loser", "kill", "shit")}, -4.0, at)
    said = ["idi07", "sh17", "kil1", "k-1-l-l", "i d 1 0 t", "i  d  i  o  t", "i - d - i - o - t", "shiit", "idiiot", "%" * 251 + "1d10t" + "%" * 250 + "so"]
    rows = [(f"so {x} is",) for x in [*said, "that clown", "a b"]]
    got = {r.text: r.score >= 0.5 for r in q.score(spark.createDataFrame(rows, "text string"), learned).collect()}
    assert [got[f"so {x} is"] for x in said] == [True] * len(said) and not got["so that clown is"] and not got["so a b is"]
