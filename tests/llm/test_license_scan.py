import random
import re

from merchlens.llm import license_scan as q

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_matching_statistics_equal_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        known = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 5))]
        automaton = q.SuffixAutomaton(known)
        text = [rng.randrange(4) for _ in range(30)]
        for i, (state, length) in enumerate(automaton.stream(text)):
            runs = [text[i + 1 - n : i + 1] for n in range(1, i + 2)]
            assert length == max([len(r) for r in runs if any(r == s[j : j + len(r)] for s in known for j in range(len(s)))], default=0)
            if length:
                assert automaton.ends[state] == {(n, e) for n, s in enumerate(known) for e in range(length, len(s) + 1) if s[e - length : e] == runs[length - 1]}


def brute(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return len(words), sorted((i, label) for phrase, label in q.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())


def test_places_of_phrases(spark):
    rng = random.Random(8)
    pool = ["GNU", "general", "Public", "license", "apache", "MIT", "cc", "by", "the", "é", "x-y", "BY"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    got = q.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        assert (r.n_words, [(b.start, b.label) for b in r.base]) == brute(texts[r.doc_id])


def test_template_spans(spark):
    notice = next(t for label, t in q.TEMPLATES if label == "bsd-3")
    cut = notice.split()
    rows = [(1, f"Before. {notice} After."), (2, " ".join(cut[:6])), (3, " ".join([*cut[:12], "inserted words here", *cut[12:]])), (4, "nor the names of dogs")]
    got = {r.doc_id: r.spans for r in q.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.start, s.label, s.covered) for s in got[1]] == [(1, "bsd-3", 1.0)]
    assert got[2] == [] and got[4] == []
    assert [(s.label, s.end - s.start) for s in got[3]] == [("bsd-3", len(WORDS.findall(notice)) + 3)]


def test_odd_rows(odd, none):
    got = q.scan_licences(odd).collect()
    assert len(got) == odd.count() and sum(r.n_words for r in got if r.doc_id in (1, 2, 5, 7, 8)) == 0
    assert q.scan_licences(none).count() == 0
