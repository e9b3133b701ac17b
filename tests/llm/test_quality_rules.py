import random
import re

from merchlens.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)}
    return len(words), sum(map(len, words)), sum(c in q.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    rng = random.Random(6)
    pool = ["a", "b", "the", "é", "#x", "\n", "\n\n", "\t", "und", "😀", "\x0b"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", "\n", ""]) for _ in range(rng.randrange(0, 80))) for _ in range(300)]
    for r in q.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        m = r.quality
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute(texts[r.doc_id])
        assert m.base_failed == (m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words) and not (m.base_failed and m.kept)


def test_each_rule_can_reject(spark):
    good = " ".join(f"the word{i}" for i in range(40))
    bad = {"word_length": " ".join(f"the {'x' * 100}{i}" for i in range(40)), "symbols": good.replace("word", "###"),
           "stop_words": " ".join(f"word{i}" for i in range(60)), "repeated_lines": good + "\nthe\nthe\nthe\nthe\nthe", "line_length": "the\n" * 0 + good}
    kept = {r.name: r.quality.kept for r in q.quality_rules(spark.createDataFrame([("good", good), *bad.items()], "name string, text string")).collect()}
    assert kept == {"good": True, "word_length": False, "symbols": False, "stop_words": False, "repeated_lines": False, "line_length": True}


def test_odd_rows(odd, none):
    got = q.quality_rules(odd).collect()
    assert len(got) == odd.count() and all(r.quality.n_words == len((r.text or "").split()) for r in got)
    assert q.quality_rules(none).count() == 0


def test_plan_has_no_user_function_or_shuffle(odd):
    plan = q.quality_rules(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
