import math
import random
import re

from merchlens.llm import secrets as q

ASSIGN = re.compile(q.ASSIGN.replace("(?i:", "(?:"), re.I | re.A)


def brute_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


NO_SECRETS = [
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "(?i)example|sample|placeholder|changeme|dummy|xxxx|redacted",
    "(?i)0123456789|abcdefghij|qwertyuiop",
    "^/?[A-Za-z_-]+[0-9]{0,4}(/[A-Za-z_-]*[0-9]{0,4})+$",
    "^[A-Za-z]+([-_][A-Za-z]+)*[-_]?[0-9]{1,4}$",
]


def brute_entropy(text):
    out, taken = [], {i for a, _, b in brute_base(text) for i in range(a, b)}
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text):
        free = "".join(" " if i in taken else text[i] for i in range(m.start(), m.end()))
        for piece in re.finditer("[^ ]{20,}", free):
            s, at = piece[0], m.start() + piece.start()
            if not (re.search("[0-9]", s) and re.search("[A-Za-z]", s)) or any(re.search(p, s) for p in NO_SECRETS):
                continue
            limit = next(q.sum_limit(bits) for _, pattern, bits in q.CLASSES if re.search(pattern, s))
            hot = [i for i in range(len(s) - q.WINDOW + 1) if sum(q.TERMS[s[i : i + q.WINDOW].count(c)] for c in set(s[i : i + q.WINDOW])) <= limit]
            if hot:
                out.append((at + hot[0], 3, at + hot[-1] + q.WINDOW))
    return out


def test_spans_equal_brute_force(spark):
    rng = random.Random(9)
    pool = ["password", "SECRET", "token", "api_key", "apikey", "=", ": ", '"', " ", "é", "AKIA", "ABCDEF0123", "0123456789abcdef", "deadbeef", "Zk3Vq8LmT1", "rB7yWcP5sD0aHj", "-", "/", "aaaa", "\n", "example"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 30))) for _ in range(400)]
    got = q.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        t = texts[r.doc_id]
        assert [tuple(s) for s in r.secrets.base] == brute_base(t)
        assert [tuple(s) for s in r.secrets.spans] == sorted(brute_base(t) + brute_entropy(t)), t
    assert any(s.kind == 3 for r in got for s in r.secrets.spans)


def test_what_base_spans_leave_of_a_key_is_scanned(spark):
    key = "Zk3Vq8LmT1rB7yWcP5sD0aHjXu2Ne6Go9Ki4Fb"
    texts = [f"{key}AKIAABCDEFGHIJKL{key}", f"{key}_token=abcdefgh", key + "0a1b2c3d" * 4 + key[::-1], f"secret={key}", "Zk3Vq8LmT1rB7yWcP5s" + "0a1b2c3d" * 4]
    df = q.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: [tuple(s) for s in r.secrets.spans] for r in df.collect()}
    assert got == {i: sorted(brute_base(t) + brute_entropy(t)) for i, t in enumerate(texts)}
    assert [sum(k == 3 for _, k, _ in got[i]) for i in range(5)] == [2, 1, 2, 0, 0]


def test_long_paths_and_names_are_allowed(spark):
    texts = ["/usr" + "/lib64/share" * 20000, "a" + "-name_of" * 5000 + "12", "/usr" + "/lib64/share" * 300 + "/Zk3Vq8LmT1rB7yWcP5sD0aHj"]
    got = q.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: len(r.secrets.spans) for r in got} == {0: 0, 1: 0, 2: 1}


def test_limit_is_the_entropy():
    for bits in (2.9, 3.4, 4.0):
        for counts in ((1,) * 20, (2,) * 10, (4,) * 5, (10, 10)):
            entropy = -sum(c / 20 * math.log2(c / 20) for c in counts)
            if abs(entropy - bits) > 1e-5:
                assert (sum(q.TERMS[c] for c in counts) <= q.sum_limit(bits)) == (entropy >= bits)


def test_redact(spark):
    rows = [(1, "x password=abcdefgh1 y AKIA0123456789ABCDE z"), (2, None), (3, "nothing é")]
    df = q.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r[0]: r[1] for r in df.select("doc_id", q.redact(q.F.col("text"), q.F.col("secrets.spans"))).collect()}
    assert got == {1: "x [SECRET] y [SECRET] z", 2: None, 3: "nothing é"}


def test_odd_rows_and_plan(odd, none):
    df = q.scan_secrets(odd)
    assert df.count() == odd.count() and all(not r.secrets.spans for r in df.collect()) and q.scan_secrets(none).count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
