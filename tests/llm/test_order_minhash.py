import random

import numpy as np

from merchlens.llm import order_minhash as q
from merchlens.llm.words import word_hashes


def brute(rows):
    """Classes by aligning all pairs; rows: (id, text)."""
    parts = [q.shingles(word_hashes(t or "").astype(np.uint32)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            same = parts[a].tobytes() == parts[b].tobytes() if len(parts[a]) else (rows[a][1] or "") == (rows[b][1] or "")
            if same or q.aligned(parts[a], parts[b]) >= q.SIMILARITY:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(len(rows))]


def partition(labels):
    groups = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, set()).add(i)
    return sorted(map(sorted, groups.values()))


def corpus(seed=3, families=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))
    shared = [word() for _ in range(60)]
    texts = []
    for _ in range(families):
        first = [word() for _ in range(rng.randrange(3, 200))]
        for _ in range(rng.randrange(1, 9)):
            own = list(first)
            for _ in range(rng.randrange(0, 1 + len(own) // 12)):
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(0, 2)] = [word() for _ in range(rng.randrange(0, 3))]
            if rng.random() < 0.3:
                own = [word() for _ in range(40)] + shared + own
            texts.append(" ".join(own))
    return list(enumerate(texts))


def test_classes_equal_brute_force(spark):
    rows = corpus()
    got = q.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {r.doc_id: r.class_id for r in got}
    assert partition([by[i] for i, _ in rows]) == partition(brute(rows))
    assert sum(r.kept for r in got) == len(set(by.values()))


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(q, "MOST", 6)
    rows = corpus(seed=11, families=6) + [(1000 + i, t) for i, (_, t) in enumerate(corpus(seed=11, families=6))]
    got = {r.doc_id: r.class_id for r in q.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert partition([got[i] for i, _ in rows]) == partition(brute(rows))


def test_odd_rows(odd):
    got = q.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len({r.class_id for r in by[7]} | {r.class_id for r in by[8]}) == 2
    assert by[1][0].class_id == by[2][0].class_id  # null and empty
    assert len({r.text_key for r in by[4]}) == 2 and all(r.class_id == 4 for r in by[4])
    kept = [(r.doc_id, r.text_key) for r in got if r.kept]
    # null texts and empty ones are one class, the repeated row is kept twice under one key, all others stand alone
    assert len(set(kept)) == len({(r.doc_id, r.text_key) for r in got}) - 2


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(1)
    first = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(400):
        own = list(first)
        for _ in range(2):
            own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    got = q.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.select("class_id").distinct().count() == 1


def test_empty_table(none):
    assert q.near_duplicates(none).count() == 0


def test_alignment_is_a_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (np.array(rng.sample(range(1, 20), rng.randrange(1, 15)), np.uint64) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        longer = max(len(a), len(b))
        if q.aligned(a, b):
            assert q.aligned(a, b) <= table[-1, -1] / longer
        if table[-1, -1] >= 0.8 * longer:
            assert q.aligned(a, b) == table[-1, -1] / longer


def test_a_borderline_text_finds_its_partner_among_near_misses(spark):
    """Two groups of near copies with one pair between them that aligns; both of it agree as much with others of the other group."""
    rng = random.Random(118)

    def changed(own, places):
        own = list(own)
        for p in places:
            own[p] = f"v{rng.randrange(10**9)}"
        return own

    first = [f"w{i}" for i in range(204)]
    places = rng.sample(range(2, 202, 6), 33)
    twin = changed(first, places[:2])
    border = changed(twin, places[2:10])
    texts = [first, twin, *(changed(first, rng.sample(places, 2)) for _ in range(12)), border, *(changed(border, rng.sample(places, 2)) for _ in range(12))]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    parts = [q.shingles(word_hashes(t).astype(np.uint32)) for _, t in rows]
    assert [(a, b) for a in range(14) for b in range(14, 27) if q.aligned(parts[a], parts[b]) >= q.SIMILARITY] == [(1, 14)]
    got = q.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.select("class_id").distinct().count() == 1


def _meetings(units):
    """Pairs of rows of different components that meet, once for each meeting."""
    by = {}
    for r in units.collect():
        by.setdefault(r.unit, []).append(r)
    out = []
    for rows in by.values():
        sided = any(r.side for r in rows)
        for i, x in enumerate(rows):
            out += [tuple(sorted((x.node, y.node))) for y in rows[:i] if x.root != y.root and (x.side != y.side or not sided)]
    return out


def _rows(spark, roots, marks):
    rows = [(7, i, root, 100, bytearray(marks(i))) for i, root in enumerate(roots)]
    return spark.createDataFrame(rows, "key long, node long, root long, n long, marks binary")


def test_all_blocks_of_a_bucket_meet(spark, monkeypatch):
    """Distinct texts of equal marks: a component of more than a block, several small ones, and single texts."""
    monkeypatch.setattr(q, "WIDE", 1000)
    roots = [0] * 9 + [9] * 3 + [12] * 2 + list(range(14, 30))
    got = _meetings(q.units(_rows(spark, roots, lambda i: [0] * q.SKETCHES), 4))
    assert len(got) == len(set(got)) and set(got) == {(a, b) for b in range(30) for a in range(b) if roots[a] != roots[b]}


def test_a_bucket_of_many_blocks_is_split_by_marks(spark, monkeypatch):
    """All pairs of ``AGREE`` marks meet, in the unit of the first mark that they share and perhaps in others."""
    monkeypatch.setattr(q, "WIDE", 1)
    rng = random.Random(4)
    marks = [[rng.randrange(3) for _ in range(q.SKETCHES)] for _ in range(60)]
    roots = [i // 2 * 2 for i in range(60)]
    units = q.units(_rows(spark, roots, lambda i: marks[i]), 4)
    assert {r.split for r in units.select("split").distinct().collect()} == set(range(q.SKETCHES - q.AGREE + 1))
    agree = lambda a, b: sum(x == y for x, y in zip(marks[a], marks[b], strict=True))
    wanted = {(a, b) for b in range(60) for a in range(b) if roots[a] != roots[b] and agree(a, b) >= q.AGREE}
    assert wanted and wanted <= set(_meetings(units))


def test_each_pair_is_verified_in_one_unit(spark):
    """Two texts that share several sketches meet in several units; rows are live in the first only."""
    keys = [list(range(q.SKETCHES)), list(range(q.SKETCHES)), [1000 + i if i < 5 else i for i in range(q.SKETCHES)]]
    rows = [(k, i, node, node, 100, bytearray(q.SKETCHES), keys[node]) for node in range(3) for i, k in enumerate(keys[node])]
    frame = spark.createDataFrame(rows, "key long, place int, node long, root long, n long, marks binary, keys array<long>")
    assert sorted((r.unit, r.node) for r in q.live(q.units(frame)).collect()) == [(0, 0), (0, 1), (5, 0), (5, 1), (5, 2)]


def test_a_unit_returns_spanning_links_only():
    """Many alike texts of different components: one link less than texts, and all of them joined."""
    rng = random.Random(8)
    first = [f"w{i}" for i in range(150)]
    texts = [" ".join(f"v{rng.randrange(10**9)}" if rng.randrange(60) == 0 else w for w in first) for _ in range(40)]
    parts = [q.shingles(word_hashes(t).astype(np.uint32)) for t in texts]
    marks = np.array([np.frombuffer(q.sketch(p)[1], np.uint8) for p in parts])
    for heads in (40, 13):
        found = q._spanning(parts, np.arange(40), marks, heads)
        assert all(q.aligned(parts[a], parts[b]) >= q.SIMILARITY for a, b in found)
        assert len(found) < 40
        if heads == 40:
            assert len(found) == 39
