import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from merchlens.llm import bpe_stream as q
from merchlens.llm.pretokens import Points, normalised, spelled

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return q.loaded(PATH)


def odd_texts(n=2000):
    rng = random.Random(5)
    letters = "ab'st re veml d  \n\t é1²٣!?-''’😀中Σß́\x1c\x85 İǅ"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


def test_pretokens_equal_the_library(library):
    texts = odd_texts()
    clean = [normalised(t) for t in texts]
    assert clean == [library.normalizer.normalize_str(t) for t in texts]
    points = Points(clean)
    starts, ends = points.word_level()
    pieces, first = points.strings(starts, ends), np.searchsorted(starts, points.offset)
    for i, t in enumerate(clean):
        assert [spelled(x) for x in pieces[first[i] : first[i + 1]]] == [x for x, _ in library.pre_tokenizer.pre_tokenize_str(t)]
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    points = Points(texts)
    starts, ends = points.byte_level()
    pieces, first = points.strings(starts, ends), np.searchsorted(starts, points.offset)
    for i, t in enumerate(texts):
        assert pieces[first[i] : first[i + 1]] == [t[a:b] for _, (a, b) in other.pre_tokenizer.pre_tokenize_str(t)]


def test_ends_merged_side_by_side_equal_the_library(library, bpe):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeiorstlnhgthe") for _ in range(rng.choice([*range(1, 40), 177, 178, 434, 435, 436, 900]))) for _ in range(1000)] + ["a" * 63, "!!!!"]
    want = [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    raw = [w.encode() for w in words]
    assert [x.tolist() for x in q.transduce(bpe.merges, raw)] == want
    one = [(m := q.Transducer(bpe.merges)) and m.feed(r) + m.finish() for r in raw]
    assert one == want
    none = q.Merges({"a": 0, "b": 1}, [])
    assert [x.tolist() for x in q.transduce(none, [b"ab", b"b"])] == [[0, 1], [1]]


@pytest.mark.parametrize("letters", ["ab", "abcdeiorstlnhgthe", "th", "aeiounsty", "x"])
def test_streaming_keeps_little_and_equals_the_library(library, bpe, letters):
    rng = random.Random(letters)
    raw = "".join(rng.choice(letters) for _ in range(8000)).encode()
    machine, out, most = q.Transducer(bpe.merges), [], 0
    for at in range(0, len(raw), 7):
        out += machine.feed(raw[at : at + 7])
        most = max(most, len(machine.held))
        assert sum(bpe.merges.size[i] for i in out) + len(machine.held) + 1 == min(at + 7, len(raw))
    out += machine.finish()
    assert out == library.encode(raw.decode(), add_special_tokens=False).ids
    assert most <= machine.most == 3 * bpe.merges.lookahead


@pytest.mark.parametrize("part", [1, 2, 3, 5, 8, 17, 64, q.PART])
def test_parts_of_any_size_equal_the_library(library, bpe, part):
    texts = [*odd_texts(), "", "a<|endoftext|> B!", "<|startoftext|><|startoftext|>x", "x" * 3000, "'" * 500 + "s", "中" * 700, "!'s" * 300, "thequick" * 300, "'re'll'd" * 100,
             "a" + "́" * 50 + "b", "가" * 300 + "ᅡᆨ"]
    stream, got = q.Stream(bpe, part), [[]]
    for ids, ended in stream.encode(texts):
        got[-1] += ids.tolist()
        if ended:
            got.append([])
    assert got.pop() == [] and got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert stream.held <= 3 * bpe.merges.lookahead + 1
    assert stream.longest <= max(part, 51)  # only the run of 50 marks is longer than a part of few code points


def test_held_state_over_the_longest_document(spark, library, bpe):
    text = max((r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()), key=len)
    stream, ids, parts = q.Stream(bpe, 1000), [], 0
    for new, _ in stream.encode([text]):
        ids += new.tolist()
        parts += 1
    assert parts > 5 and stream.longest <= 1000 and stream.held <= 3 * bpe.merges.lookahead + 1
    assert ids == library.encode(text, add_special_tokens=False).ids


def test_known_tables_stay_small_and_keep_what_is_asked_for():
    known = q.Known(4)
    known.put(-1, b"often")
    for i in range(100):
        known.put(i, b"once")
        assert known.get([-1]) == [b"often"]
        assert len(known.new) <= 4 and len(known.old) <= 4


def test_lookahead_of_a_known_list():
    # ab, bc, abc...: reading c after ab can undo nothing but the last symbol
    assert q.lookahead([], [], {}) == 0
    assert q.lookahead([(0, 1)], [2], {0: 1, 1: 1, 2: 2}) == 1
    assert q.lookahead([(1, 2), (0, 1)], [3, 4], {0: 1, 1: 1, 2: 1, 3: 2, 4: 2}) == 2


def test_documents(spark, odd, none, library):
    rows = [(100 + i, t) for i, t in enumerate([*odd_texts(200), "a<|endoftext|> B!", "<|startoftext|><|startoftext|>x", "x" * 20000])]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))

    def want(doc, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    assert sorted(map(tuple, q.round_trip(df, PATH).collect()), key=str) == sorted((want(*r) for r in df.collect()), key=str)
    assert q.round_trip(none, PATH).count() == 0
    assert q.encode_documents(odd, PATH).count() == odd.count()


def test_decoder_keeps_unfinished_characters(library, bpe):
    text = "élan vital 中文 😀 ok"
    ids = library.encode(text, add_special_tokens=False).ids
    for step in (1, 2, 100):
        plain, joined = bpe.plain(), bpe.joined()
        parts = [ids[at : at + step] for at in range(0, len(ids), step)]
        assert "".join(map(plain.feed, parts)) + plain.finish() == text + " "
        assert "".join(map(joined.feed, parts)) + joined.finish() == library.decode(ids, skip_special_tokens=False)
    decoder = bpe.plain()
    broken = int(bpe.merges.inner["é".encode()[0]])
    assert decoder.feed([broken]) == "" and decoder.finish() == "\ufffd"
