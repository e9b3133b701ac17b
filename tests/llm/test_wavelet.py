import zlib

import numpy as np
import public_tokenizers
import pytest

from merchlens.llm import wavelet as q
from merchlens.llm.piece_encoder import PieceEncoder
from merchlens.llm.pretokens import all_spelled, spelled

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 65536, 200_003])
def test_access_count_select(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 50257).astype(np.uint32)
    raw = b"".join(q.pack(ids, np.arange(3), np.arange(3)))
    file = q.WaveletFile(lambda at, size: raw[at : at + size], len(raw))
    assert (file.tokens() == ids).all()
    assert all(file.access(int(i)) == ids[i] for i in (rng.integers(0, n, 20) if n else ()))
    for token in {*ids[:9].tolist(), 50256, 1 << 20}:
        places = np.flatnonzero(ids == token)
        low, high = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (file.count(token), file.count(token, low, high)) == (len(places), int(((places >= low) & (places < high)).sum()))
        for k in range(0, len(places), max(1, len(places) // 7)):
            assert file.select(token, k) == places[k]
        if len(places) < 50:
            assert list(file.occurrences(token)) == places.tolist()


def library(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("shard_tokens", [1, 10**6])
def test_files_hold_the_library_ids(spark, odd, tmp_path, shard_tokens):
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(20, "a<|endoftext|> b!"), (21, "don't ''s 12 \x1c é")], "doc_id long, text string"))
    manifest = q.write_shards(more, VOCABULARY, str(tmp_path), shard_tokens=shard_tokens).persist()
    got = sorted(q.read_shards(manifest, str(tmp_path)).collect(), key=lambda r: r.start)
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    said = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in got)
    want = [(r.doc_id, [*library(r.text), q.END_ID]) for r in more.collect()]
    assert said == sorted((-1 if d is None else d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in want)


def test_empty_table(none, tmp_path):
    assert q.read_shards(q.write_shards(none, VOCABULARY, str(tmp_path)).persist(), str(tmp_path)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 65536, 150_001])
def test_planes_divide_and_join(n):
    rng = np.random.default_rng(n)
    values, plane = rng.integers(0, 1 << 16, n).astype(np.uint16), rng.random(n) < 0.3
    zeros = n - int(plane.sum())
    parts = q.divided(values, plane, zeros)
    assert (parts == np.concatenate([values[~plane], values[plane]])).all()
    assert (q.joined(parts, plane, zeros) == values).all()


def piece_lists(calls):
    """Encodes a piece as the code points of its first three characters, and keeps what it is asked."""
    def run(pieces):
        calls.extend(pieces)
        return [[ord(c) for c in p[:3]] for p in pieces]
    return run


@pytest.mark.parametrize("most", [1, 3, 40, 10**5])
def test_kept_pieces_give_the_same_ids_as_all_anew(most):
    rng = np.random.default_rng(most)
    words = [" " + "".join(rng.choice(list("abcé日"), int(k))) for k in rng.integers(1, 5, 300)] + [" " + "x" * 64, " " + "y" * 63, " " + "z" * 400]
    encode = PieceEncoder("byte_level", piece_lists([]), {"<s>": 7}, most=most)
    for _ in range(12):
        texts = ["".join(rng.choice(words, int(k))) + "<s>" * int(k % 2) for k in rng.integers(0, 60, 9)]
        ids, n = encode(texts)
        alone = [PieceEncoder("byte_level", piece_lists([]), {"<s>": 7})([t]) for t in texts]
        assert ids.tolist() == [i for x, _ in alone for i in x.tolist()]
        assert n.tolist() == [int(m[0]) for _, m in alone]
        assert encode.kept.n <= most


def test_known_pieces_are_neither_sorted_nor_encoded_again(monkeypatch):
    calls = []
    encode = PieceEncoder("byte_level", piece_lists(calls), {})
    first = encode(["the fox and the hen", "a hen"])
    assert sorted(calls) == sorted({"the", " fox", " and", " the", " hen", "a"})

    def unique(*_, **__):
        raise AssertionError("known pieces are sorted")

    monkeypatch.setattr(np, "unique", unique)
    again = encode(["the fox and the hen", "a hen"])
    assert len(calls) == 6 and all((x == y).all() for x, y in zip(first, again, strict=True))


def test_spelled_at_once_as_one_by_one():
    pieces = ["a b", "", " é", "日本", "\x00\n", "😀!", "\ud800", "x" * 99]
    assert all_spelled(pieces) == [spelled(p) for p in pieces]
    assert all_spelled(["ab", "", " c"]) == ["ab", "", "Ġc"] and all_spelled([]) == []
