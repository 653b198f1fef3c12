import hashlib

import numpy as np
import pytest

from quern.llm.byte_bpe import BpeSetup, Remembered, Vocabulary, encode_and_decode, read_ranks

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=dict(read_ranks(PATH)), special_tokens={})


def check(rows, texts, encoding):
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_same_ids_as_the_library(documents, encoding):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = encode_and_decode(documents, ["doc_id"], PATH, P.PATTERN).collect()
    assert len(rows) == len(texts)
    check(rows, texts, encoding)


def test_small_queries_and_memory_change_nothing(documents, encoding):
    texts = {r.doc_id: r.text for r in documents.collect()}
    setup = BpeSetup(query_bytes=300, batch_chars=2000, remembered=50)
    check(encode_and_decode(documents.limit(60), ["doc_id"], PATH, P.PATTERN, setup=setup).collect(), texts, encoding)


def test_odd_texts(encoding):
    texts = ["", " ", "\n\n \n", "a" * 700, "ab" * 200 + "\U0001f600" * 9, "don't we'll I'd", "<|endoftext|>", "é́" * 30, "x\r\ny", "1234567 89"]
    own = Vocabulary(read_ranks(PATH), P.PATTERN)
    ids = own.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [encoding.encode_ordinary(t) for t in texts]
    assert own.decode(ids) == [t.encode() for t in texts]
    assert own.decode([np.array([50255, 0, 220, 220], "<u4").tobytes()]) == [encoding.decode_bytes([50255, 0, 220, 220])]


def test_merges_follow_ranks_not_positions():
    """A small vocabulary whose ranks make the leftmost of equal pairs and a later low rank matter."""
    bytes_ = [(bytes([b]), b) for b in range(256)]
    ranks = [*bytes_, (b"aa", 300), (b"bc", 280), (b"ab", 290), (b"aaa", 260), (b"abc", 310)]
    own = Vocabulary(ranks, r"[a-z]+|\s+|[^a-z\s]+")
    real = tiktoken.Encoding("own", pat_str=r"[a-z]+|\s+|[^a-z\s]+", mergeable_ranks=dict(ranks), special_tokens={})
    for text in ("aaaa", "aaaaa", "abcabc", "aabc", "aaab", "abab abcc aaabcab"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == real.encode_ordinary(text)


def test_a_round_takes_a_row_for_each_piece():
    """Rounds that sort a row for every byte took two thirds of the time."""
    own = Vocabulary(read_ranks(PATH), P.PATTERN)
    own._open()
    db, taken = own._db, []

    class Watched:
        sql, unregister = db.sql, db.unregister

        def register(self, name, rows):
            taken.append((name, rows.num_rows))
            db.register(name, rows)

    own._db = Watched()
    pieces = ["abracadabrax", "zyzzyvazz", "q" * 50]
    own._contract(pieces)
    assert taken == [("start", len(pieces))]
    assert all(own.decode([own._pieces[p]]) == [p.encode()] for p in pieces)


def test_remembered_is_bounded_and_keeps_what_is_used():
    known = Remembered(10)
    for i in range(1000):
        for key in known.missing([i, "often"]):
            known[key] = key
        assert known[i] == i and known["often"] == "often"
        assert len(known) + len(known._older) <= 14


def test_hard_rows(hard, nothing):
    out = encode_and_decode(hard, ["doc_id"], PATH, P.PATTERN, ids=True)
    rows = out.collect()
    assert len(rows) == hard.count()
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert encode_and_decode(nothing, ["doc_id"], PATH, P.PATTERN).collect() == []
