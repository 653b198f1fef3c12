import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm.language_model import LmSetup, bit_array, expected, has, pair_keys, score_texts, token_keys, train, train_and_score


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\x0b\x0c\r":
        low = low.replace(s, " ")
    return [*(w for w in low.split(" ") if w), None]


def brute(rows, training):
    """Exact unigram figures of every row."""
    c = Counter(t for text in training for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return {
        d: (len(k), sum(c[t] > 0 for t in k), sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in k))
        for d, k in ((d, tokens(t)) for d, t in rows)
    }


@pytest.mark.parametrize("vocabulary", [8_000_000, 10])
def test_base_is_exact_with_and_without_broadcast_words(documents, vocabulary):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    training = documents.filter("doc_id % 10 != 0")
    model, table = train(training, setup=LmSetup(vocabulary=vocabulary, segment_chars=1 << 16, batch_chars=1 << 17))
    want = brute(rows, [t for d, t in rows if d % 10])
    got = score_texts(documents, model, table).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (n, known)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0


def test_filter_holds_every_count_and_rarely_more(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    text = " ".join(rng.choice(words, 20000, p=np.arange(1, 401)[::-1] / sum(range(1, 401))))
    df = spark.createDataFrame([(text,)] * 3 + [(None,), ("",)], "text string")
    model, _ = train(df)
    k = token_keys(text)
    pairs = Counter(pair_keys(k).tolist())
    keys = np.array(list(pairs), np.uint64)
    level = model.filter.levels(keys)
    true = np.array([1 + int(math.log2(3 * pairs[int(x)])) for x in keys])
    assert (level >= true).all() and (level > true).mean() < 0.03
    absent = rng.integers(0, 1 << 48, 20000, dtype=np.uint64)
    assert (model.filter.levels(absent) > 0).mean() < 0.03
    assert expected(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_a_filter_beyond_its_bound_is_not_held(documents):
    whole, _ = train(documents)
    small, table = train(documents, setup=LmSetup(filter_bytes=whole.filter.nbytes // 4))
    assert whole.filter.nbytes > 0 and small.filter.arrays is None and small.words is None
    assert all(r.score < 0 for r in score_texts(documents, small, table).collect())
    exact, _ = train(documents, setup=LmSetup(filter_bytes=whole.filter.nbytes))
    assert exact.filter.nbytes == whole.filter.nbytes


def test_trained_and_scored_at_once(documents):
    training = F.col("doc_id") % 10 != 0
    setup = LmSetup(segment_chars=1 << 16, batch_chars=1 << 17)
    model, table = train(documents.filter(training), setup=setup)
    want = {r.doc_id: r for r in score_texts(documents, model, table).collect()}
    for more in ({}, {"filter_bytes": 1000, "run": 3}):
        got, own = train_and_score(documents, training, setup=replace(setup, **more))
        assert np.array_equal(own.weights, model.weights) and own.tokens == model.tokens
        rows = got.collect()
        assert len(rows) == len(want)
        for r in rows:
            w = want[r.doc_id]
            assert (r.n_tokens, r.n_known) == (w.n_tokens, w.n_known)
            assert math.isclose(r.score, w.score, rel_tol=1e-9) and math.isclose(r.base_score, w.base_score, rel_tol=1e-9)


def brute_scores(rows, training):
    """The score by loops over plain counts, with each count replaced by the mean one of its level."""
    words, pairs = Counter(), Counter()
    for text in training:
        t = tokens(text)
        words.update(t)
        pairs.update(zip(t, t[1:], strict=False))

    def level(c):
        return c.bit_length()

    def mean(c):
        return (2 ** (level(c) - 1) + 2 ** level(c) - 1) / 2 if c else 0

    n, seen = Counter(), Counter()
    for text in training:
        t = tokens(text)
        for a, b in zip(t, t[1:], strict=False):
            n[level(words[a])] += 1
            seen[level(words[a])] += pairs[a, b] >= 2
    weight = {j: min((seen[j] + 0.5) / (n[j] + 10), 0.98) for j in range(64)}
    weight[1] = weight[2]
    total, distinct = sum(words.values()), len(words)
    out = {}
    for d, text in rows:
        t, score = tokens(text), 0.0
        for i, w in enumerate(t):
            uni = (mean(words[w]) + 0.1) / (total + 0.1 * (distinct + 1))
            c = words[t[i - 1]] if i else 0
            share = min(mean(pairs[t[i - 1], w]) / mean(c), 1.0) if c else 0.0
            k = weight[level(c)] if c else 0.0
            score += math.log10(k * share + (1 - k) * uni)
        out[d] = score
    return out


@pytest.mark.parametrize("filter_bytes", [1 << 27, 1000])
def test_score_is_that_of_plain_loops(documents, filter_bytes):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    # So many bits that nothing is held falsely.
    setup = LmSetup(bits=400, probes=9, filter_bytes=filter_bytes, segment_chars=1 << 16, batch_chars=1 << 17)
    got, _ = train_and_score(documents, F.col("doc_id") % 10 != 0, setup=setup)
    want = brute_scores(rows, [t for d, t in rows if d % 10])
    for r in got.collect():
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-9), r.doc_id


def test_scores_are_the_same_beyond_the_bound_of_the_filter(documents):
    setup = dict(segment_chars=1 << 17, batch_chars=1 << 16)
    training = documents.filter("doc_id % 10 != 0")
    both = []
    for more in ({}, {"filter_bytes": 1000}, {"filter_bytes": 1000, "vocabulary": 10}):
        model, table = train(training, setup=LmSetup(**setup, **more))
        both.append((model, {r.doc_id: r for r in score_texts(documents, model, table).collect()}))
    (near, want), *others = both
    for far, got in others:
        assert near.filter.arrays is not None and far.filter.arrays is None and np.array_equal(near.weights, far.weights)
        assert got.keys() == want.keys()
        for d, r in got.items():
            assert (r.n_tokens, r.n_known) == (want[d].n_tokens, want[d].n_known)
            assert math.isclose(r.score, want[d].score, rel_tol=1e-9) and math.isclose(r.base_score, want[d].base_score, rel_tol=1e-9)


def test_bit_arrays():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    array = np.frombuffer(bit_array(keys, LmSetup()), np.uint8)
    assert has(array, keys, LmSetup()).all()
    assert has(array, rng.integers(0, 1 << 63, 50000, dtype=np.uint64), LmSetup()).mean() < 0.02


def test_model_beats_its_base_on_texts_it_has_seen_parts_of(documents):
    model, table = train(documents.filter("doc_id % 10 != 0"))
    rows = [r for r in score_texts(documents, model, table).collect() if r.doc_id % 10]
    assert sum(r.score for r in rows) > 0.9 * sum(r.base_score for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_hard_rows(hard, nothing):
    model, table = train(hard)
    rows = score_texts(hard, model, table).collect()
    assert len(rows) == hard.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].n_tokens == by_id[1].n_tokens == by_id[3].n_tokens == 1 and by_id[5].n_tokens == 3
    assert all(r.score <= 0 and math.isfinite(r.base_score) for r in rows)
    empty, none = train(nothing)
    assert all(r.n_known == 0 for r in score_texts(hard, empty, none).collect())
    assert score_texts(nothing, model, table).collect() == []
