"""Added tokens inside of texts, against a loop over the characters."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators.added_tokens import encode_added, split_added, token_ids

SCHEMA = "token string, id int, special boolean, normalized boolean, lstrip boolean, rstrip boolean, single_word boolean"


def table(spark, rows):
    return spark.createDataFrame([(t, i, True, "n" in f, "l" in f, "r" in f, "w" in f) for t, i, f in rows], SCHEMA)


def by_loop(text, rows):
    """Pieces by trying every token, the longest first, at every place."""
    flags = {t: (i, f) for t, i, f in rows}
    out, plain, at = [], "", 0
    while at < len(text):
        best = None
        for t in sorted(flags, key=lambda t: (-len(t), t)):
            i, f = flags[t]
            begin = at
            while "l" in f and begin < len(text) and text[begin].isspace():
                begin += 1
            end = begin + len(t)
            if text[begin:end] != t or ("w" in f and (text[begin - 1 : begin].isalnum() or text[end : end + 1].isalnum())):
                continue
            while "r" in f and end < len(text) and text[end].isspace():
                end += 1
            best = (end, i)
            break
        if best is None:
            plain, at = plain + text[at], at + 1
            continue
        if plain:
            out.append((plain, None))
        out.append((text[at : best[0]], best[1]))
        plain, at = "", best[0]
    return [*out, (plain, None)] if plain else out


def test_pieces(spark):
    rows = [("<a>", 5, ""), ("<a><b>", 6, ""), ("<l>", 7, "l"), ("<r>", 8, "r"), ("<b>", 9, "lr"), ("yes", 10, "w"), ("\\E.*", 11, "")]
    rng = random.Random(1)
    bits = ["<a>", "<b>", "<l>", "<r>", "yes", " ", "\n", "x", "é", "\\E.*", "<", "word "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in df.select("text", split_added(F.col("text"), table(spark, rows)).alias("p")).collect():
        assert [(x.piece, x.id) for x in r.p] == by_loop(r.text, rows), r.text


def test_ids_in_order_and_normalised_tokens(spark):
    tokens = table(spark, [("<S>", 2, ""), ("end", 3, "nw")])
    vocab = spark.createDataFrame([("a", 10), ("b", 11), ("<s>", 12)], "token string, id int")
    df = spark.createDataFrame([(1, "A b<S>a END ends b"), (2, None), (3, ""), (4, "<s><S>")], "i int, text string")
    got = {r.i: r.tokens for r in encode_added(df, vocab, tokens, normalize=F.lower).collect()}
    assert got == {1: [10, 11, 2, 10, 3, 0, 11], 2: [], 3: [], 4: [12, 2]}
    plain = {r.i: r.tokens for r in encode_added(df, vocab, tokens).collect()}
    assert plain[1] == [0, 11, 2, 10, 0, 0, 11]


def test_unknown_tokens_fail(spark):
    tokens = table(spark, [("<S>", 2, "")])
    df = spark.createDataFrame([("<S>",)], "token string")
    assert [r.id for r in token_ids(df, tokens).collect()] == [2]
    with pytest.raises(Exception, match="not in the table: <T>"):
        token_ids(spark.createDataFrame([("<T>",)], "token string"), tokens).collect()


@pytest.mark.parametrize("limit", [0, 2, 1_000_000])
def test_a_vocabulary_of_any_size(spark, monkeypatch, limit):
    from quern.operators import encode

    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", limit)
    added = table(spark, [("<x>", 90, ""), ("<y>", 91, "")])
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5), ("d", 6)], "token string, id int")
    docs = spark.createDataFrame([(0, "a<x>d e<y><y> b a"), (1, ""), (2, None), (3, "<x>")], "i int, text string")
    got = {r.i: r.tokens for r in encode_added(docs, vocab, added).collect()}
    assert got == {0: [3, 90, 6, 0, 91, 91, 4, 3], 1: [], 2: [], 3: [90]}
