import random

import pytest
from pyspark.sql import functions as F

from quern.operators import ordered, packing

EOS, PAD = 2, 32001


def docs(spark, lengths, group="g"):
    token, data = 100, []
    for i, n in enumerate(lengths):
        data.append((group, i, list(range(token, token + n))))
        token += n
    return spark.createDataFrame(data, "source string, row_index long, tokens array<int>")


@pytest.mark.parametrize(
    "lengths, sequences, padded",
    [([10], 1, 0), ([5, 5, 8], 2, 2), ([5, 5, 7], 1, 0), ([35], 3, 0), ([7], 0, 0), ([0, 10], 1, 0), ([10, 10], 2, 0)],
)
def test_sequence_goldens(spark, lengths, sequences, padded):
    got = packing.pack_sequences(docs(spark, lengths), "source", "row_index", 9, EOS).orderBy("seq_no").collect()
    assert len(got) == sequences
    assert all(len(r.tokens) == 10 for r in got)
    flat = [t for r in got for t in r.tokens]
    assert flat[: len(flat) - padded] == list(range(100, 100 + len(flat) - padded))
    assert flat[len(flat) - padded :] == [EOS] * padded


@pytest.mark.parametrize(
    "lengths, n_chunks, padded", [([10], 1, 0), ([5, 5, 8], 2, 2), ([5, 5, 7], 2, 3), ([35], 4, 5), ([7], 1, 3), ([0], 0, 0)]
)
def test_chunk_goldens(spark, lengths, n_chunks, padded):
    got = packing.pack_chunks(docs(spark, lengths), "source", "row_index", 10, PAD).orderBy("chunk_no").collect()
    assert len(got) == n_chunks
    flat = [t for r in got for t in r.tokens]
    assert len(flat) == 10 * n_chunks
    assert flat.count(PAD) == padded
    assert sum(r.n_real for r in got) == sum(lengths)


def restated_sequences(lists, length):
    """The sequential rule as a loop: append, cut, keep a tail of 80%."""
    out, buffer = [], []
    for tokens in lists:
        buffer += tokens
        while len(buffer) >= length + 1:
            out.append(buffer[: length + 1])
            buffer = buffer[length + 1 :]
    if 10 * len(buffer) >= 8 * (length + 1):
        out.append(buffer + [EOS] * (length + 1 - len(buffer)))
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_random_documents_match_the_loop(spark, monkeypatch, parts):
    monkeypatch.setattr(ordered, "BLOCK_BITS", 2)
    rng = random.Random(7)
    data = [
        ("hot" if i % 3 else f"s{i % 5}", i * 3, [rng.randrange(100, 200) for _ in range(rng.choice([0, 1, 4, 9, 40]))])
        for i in range(150)
    ]
    df = spark.createDataFrame(data, "source string, row_index long, tokens array<int>").repartition(parts)
    by_source = {}
    for source, _, tokens in sorted(data):
        by_source.setdefault(source, []).append(tokens)

    batched = packing.with_batches(df, "source", "row_index", 20)
    got = packing.pack_sequences(batched, ["source", "batch_no"], "row_index", 15, EOS)
    found = {(r.source, r.batch_no, r.seq_no): r.tokens for r in got.collect()}
    want = {}
    for source, lists in by_source.items():
        for b in range(0, len(lists), 20):
            for s, tokens in enumerate(restated_sequences(lists[b : b + 20], 15)):
                want[(source, b // 20, s)] = tokens
    assert found == want

    chunks = packing.pack_chunks(df, "source", "row_index", 16, PAD).collect()
    for source, lists in by_source.items():
        flat = [t for tokens in lists for t in tokens]
        mine = sorted((r.chunk_no, r.tokens, r.n_real) for r in chunks if r.source == source)
        assert [t for _, tokens, n in mine for t in tokens[:n]] == flat
        assert all(len(tokens) == 16 for _, tokens, _ in mine)


def test_blocks_ignore_the_rest(spark):
    df = spark.createDataFrame([(0, list(range(10)))], "chunk_no long, tokens array<int>")
    got = packing.explode_blocks(df, 4).orderBy("block_no").collect()
    assert [(r.block_no, r.tokens) for r in got] == [(0, [0, 1, 2, 3]), (1, [4, 5, 6, 7])]
    assert packing.explode_blocks(df, 4).schema["tokens"].dataType.simpleString() == "array<bigint>"


def test_default_chunk_size():
    assert packing.chunk_size_for() == 16_778_240


def test_length_expression_keeps_tokens_out_of_the_totals(spark):
    df = docs(spark, [5, 5, 8]).withColumn("n", F.size("tokens"))
    a = packing.pack_chunks(df, "source", "row_index", 10, PAD, length=F.col("n")).collect()
    b = packing.pack_chunks(df, "source", "row_index", 10, PAD).collect()
    assert sorted(a) == sorted(b)
