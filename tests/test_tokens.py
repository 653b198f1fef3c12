import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.functions.tokens import require_specials, specials_length, token_width, too_narrow, with_specials
from quern.operators import chat, encode, stats
from quern.plans.prepare import prepare_chunks, prepare_sequences, tokenize

TEXTS = ["a b a", "", "  b   c ", "d\nd e"]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([("s", i, t) for i, t in enumerate(TEXTS)], "source string, row_index long, text string")


@pytest.fixture
def vocab(spark):
    return spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "token string, id int")


WANT = {0: [3, 4, 3], 1: [], 2: [4, 5], 3: [0, 0]}


def test_vocabulary_ranks_by_count_then_word(spark, docs):
    got = {r.token: r.id for r in encode.word_vocabulary(docs, size=6).collect()}
    assert got == {"a": 3, "b": 4, "c": 5}
    every = {r.token: r.id for r in encode.word_vocabulary(docs).collect()}
    assert every == {"a": 3, "b": 4, "c": 5, "d\nd": 6, "e": 7}


def test_words_come_back_whole(spark, docs):
    vocab = encode.word_vocabulary(docs)
    ids = encode.encode_words(docs, vocab).drop("text")
    got = {r.row_index: r.text for r in encode.decode_words(ids, vocab).collect()}
    assert got == {i: " ".join(t for t in text.split(" ") if t) for i, text in enumerate(TEXTS)}


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_a_token_listed_twice_has_its_smallest_id(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", limit)
    twice = spark.createDataFrame([("a", 6), ("b", 4), ("a", 3), ("c", 5)], "token string, id int")
    assert {r.row_index: r.tokens for r in encode.encode_words(docs, twice).collect()} == WANT


def test_both_encoders_agree(spark, docs, vocab):
    a = {r.row_index: r.tokens for r in encode.encode_words(docs, vocab).collect()}
    b = {r.row_index: r.tokens for r in encode.encode_words_by_join(docs, vocab).collect()}
    assert a == b == WANT


def test_text_that_is_not_kept_is_not_written(docs, vocab, monkeypatch):
    stored, pin = [], encode._pin
    monkeypatch.setattr(encode, "_pin", lambda df: stored.append(df.columns) or pin(df))
    out = encode.encode_words_by_join(docs, vocab, keep_text=False)
    assert {r.row_index: r.tokens for r in out.collect()} == WANT
    assert "text" not in stored[0] and "text" not in out.columns
    assert out.columns == encode.encode_words(docs, vocab, keep_text=False).columns


def test_a_large_vocabulary_is_joined(spark, docs, vocab, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", 2)
    assert {r.row_index: r.tokens for r in encode.encode_words(docs, vocab).collect()} == WANT


def test_null_text_gives_no_tokens(spark, vocab):
    df = spark.createDataFrame([(None,)], "text string")
    assert encode.encode_words(df, vocab).first().tokens == []


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_decode(spark, docs, vocab, monkeypatch, limit):
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", limit)
    ids = encode.encode_words(docs, vocab).drop("text")
    specials = spark.createDataFrame([("<s>", 1), ("<|im_end|>", 2)], "token string, id int")
    wrapped = ids.withColumn("tokens", with_specials(F.col("tokens"), 1, 2))
    full = {r.row_index: r.text for r in encode.decode_words(wrapped, vocab, specials).collect()}
    bare = {r.row_index: r.text for r in encode.decode_words(wrapped, vocab, specials, skip_special_tokens=True).collect()}
    assert full[0] == "<s> a b a <|im_end|>"
    assert bare == {0: "a b a", 1: "", 2: "b c", 3: "<unk> <unk>"}


def test_token_to_id_fails_on_unknown(spark, vocab):
    known = spark.createDataFrame([("a",)], "token string")
    assert encode.token_to_id(known, vocab).first().id == 3
    with pytest.raises(Exception, match="not in the vocabulary"):
        encode.token_to_id(spark.createDataFrame([("zz",)], "token string"), vocab).collect()
    rows = encode.lookup_ids(spark.createDataFrame([("a",), ("zz",)], "token string"), vocab, broadcast_limit=0)
    assert {r.token: r.id for r in rows.collect()} == {"a": 3, "zz": None}


@pytest.mark.parametrize(
    "bos, eos, cap, want",
    [
        (1, 2, -1, [1, 7, 8, 9, 2]),
        (None, 2, -1, [7, 8, 9, 2]),
        (1, None, 2, [1, 7, 8, 9]),
        (1, 2, 4, [1, 7, 8, 2]),
        (1, 2, 5, [1, 7, 8, 9, 2]),
        (1, 2, 2, [1, 2]),
        (1, 2, 1, [2]),
        (None, None, -1, [7, 8, 9]),
    ],
)
def test_specials_and_cap(spark, bos, eos, cap, want):
    df = spark.createDataFrame([([7, 8, 9],)], "tokens array<int>")
    row = df.select(
        with_specials(F.col("tokens"), bos, eos, cap).alias("t"),
        specials_length(F.size("tokens"), bos is not None, eos is not None, cap).alias("n"),
    ).first()
    assert row.t == want and row.n == len(want)


def test_width_and_required_specials():
    assert (token_width(65499), token_width(65500)) == ("uint16", "int32")
    assert too_narrow(2, 65536) and not too_narrow(2, 65535) and not too_narrow(4, 10**6)
    require_specials(1, None, True, False)
    with pytest.raises(ValueError):
        require_specials(1, None, True, True)


def test_pipelines_take_every_kind_of_tokenizer(spark, docs, vocab):
    length = lambda d: d.withColumn("tokens", F.transform(F.split("text", ""), lambda c: F.ascii(c)))
    for tokenizer in (vocab, length):
        tokens = tokenize(docs, tokenizer).collect()
        total = sum(len(r.tokens) for r in tokens)
        chunks = prepare_chunks(docs, tokenizer, 4).collect()
        assert sum(r.n_real for r in chunks) == total
        assert {r.split for r in chunks} == {"train"}
    split = prepare_chunks(docs, vocab, 4, train_ratio="0.5").collect()
    assert {r.split for r in split} == {"train", "validation"}
    by_source = lambda d: d.withColumn("split", F.lit("mine"))
    assert {r.split for r in prepare_chunks(docs, vocab, 4, splitter=by_source).collect()} == {"mine"}
    # Batches hold documents 0 and 2 (1 3 4 3 2 | 1 4 5 2) and document 3 (1 0 0 2).
    seqs = prepare_sequences(docs, vocab, seq_length=4, batch_size=2).orderBy("batch_no", "seq_no").collect()
    assert [(r.batch_no, r.tokens) for r in seqs] == [(0, [1, 3, 4, 3, 2]), (0, [1, 4, 5, 2, 2]), (1, [1, 0, 0, 2, 2])]


def test_split_counts_over_all_documents(spark, vocab):
    """Many files of one document each still give a tenth to validation."""
    many = spark.createDataFrame([(f"f{i:03d}", 0, "a b") for i in range(100)], "source string, row_index long, text string")
    got = prepare_chunks(many, vocab, 4, train_ratio="0.9").select("split", "source", "counter").collect()
    assert sum(r.split == "train" for r in got) == 90
    for split in ("train", "validation"):
        assert [r.counter for r in sorted(got, key=lambda r: r.source) if r.split == split] == list(range(sum(r.split == split for r in got)))
    alone = prepare_chunks(many, vocab, 4, train_ratio="0.9", split_within="source").select("split").distinct().collect()
    assert [r.split for r in alone] == ["train"]


def test_sequences_skip_blank_documents(spark, docs, vocab):
    seqs = prepare_sequences(docs, vocab, seq_length=3, batch_size=10).orderBy("seq_no").collect()
    # 1 3 4 3 2 | 1 4 5 2 | 1 0 0 2: thirteen tokens, the blank document is gone.
    assert [r.tokens for r in seqs] == [[1, 3, 4, 3], [2, 1, 4, 5], [2, 1, 0, 0]]


def render(rows, prompt=False):
    out = "<s>" if rows[0][0] in ("user", "system") else ""
    out += "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in rows)
    return out + ("<|im_start|>assistant\n" if prompt else "<|im_end|>" if rows[-1][0] == "assistant" else "")


@pytest.mark.parametrize("prompt", [False, True])
def test_chat(spark, prompt):
    talks = {
        1: [("system", "s"), ("user", "u"), ("assistant", "a")],
        2: [("user", "u")],
        3: [("assistant", "a"), ("user", "u")],
        4: [("assistant", "only")],
    }
    data = [(c, i * 2, role, text) for c, rows in talks.items() for i, (role, text) in enumerate(rows)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r.rendered for r in chat.render_chat(df, add_generation_prompt=prompt).collect()}
    assert got == {c: render(rows, prompt) for c, rows in talks.items()}


def test_quarantine_and_metadata(spark):
    df = spark.createDataFrame([(1, "x" * 80), (2, None), (3, "ok")], "id int, text string")
    good, bad = stats.with_quarantine(df, F.length("text") < 10, "text", "length")
    assert [r.id for r in good.collect()] == [3]
    assert sorted((r.id, r.excerpt) for r in bad.collect()) == [(1, "x" * 50), (2, None)]
    assert stats.error_counts(bad).first().errors == 2
    packed = spark.createDataFrame([("a", [1, 2]), ("a", [3, 4]), ("b", [5, 6])], "source string, tokens array<int>")
    shards = spark.createDataFrame([("train", 2**30), ("train", 2**29), ("", 5)], "subset string, bytes long")
    meta = stats.corpus_metadata(packed, shards, {"dataset": "d", "token_size_bytes": 2}).first()
    assert (meta.total_sequences, meta.total_tokens, meta.total_files_processed, meta.dataset) == (3, 6, 2, "d")
    assert meta.subset_stats["train"].total_size_human == "1.50 GB" and list(meta.subset_stats) == ["train"]


def test_stateless_operators_accept_streams(spark, tmp_path, vocab):
    from quern.functions.text import drop_blank, with_subset

    spark.createDataFrame([("/c/train/x", "a b"), ("/c/y", "  ")], "path string, text string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("path string, text string").parquet(str(tmp_path / "in"))
    out = encode.encode_words(with_subset(drop_blank(stream)), vocab)
    out = out.withColumn("tokens", with_specials(F.col("tokens"), 1, 2))
    run = out.writeStream.format("memory").queryName("packed_stream").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert [(r.subset, r.tokens) for r in spark.table("packed_stream").collect()] == [("train", [1, 3, 4, 2])]


def test_totals_from_lengths_are_those_of_the_chunks(spark):
    from quern.operators import packing, stats

    data = [(f"s{i % 3}", i, list(range(i % 7))) for i in range(60)] + [("empty", 99, [])]
    df = spark.createDataFrame(data, "source string, doc_id long, tokens array<int>")
    chunks = packing.pack_chunks(df, "source", "doc_id", 8, 0)
    assert stats.chunk_totals(df, F.size("tokens"), 8).collect() == stats.corpus_totals(chunks).collect()


@pytest.mark.parametrize("limit", [0, 1, 2, 5, 40])
def test_a_large_vocabulary_is_broadcast_in_part(spark, monkeypatch, limit):
    """Words of the head, words of the rest and unknown words, in one text and in many."""
    known = {f"w{i}": 3 + i for i in range(30)}
    texts = [None, "", " ", *[" ".join(f"w{(i * j) % 41}" for j in range(i)) for i in range(1, 60)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "row_index long, text string").repartition(3)
    vocab = spark.createDataFrame([*known.items(), ("w2", 99), ("gone", None)], "token string, id int")
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", limit)
    ids = encode.encode_words(docs, vocab)
    want = {i: [known.get(w, 0) for w in (t or "").split()] for i, t in enumerate(texts)}
    assert {r.row_index: r.tokens for r in ids.collect()} == want
    by_id = {i: w for w, i in known.items()}
    back = encode.decode_words(ids.drop("text"), vocab.where("id <> 99"))
    assert {r.row_index: r.text for r in back.collect()} == {i: " ".join(by_id.get(t, "<unk>") for t in ts) for i, ts in want.items()}
    rows = docs.select("row_index", F.explode(encode.words(F.col("text"))).alias("token"))
    found = encode.lookup_ids(rows, encode.one_id(vocab), broadcast_limit=limit)
    assert sorted((r.row_index, r.token, r.id or 0) for r in found.collect()) == sorted((i, w, known.get(w, 0)) for i, t in enumerate(texts) for w in (t or "").split())


def test_only_rare_words_cross_the_shuffle(spark, monkeypatch):
    """Words of the head never become rows, and others once a document; before, all did, beside 32 copies of the vocabulary."""
    seen = []
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", 2)
    real = encode._pin
    monkeypatch.setattr(encode, "_pin", lambda df: seen.append(real(df)) or seen[-1])
    docs = spark.createDataFrame([(1, "a b a b z c z c c")], "row_index long, text string")
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5), ("d", 6)], "token string, id int")
    assert encode.encode_words(docs, vocab).first().tokens == [3, 4, 3, 4, 0, 5, 0, 5, 5]
    assert sorted(seen[0].first()["__e"].rest) in (["b", "c", "z"], ["c", "z"])


def test_a_vocabulary_of_millions_is_broadcast_as_arrays(spark, docs, vocab, monkeypatch):
    """Before, more than a million entries were joined, and the rows with their ids written and shuffled."""
    monkeypatch.setattr(encode, "_encode_by_join", None)
    many = spark.range(1_000_000).select(F.concat(F.lit("w"), "id").alias("token"), (F.col("id") + 100).cast("int").alias("id"))
    ids = encode.encode_words(docs, vocab.select("token", "id").unionByName(many))
    assert {r.row_index: r.tokens for r in ids.collect()} == {r.row_index: r.tokens for r in encode.encode_words(docs, vocab).collect()}


@pytest.mark.parametrize("spread", [1, 3, 1 << 40])
def test_words_that_share_a_hash_are_told_apart(monkeypatch, spread):
    real = encode._hashes
    monkeypatch.setattr(encode, "_hashes", lambda words: real(words) % np.uint64(spread))
    listed = [("a", 5), ("b", 6), ("a", 3), ("c", 7), ("b", 9), ("", 8), (None, 1), ("d", None)]
    table = pa.table({"token": [t for t, _ in listed], "id": pa.array([i for _, i in listed], pa.int32())})
    asked = pa.array(["a", "b", "c", "", "d", "e", "a"])
    assert encode.WordIndex(table).look_up(asked, -1).tolist() == [3, 6, 7, 8, -1, -1, 3]
    assert encode.WordIndex(table.slice(0, 0)).look_up(asked, -1).tolist() == [-1] * 7


def test_a_vocabulary_is_bounded_by_bytes(spark, vocab, monkeypatch):
    stored = spark.createDataFrame([("a" * 50, 3), ("b" * 50, 4)], "token string, id int")
    assert encode.bounded_rows(stored, 2).num_rows == 2
    monkeypatch.setattr(encode, "BROADCAST_BYTES", 60)
    assert encode.bounded_rows(stored, 2) is None and encode.head_of(stored, 2)[0].count() <= 1


def test_a_vocabulary_is_written_once_before_its_join(spark, docs, vocab, monkeypatch):
    """Before, it was shuffled and written again only to list each token once."""
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", 2)
    labels, real = [], encode.materialize
    monkeypatch.setattr(encode, "materialize", lambda df, label: labels.append(label) or real(df, label))
    encode.encode_words(docs, vocab).collect()
    assert labels == ["vocabulary", "keyed"]


@pytest.mark.parametrize("limit", [2, 10])
def test_known_words_of_whole_texts(spark, docs, vocab, monkeypatch, limit):
    """Words are looked up without a row for each; before, their rows met the broadcast head twice."""
    monkeypatch.setattr(encode, "BROADCAST_ENTRIES", limit)
    got = encode.encode_known_words(docs.where("row_index < 3"), vocab)
    assert {r.row_index: r.tokens for r in got.collect()} == {i: WANT[i] for i in range(3)} and "text" not in got.columns
    with pytest.raises(Exception, match="not in the vocabulary"):
        encode.encode_known_words(docs, vocab).collect()
