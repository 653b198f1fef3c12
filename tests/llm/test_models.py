"""Language, quality and toxicity: held-out accuracy, hard rows, and the parts by themselves."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import language, quality_model, toxicity
from quern.llm.labelled import thinned, training_labels
from quern.llm.text import split_share

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    import os

    if not os.path.exists(DATA):
        pytest.skip("driver tables are not here")
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def test_split_is_the_crc_of_the_key_as_text(spark):
    for r in spark.range(50).select("id", split_share(F.col("id"), 5).alias("s")).collect():
        assert r.s == zlib.crc32(str(r.id).encode()) % 5


def test_training_labels(spark):
    rows = [(i, i % 2, None) for i in range(100)] + [(1, 0, None), (None, 1, None), (3, None, None)]
    got = training_labels(spark.createDataFrame(rows, "doc_id long, quality int, x string"), "doc_id", "quality", 4, 2)
    found = {r.key: r.label for r in got.collect()}
    assert set(found) == {i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert found.get(1, 0) == 0
    assert 300 < thinned(spark.range(5000), ["id"], 400).count() < 500


def test_language_accuracy(tables):
    docs, _ = tables
    held = split_share(F.col("doc_id"), 5) == 0
    model = language.train(docs.filter(~held))
    assert sorted(model.dictionaries) == ["de", "en", "es", "fr"]
    assert all(len(x) <= model.setup.dictionary_bytes for x in model.dictionaries.values())
    rows = language.identify(docs.filter(held), model, ["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    sure = [r for r in rows if not r.rejected]
    assert np.mean([r.lang == r.lang_pred for r in sure]) > 0.98


def test_language_sample_counts_copies_once(spark):
    setup = language.LanguageSetup(sample_texts=4)
    plain = [(f"text number {i} of many about {'abcdefghij'[i] * 9}", "en") for i in range(10)]
    first = language.train(spark.createDataFrame(plain, "text string, lang string"), setup=setup)
    copied = spark.createDataFrame([x for x in plain for _ in range(6)], "text string, lang string")
    again = language.train(copied, setup=setup)
    assert again.dictionaries == first.dictionaries and first.dictionaries["en"].count(b"text number") == 4
    assert again.texts == {"en": 60}


def test_language_of_hard_rows(spark, hard, nothing):
    model = language.train(hard)
    rows = {r.doc_id: r for r in language.identify(hard.filter("doc_id IS NOT NULL"), model, ["doc_id"]).collect()}
    for i in (0, 1, 2, 3, 6, 7, 16):
        assert rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].rejected
    assert rows[8].lang_pred == "en"
    none = language.train(nothing)
    assert {r.lang_pred for r in language.identify(hard, none, ["doc_id"]).collect()} == {"und"}
    assert language.identify(nothing, model, ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        language.train(
            spark.createDataFrame([(f"text {i}", f"l{i}") for i in range(9)], "text string, lang string"),
            setup=language.LanguageSetup(most_languages=3),
        )


def test_narrow_margins_are_rejected():
    same = b" the cat sat on the mat and the dog ran off "
    model = language.LanguageModel({"a": same, "b": same}, {"a": 1, "b": 5})
    assert model.predict("the cat sat on the mat") == ("b", 0.0, True)


def test_quality_accuracy(tables):
    docs, labels = tables
    model = quality_model.train(docs, labels)
    rows = quality_model.score_quality(docs, model, ["doc_id"]).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([(r.score >= 0.7) == bool(r.quality) for r in held]) > 0.95


def test_dual_coordinate_descent_reaches_the_optimum():
    """The primal objective falls below that of a long subgradient descent."""
    random = np.random.default_rng(3)
    rows = [np.sort(random.choice(40, 8, replace=False)) for _ in range(120)]
    signs = np.where([np.isin(r, range(20)).sum() + random.normal() > 4 for r in rows], 1.0, -1.0)
    scale = random.normal(size=40)
    setup = quality_model.NbsvmSetup(passes=200, penalty=0.5)
    weights, bias = quality_model.dual_coordinate_descent(rows, signs, scale, setup)
    x = np.zeros((120, 41))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / np.sqrt(scale[r] @ scale[r])
        x[i, 40] = 1

    def objective(w):
        return 0.5 * w @ w + setup.penalty * np.maximum(0, 1 - signs * (x @ w)).sum()

    w = np.zeros(41)
    best = objective(w)
    for t in range(1, 20000):
        active = signs * (x @ w) < 1
        w -= (w - setup.penalty * (x[active] * signs[active, None]).sum(axis=0)) / (t + 20)
        best = min(best, objective(w))
    assert objective(np.append(weights, bias)) <= best * 1.001


def test_quality_without_two_classes(spark, hard, nothing):
    labels = spark.createDataFrame([(8, 1), (9, 1)], "doc_id long, quality int")
    for model in (quality_model.train(hard, labels), quality_model.train(nothing, labels.limit(0))):
        rows = quality_model.score_quality(hard, model, ["doc_id"]).collect()
        assert len(rows) == hard.count() and len({r.score for r in rows}) == 1 and 0 < rows[0].score < 1
    assert quality_model.score_quality(nothing, model, ["doc_id"]).collect() == []


def test_toxicity_accuracy(tables):
    docs, labels = tables
    model, label_model, voters = toxicity.train(docs, labels)
    rows = toxicity.score_toxicity(docs, model, ["doc_id"]).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([(r.score >= 0.3) == bool(r.toxic) for r in held]) > 0.9
    assert len(label_model.evidence) == len(voters.names) and label_model.evidence.max() <= 1


def test_label_model_finds_accuracies_and_shares_out_copies(spark):
    random = np.random.default_rng(5)
    truth = random.random(6000) < 0.2
    rates = [(0.02, 0.7), (0.05, 0.6), (0.01, 0.4), (0.1, 0.5)]
    votes = [[random.random() < (hi if t else lo) for lo, hi in rates] for t in truth]
    setup = toxicity.ToxicitySetup(rounds=25)

    def fitted(copies):
        fired = [[i for i, x in enumerate([*v, *[v[0]] * copies]) if x] for v in votes]
        df = spark.createDataFrame([(f,) for f in fired], "fired array<int>").groupBy("fired").agg(F.count("*").alias("n"))
        return toxicity.fit_label_model(df, 4 + copies, 0.2, setup)

    alone, _ = fitted(0)
    assert np.abs(alone.rates - np.array(rates).T).max() < 0.12 and abs(alone.share - 0.2) < 0.1
    model, correlation = fitted(2)  # voter 0 twice more: as if it were there once
    assert np.abs(model.rates[:, :4] - alone.rates).max() < 0.02 and abs(model.share - alone.share) < 0.02
    assert correlation[0, 4] > 0.9 and abs(correlation[0, 1]) < 0.2
    assert model.evidence[0] < 0.5 < model.evidence[1]


def test_toxicity_of_hard_rows(spark, hard, nothing):
    labels = spark.createDataFrame([(8, 0), (9, 0)], "doc_id long, toxic int")
    model, _, _ = toxicity.train(hard, labels)
    rows = toxicity.score_toxicity(hard, model, ["doc_id"]).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    empty, _, _ = toxicity.train(nothing, labels.limit(0))
    assert toxicity.score_toxicity(nothing, empty, ["doc_id"]).collect() == []
    assert {round(r.score, 6) for r in toxicity.score_toxicity(hard, empty, ["doc_id"]).collect()} == {0.1}
