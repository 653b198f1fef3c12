"""The pipeline stage by stage, each against plain loops over what the stage before kept."""

import hashlib
import os
import re

import pytest

import corpus_pipeline
from tests_llm_brute import brute_groups, brute_leaks, brute_mask

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    if not os.path.exists(DATA):
        pytest.skip("driver tables are not here")
    from quern.session import materialize

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], DATA), "stage"))
    return kept


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE encoding and decoding",
    ]
    assert all(df.columns == stages[0].columns for df in stages[1:-1])


def test_quality_keeps_the_good(spark, stages):
    before, after = texts(stages[0]), texts(stages[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    good = [d for d in before if labels.get(d) == 1]
    bad = [d for d in before if labels.get(d) == 0]
    assert sum(d in after for d in good) > 0.98 * len(good)
    assert sum(d in after for d in bad) < 0.1 * len(bad)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    groups = brute_groups(sorted(before.items()), 80)
    assert set(after) == {d for d in before if groups[d] == d}


def test_no_benchmark_item_stays(spark, stages):
    before, after = texts(stages[2]), texts(stages[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(before) - set(after) == {d for d, _ in brute_leaks(before.items(), items)}


def test_personal_data_is_masked(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    changed = 0
    for d, t in before.items():
        if brute_mask(t) == t and not re.search(r"[A-Za-z0-9_-]{24,}", t):
            continue
        changed += after[d] != t
        assert brute_mask(after[d]) == after[d]
    assert changed


def test_tokens_decode_to_the_masked_texts(stages):
    last = {r.doc_id: r for r in stages[5].collect()}
    masked = texts(stages[4])
    assert set(last) == set(masked)
    for d, t in masked.items():
        assert last[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert last[d].n_tokens > 0 or not t


def test_run_is_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in stages[5].collect()}


def test_rows_that_share_an_id_or_have_none_are_dropped_by_row(spark, tmp_path):
    one = " ".join(f"alpha{i}" for i in range(60))
    two, three, four = one.replace("alpha", "beta"), one.replace("alpha", "gamma"), one.replace("alpha", "delta")
    rows = [(None, one), (None, two), (None, two), (5, one), (5, three), (7, four), (7, four), (3, one), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    left = corpus_pipeline.drop_copies(spark, docs, "")
    assert left.columns == docs.columns
    assert got(left) == sorted([(3, one), (None, two), (5, three), (7, four), (9, None)], key=str)
    spark.createDataFrame([(1, one)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert got(left) == sorted([(d, t) for d, t in rows if t != one], key=str)
