import pytest
from pyspark.sql import functions as F

from quern.operators import sampling


def loop_split(n, ratio):
    taken, out = 0, []
    for d in range(1, n + 1):
        if taken / d < ratio:
            taken += 1
        else:
            out.append(d)
    return out


@pytest.mark.parametrize("ratio", ["0.9", "0.8", "0.5", "1.0", "0.85", "0.333", "0"])
def test_ratio_split_equals_the_counter(spark, ratio):
    df = spark.range(300).select(F.lit("s").alias("source"), F.col("id").alias("k"))
    got = sampling.ratio_split(df, "source", "k", ratio)
    validation = sorted(r.k + 1 for r in got.where("split = 'validation'").collect())
    assert validation == loop_split(300, float(ratio))
    assert got.count() == 300


def listing(spark, n):
    return spark.createDataFrame([(f"/c/f{i:03d}",) for i in range(n)], "path string")


def test_sharding_drops_the_last_round(spark):
    got = {r.path: (r.shard, r.file_no) for r in sampling.assign_shards(listing(spark, 10), 4).collect()}
    assert "/c/f008" not in got and "/c/f009" not in got and len(got) == 8
    assert [p for p, (s, _) in sorted(got.items()) if s == 1] == ["/c/f001", "/c/f005"]


@pytest.mark.parametrize("n, parts", [(10, 3), (7, 7), (3, 5), (12, 4)])
def test_even_split_sizes(spark, n, parts):
    got = sampling.split_even(listing(spark, n), parts).orderBy("path").collect()
    small, longer = divmod(n, parts)
    want = [s for s in range(parts) for _ in range(small + (s < longer))]
    assert [r.slice_no for r in got] == want


def test_shuffle_is_seeded_and_independent_of_partitions(spark):
    a = {r.path: r.position for r in sampling.shuffle_files(listing(spark, 40).repartition(1), 5).collect()}
    b = {r.path: r.position for r in sampling.shuffle_files(listing(spark, 40).repartition(7), 5).collect()}
    c = {r.path: r.position for r in sampling.shuffle_files(listing(spark, 40), 6).collect()}
    assert a == b != c
    assert sorted(a.values()) == list(range(40))


@pytest.mark.parametrize("percentage, ratio, want", [(0.5, 1.0, 10), (0.45, 0.9, 10), (0.9, 0.5, 20), (0.125, 1.0, 2)])
def test_subsample_counts(spark, percentage, ratio, want):
    assert sampling.subsample_files(listing(spark, 20), percentage, ratio).count() == want


def test_limit(spark):
    assert [r.path for r in sampling.limit_files(listing(spark, 9), 2).collect()] == ["/c/f000", "/c/f001"]


def chunk_rows(spark, shards=2, files=5):
    data = [
        (s, f, files, [s * 10_000 + f * 100 + i for i in range(10)]) for s in range(shards) for f in range(files)
    ]
    return spark.createDataFrame(data, "shard long, file_no long, files_in_shard long, tokens array<int>")


def test_block_shuffle_is_a_permutation_of_complete_runs(spark):
    got = sampling.shuffle_blocks(chunk_rows(spark), 2, 3, 10, seed=9).collect()
    assert len(got) == 2 * 2 * 2 * 3  # shards, runs, chunks, blocks
    for shard in (0, 1):
        for run in (0, 1):
            mine = sorted((r.position, r.tokens[0]) for r in got if (r.shard, r.run_no) == (shard, run))
            assert [p for p, _ in mine] == list(range(6))
            starts = {shard * 10_000 + (2 * run + f) * 100 + b * 3 for f in (0, 1) for b in range(3)}
            assert {t for _, t in mine} == starts
    # All shards share the permutation of a run; runs differ from each other.
    order = lambda s, g: [r.tokens[0] % 10_000 - 200 * g for r in sorted(got, key=lambda r: r.position) if (r.shard, r.run_no) == (s, g)]
    assert order(0, 0) == order(1, 0)


def test_epochs_reshuffle(spark):
    got = sampling.shuffle_blocks(sampling.repeat_epochs(chunk_rows(spark, 1), 3), 4, 2, 10, seed=1).collect()
    orders = {e: [r.tokens[0] for r in sorted(got, key=lambda r: r.position) if r.epoch == e] for e in range(3)}
    assert sorted(orders[0]) == sorted(orders[1]) == sorted(orders[2])
    assert len({tuple(o) for o in orders.values()}) == 3


def test_mix_ends_with_the_first_exhausted_dataset(spark):
    a = spark.range(200).select("id", F.lit("a").alias("name"))
    b = spark.range(1000, 1030).select("id", F.lit("b").alias("name"))
    got = sorted(sampling.mix([a, b], "id", [0.5, 0.5], seed=3).collect())
    assert [r.draw_no for r in got] == list(range(len(got)))
    for name, first in (("a", 0), ("b", 1000)):
        ids = [r.id for r in got if r.name == name]
        assert ids == list(range(first, first + len(ids)))
    assert sum(r.name == "b" for r in got) == 30
    again = sorted(sampling.mix([a.repartition(5), b], "id", [0.5, 0.5], seed=3).collect())
    assert got == again


def test_mix_rejects_bad_weights(spark):
    a = spark.range(3)
    with pytest.raises(ValueError):
        sampling.mix([a, a], "id", [1.0])


def test_mix_runs_no_job_while_it_is_built(spark):
    context = spark.sparkContext
    context.setJobGroup("mix", "building")
    a, b = spark.range(500), spark.range(1000, 1100)
    df = sampling.mix([a, b], "id", [0.5, 0.5], seed=3)
    assert not context.statusTracker().getJobIdsForGroup("mix")
    context.setJobGroup("other", "running")
    assert df.where("dataset = 1").count() == 100


def test_mix_with_an_empty_dataset_ends_at_its_first_draw(spark):
    a, none = spark.range(50), spark.range(0)
    got = sampling.mix([a, none], "id", [0.5, 0.5], seed=1).collect()
    assert sorted(r.draw_no for r in got) == list(range(len(got))) and len(got) < 50
    assert sampling.mix([none, none], "id", seed=1).collect() == []
