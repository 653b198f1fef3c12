import random

import pytest
from pyspark.sql import functions as F

from quern.operators import ordered


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK_BITS", 3)


def rows(seed=1, n=900):
    """One group holds a third of all rows; keys are sparse and unordered."""
    rng = random.Random(seed)
    keys = rng.sample(range(50_000), n)
    return [(("hot" if i % 3 == 0 else f"g{rng.randrange(12)}"), k, rng.randrange(0, 9)) for i, k in enumerate(keys)]


def expected(data):
    out, groups = {}, {}
    for g, k, v in sorted(data):
        before, n = groups.get(g, (0, 0))
        out[(g, k)] = (before, n)
        groups[g] = (before + v, n + 1)
    return out, {g: n for g, (_, n) in groups.items()}


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_and_ordinals_do_not_depend_on_partitioning(spark, parts):
    data = rows()
    df = spark.createDataFrame(data, "g string, k long, v int").repartition(parts)
    got = ordered.ordered_sums(df, "g", "k", {"before": F.col("v"), "idx": F.lit(1)}, {"idx": "n"}).collect()
    want, sizes = expected(data)
    assert {(r.g, r.k): (r.before, r.idx) for r in got} == want
    assert all(r.n == sizes[r.g] for r in got)
    assert len(got) == len(data)


def test_string_keys_use_range_blocks(spark):
    paths = [f"/d/{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(5)
    got = {r.path: (r.at, r.n) for r in ordered.with_ordinal(df, [], "path", "at", total="n").collect()}
    assert got == {p: (i, 1000) for i, p in enumerate(sorted(paths))}


def test_offsets(spark):
    df = spark.createDataFrame([("a", 5, 3), ("a", 1, 2), ("b", 9, 4), ("a", 7, 0)], "g string, k long, n int")
    got = {(r.g, r.k): (r.start, r.end) for r in ordered.with_offsets(df, "g", "k", "n").collect()}
    assert got == {("a", 1): (0, 2), ("a", 5): (2, 5), ("a", 7): (5, 5), ("b", 9): (0, 4)}


def test_hash_order_blocks_follow_the_key(spark):
    df = spark.range(500).withColumn("key", ordered.seeded_key(3, "id"))
    got = ordered.with_ordinal(df, [], ["key", "id"], "at", block=ordered.seeded_block(F.col("key"))).collect()
    assert [r.at for r in sorted(got, key=lambda r: r.key)] == list(range(500))


def test_oversized_groups_take_the_blocked_plan(spark, monkeypatch):
    df = spark.createDataFrame(rows(), "g string, k long, v int")
    assert ordered.oversized_groups(df, "g") is None
    monkeypatch.setattr(ordered, "GROUP_ROWS", 100)
    seen = ordered.by_group_size(
        df, "g", lambda d: d.withColumn("plan", F.lit("whole")), lambda d: d.withColumn("plan", F.lit("blocked"))
    )
    got = {(r.g, r.plan) for r in seen.select("g", "plan").distinct().collect()}
    assert {g for g, plan in got if plan == "blocked"} == {"hot"}
    assert seen.count() == 900


def test_positions_over_all_rows(spark, tmp_path):
    """Of two text keys, for any number of ranges; the rows are written once and not shuffled again."""
    rows = [(-(i % 7), f"w{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "least long, token string").repartition(5)
    want = {r: n for n, r in enumerate(sorted(rows))}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = ordered.with_position(df, ["least", "token"], "rank")
            assert got.columns == ["least", "token", "rank"] and {(r.least, r.token): r["rank"] for r in got.collect()} == want
            assert ordered.with_position(df.limit(0), ["least", "token"], "rank").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
