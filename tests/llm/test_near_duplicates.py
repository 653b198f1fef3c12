import random

import numpy as np

from quern.llm.near_duplicates import (
    NearSetup,
    components,
    drop_near_duplicates,
    near_duplicates,
    shingle_set,
    signature,
)

SPACE = b" \t\n\x0b\x0c\r"


def sets_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\x0b\x0c\r":
        low = low.replace(s, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent=85):
    """Smallest reachable id of each id, all pairs compared."""
    sets = [(d, sets_of(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, s) in enumerate(sets):
        for j in range(i):
            e, u = sets[j]
            if d is not None and e is not None and s and u and 100 * len(s & u) >= percent * len(s | u):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), None if d is None else least[find(i)]) for i, (d, s) in enumerate(sets)]


def check(df, rows, percent=85, setup=NearSetup()):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df, setup=setup).collect()), key=str)
    assert got == sorted(brute(rows, percent), key=str)


def test_same_groups_as_all_pairs(documents):
    check(documents, [(r.doc_id, r.text) for r in documents.collect()])


def edited(base, share, rng):
    words = list(base)
    for i in rng.sample(range(len(words)), int(share * len(words))):
        words[i] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def test_large_groups_in_small_tiles(spark):
    """Edits of one text at all similarities around the threshold; tiles far smaller than the group."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(base, rng.choice([0.0, 0.005, 0.01, 0.013, 0.016, 0.02, 0.03, 0.05]), rng)) for i in range(150)]
    rows += [(200 + i, edited([f"v{i}_{k}" for k in range(60)], 0, rng)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert len({c for _, _, c in expected}) > 50 and sum(c == 0 for _, _, c in expected) > 20
    for setup in (NearSetup(), NearSetup(tile=16), NearSetup(tile=7, broadcast_rows=0)):
        check(df, rows, setup=setup)
    check(df, rows, 80, NearSetup(percent=80))


def test_border(spark):
    rows = []
    for n in (20, 40, 100):  # of n shingles k are shared at the end
        for k in range(n - 6, n + 1):
            a = [f"a{n}_{k}_{i}" for i in range(n + 4)]
            b = [f"b{n}_{k}_{i}" for i in range(n - k)] + a[n - k :]
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b).upper())]
    rows = list(enumerate(t for _, t in rows))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_components_of_a_long_chain(spark):
    order = list(range(400))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(1000, 1001)], "a long, b long")
    got = {r.node: r.comp for r in components(edges).collect()}
    assert got == {i: 0 for i in range(400)} | {1000: 1000, 1001: 1000}
    assert components(edges.limit(0)).collect() == []


def test_pruning_keeps_the_miss_probability():
    setup = NearSetup()
    rng = np.random.default_rng(2)
    for n, least in zip(range(setup.batch, setup.hashes + 1, setup.batch), setup.least_matches, strict=True):
        matches = rng.binomial(n, setup.match, 200_000)
        assert (matches < least).mean() < 1e-4
        assert least > 0.5 * n
    assert (1 - setup.match**setup.band_rows) ** (setup.hashes // setup.band_rows) <= setup.miss


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.9):
        both = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
        k = int(2000 * share)
        a, b = both[:2000], np.r_[both[:k], rng.integers(0, 1 << 63, 2000 - k, dtype=np.uint64)]
        equal = np.mean(np.frombuffer(signature(a, 384), np.uint8) == np.frombuffer(signature(b, 384), np.uint8))
        true = k / (4000 - k)
        assert abs(equal - (true + (1 - true) / 256)) < 0.1
    assert shingle_set("A b\tC").size == 1 and shingle_set("a b c") == shingle_set(" A B C ")


def test_hard_rows(hard, nothing):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    check(hard, rows)
    assert all(r.kept for r in near_duplicates(hard).collect() if r.doc_id is None)
    assert near_duplicates(nothing).collect() == []
    left = drop_near_duplicates(hard)
    assert left.columns == hard.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {9, 10}
