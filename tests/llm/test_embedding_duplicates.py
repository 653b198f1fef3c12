"""Near-duplicate embeddings against all pairs of a small table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm.embedding_duplicates import NeighbourSetup, drop_near_vectors, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, node long"


def unit(v):
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def fixture_rows():
    """Random vectors, tight and wide groups, a chain, exact copies, and vectors that link with nothing."""
    random = np.random.default_rng(7)
    far = unit(random.standard_normal((300, 24)))
    tight = unit(far[0] + 0.01 * random.standard_normal((150, 24)))
    wide = unit(far[1] + 0.045 * random.standard_normal((120, 24)))
    edge = unit(far[2] + 0.07 * random.standard_normal((80, 24)))
    plane = [far[3] * np.cos(t) + unit(far[4] - far[3] * (far[3] @ far[4])) * np.sin(t) for t in np.arange(0, 3, 0.25)]
    copies = [far[5]] * 40 + [far[6] * 3.5] * 3
    good = [*far, *tight, *wide, *edge, *plane, *copies, unit(far[7] + 0.005 * far[8]) * 1e20]
    rows = [[float(x) for x in v] for v in good]
    rows += [None, [], [0.0] * 24, [None, *rows[0][1:]], [float("nan"), *rows[0][1:]], [float("inf"), *rows[0][1:]], rows[0][:12], rows[0][:12], [*rows[0], 0.0]]
    ids = random.permutation(len(rows))
    out = [(int(i) + 10, v, None, "x", 1) for i, v in zip(ids, rows, strict=True)]
    return [*out, (None, rows[0], 0, None, None), (None, None, None, None, None), (out[1][0], rows[1], 1, None, None), (out[1][0], rows[200], 1, None, None)]


def by_pairs(rows, threshold=0.95):
    vec = []
    for key, v, *_ in rows:
        a = np.array(v if v else [0.0], np.float32).astype(float) if v is None or None not in v else np.zeros(1)
        sound = key is not None and np.isfinite(a).all() and np.abs(a).max() > 0
        vec.append(a if sound else None)
    keys = [r[0] for r in rows]
    up = list(range(len(rows)))
    n = [0] * len(rows)
    find = lambda i: i if up[i] == i else find(up[i])
    for i, a in enumerate(vec):
        for j in range(i):
            b = vec[j]
            if a is None or b is None or len(a) != len(b):
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                n[i] += 1
                n[j] += 1
                up[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted((repr(k), n[i], repr(least[find(i)] if k is not None else None)) for i, k in enumerate(keys))


@pytest.mark.parametrize("setup", [NeighbourSetup(), NeighbourSetup(neighbours=4, most=8, block=32, tile=48, audit=64)], ids=["usual", "small"])
def test_against_all_pairs(spark, setup):
    """With small lists the wide groups are saturated at the largest length and compared in tiles."""
    rows = fixture_rows()
    found = near_vectors(spark.createDataFrame(rows, SCHEMA), setup=setup).collect()
    assert sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in found) == by_pairs(rows)
    assert all(r.kept == (r.component_id is None or r.vec_id == r.component_id) for r in found)


def test_a_large_group_of_near_copies_becomes_few_cells(spark):
    from quern.llm.embedding_duplicates import _narrow, _unit, cells

    random = np.random.default_rng(3)
    base = unit(random.standard_normal(64))
    group = unit(base + 0.008 * random.standard_normal((5000, 64)))
    nodes = spark.createDataFrame([(i, _unit(v)) for i, v in enumerate(group)], "node long, unit binary").withColumn("vec", _narrow("unit"))
    setup = NeighbourSetup(tile=256)
    found = cells(nodes.select("node", "vec"), setup)
    assert found.count() == 5000 and found.select("center").distinct().count() <= 12
    assert found.agg(F.max("angle")).first()[0] <= setup.reach


def test_empty_table_and_dropping(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert near_vectors(nothing).collect() == []
    rows = [(1, [1.0, 0.0], 0, "a", 1), (2, [1.0, 0.01], 0, "b", 2), (3, [0.0, 1.0], 0, "c", 3), (None, [1.0, 0.0], 0, "d", 4)]
    assert {r.vec_id for r in drop_near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()} == {1, 3, None}


def test_whole_table_of_the_smallest_scale(spark):
    import os

    path = "/root/testdata/sf0.001/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("driver tables are not here")
    table = spark.read.parquet(path)
    rows = [tuple(r)[:2] for r in table.collect()]
    found = near_vectors(table).collect()
    assert sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in found) == by_pairs(rows)
