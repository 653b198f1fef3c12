"""Near-duplicate embeddings by NN-descent.

1. *Cells.* Exact copies become one node. Nodes within half of the linking angle of a common centre are
   linked with one another whatever they are, so they become one cell; a group of a million near
   copies is then a few cells, and none of its pairs is ever looked at.
2. *NN-descent* over the centres. Lists of nearest neighbours begin with neighbours in several
   orders along random hyperplanes. In a round the neighbours of each centre, in both
   directions, are compared with each other, unless both are known from an earlier round, and each
   list keeps the nearest. Lists that are full of neighbours close enough to be linked are
   saturated and are doubled. A sample of centres is then compared with all others: below the recall
   asked for, more orders and rounds follow.
3. *Links.* The bounds of two cells decide most pairs of them at once. Single nodes and cells that the
   bounds leave open are compared in double precision, in tiles, and only counts leave a task.
   Centres whose list is saturated even at its largest are compared with all of their component, in
   tiles as well; that is the exact way for what lists cannot hold.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from quern.llm.near_duplicates import components
from quern.llm.text import free_name
from quern.session import bound_batches, materialize, ship_package

#: Angles from 32-bit components are off by less than this.
_SLACK = 2e-3


@dataclass(frozen=True)
class NeighbourSetup:
    """Cosine of a link, and the settings of the search.

    ``neighbours`` is the first length of a list and ``most`` the largest. ``block`` rows that follow
    each other in an order are compared at its start, ``tile`` rows at once with as many in an
    exact comparison. A round with less than ``settled`` new entries per entry is the last. ``audit``
    centres are compared with all others; ``recall`` is what they have to reach, in ``attempts``.
    """

    threshold: float = 0.95
    neighbours: int = 10
    most: int = 160
    block: int = 256
    tile: int = 1024
    rounds: int = 8
    settled: float = 0.02
    audit: int = 256
    recall: float = 0.98
    attempts: int = 4
    miss: float = 0.01

    @property
    def angle(self) -> float:
        return math.acos(self.threshold)

    @property
    def reach(self) -> float:
        """The widest angle between a cell's centre and its members."""
        return self.angle / 2 - _SLACK

    def orders(self, nodes: int) -> int:
        """Orders with which a pair at the threshold is in one block of the first lists but for ``miss``."""
        together = (1 - self.angle / math.pi) ** max(0.0, math.log2(max(nodes, 1) / self.block))
        return max(2, math.ceil(math.log(self.miss) / math.log(1 - min(together, 0.9))))


def _unit(row: object) -> bytes | None:
    """The vector scaled to length one, as 64-bit components; None for one that links with nothing."""
    v = np.asarray(row, np.float64) if row is not None else np.zeros(0)
    if not v.size or not np.isfinite(v).all() or not (top := np.abs(v).max()):
        return None
    v = v / top
    return (v / math.sqrt(float(v @ v)) + 0.0).tobytes()


def _stack(rows: pd.Series, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as rows of a matrix, shorter ones filled up with zeros, and their sizes."""
    sizes = rows.map(len).to_numpy()
    wide = sizes.max()
    if (sizes == wide).all():
        return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1), sizes
    out = np.zeros((len(rows), wide // np.dtype(kind).itemsize), kind)
    for i, r in enumerate(rows):
        out[i, : len(r) // np.dtype(kind).itemsize] = np.frombuffer(r, kind)
    return out, sizes


def _cosines(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Cosines of all rows of both; vectors of different length have none and get -2."""
    (a, m), (b, n) = x, y
    wide = min(a.shape[1], b.shape[1])
    found = a[:, :wide] @ b[:, :wide].T
    if m.min() == m.max() == n.min() == n.max():
        return found
    return np.where(m[:, None] == n[None, :], found, -2.0)


def _in_order(vectors: DataFrame, seed: int, block: int, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` on each ``block`` of rows (``node``, ``vec`` …) that follow each other in a random order of directions.

    The order is that of the signs of projections; rows with the same signs are told apart by
    their node, so that Spark's range partitioning cuts through groups of any size.
    """

    @F.pandas_udf("long")
    def code(vec: pd.Series) -> pd.Series:
        out = np.zeros(len(vec), np.int64)
        sizes = vec.map(len).to_numpy()
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            planes = np.random.default_rng([seed, int(size)]).standard_normal((int(size) // 4, 48), np.float32)
            signs = np.frombuffer(b"".join(vec.iloc[at]), np.float32).reshape(len(at), -1) @ planes > 0
            out[at] = signs @ (np.int64(1) << np.arange(47, -1, -1)) | (int(size) & 0x7FFF) << 48
        return pd.Series(out)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= 2 * block:
                yield run(held.iloc[:block].reset_index(drop=True))
                held = held.iloc[block:].reset_index(drop=True)
        if held is not None and len(held):
            yield run(held.reset_index(drop=True))

    coded = vectors.withColumn("code", code("vec"))
    return coded.repartitionByRange("code", "node").sortWithinPartitions("code", "node").drop("code").mapInPandas(blocks, schema)


def _lead(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """(node, center): each row's first row in the block that it is near enough to."""
    unit = _stack(rows["vec"], np.float32)
    near = _cosines(unit, unit) >= least
    np.fill_diagonal(near, True)
    center = np.full(len(rows), -1)
    crowd = near.sum(axis=1)
    center[crowd == 1] = np.flatnonzero(crowd == 1)
    # Rows with the most neighbours lead first.
    for i in np.argsort(-crowd, kind="stable"):
        if center[i] < 0:
            center[near[i] & (center < 0)] = i
    node = rows["node"].to_numpy()
    return pd.DataFrame({"node": node, "center": node[center]})


@F.pandas_udf(DoubleType())
def _angle(left: pd.Series, right: pd.Series) -> pd.Series:
    """Angle between vectors of 32-bit components of the same length; pi for others."""
    return pd.Series(
        [
            math.acos(min(1.0, float(np.frombuffer(x, np.float32) @ np.frombuffer(y, np.float32)))) if len(x) == len(y) else math.pi
            for x, y in zip(left, right, strict=True)
        ],
        dtype=float,
    )


def cells(nodes: DataFrame, setup: NeighbourSetup) -> DataFrame:
    """(node, center, angle): a cover of all nodes by centres that are at most ``reach`` away.

    Each level looks for leaders among the centres of the level before, in another order; a node
    moves to the leader of its centre if that is near enough to the node itself. Levels end when
    few centres move, so a group of any size is down to a few centres after about as many levels as
    its size has factors of ``tile``.
    """
    least = math.cos(setup.reach)
    vec = nodes.select(F.col("node").alias("center"), F.col("vec").alias("center_vec"))
    found = materialize(_in_order(nodes.select("node", "vec"), 1, setup.tile, lambda x: _lead(x, least), "node long, center long"), "cells")
    for level in range(2, 64):
        heads = materialize(found.select(F.col("center").alias("node")).distinct().join(nodes.select("node", "vec"), "node"), "centers")
        up = _in_order(heads, level, setup.tile, lambda x: _lead(x, least), "node long, center long").filter("node != center")
        up = materialize(up.select(F.col("node").alias("center"), F.col("center").alias("upper")), "moves")
        if up.count() * 50 <= heads.count():
            break
        moving = found.join(up, "center").join(nodes.select("node", "vec"), "node")
        moving = moving.join(vec.withColumnRenamed("center", "upper"), "upper").filter(_angle("vec", "center_vec") <= setup.reach)
        moved = moving.select("node", F.col("upper").alias("moved"))
        found = materialize(found.join(moved, "node", "left").select("node", F.coalesce("moved", "center").alias("center")), "cells")
    measured = found.join(nodes.select("node", "vec"), "node").join(vec, "center")
    own = F.when(F.col("node") == F.col("center"), 0.0).otherwise(_angle("vec", "center_vec"))
    return materialize(measured.select("node", "center", own.alias("angle")), "cells")


def _nearest(offers: DataFrame, centers: DataFrame, setup: NeighbourSetup) -> DataFrame:
    """The lists (a, b, cos, fresh) of the nearest ``k`` offers of each centre."""
    once = offers.groupBy("a", "b").agg(F.max("cos").alias("cos"), F.min(F.col("fresh").cast("int")).alias("fresh"))
    ranked = once.withColumn("rank", F.row_number().over(W.partitionBy("a").orderBy(F.desc("cos"), "b"))).filter(F.col("rank") <= setup.most)
    limits = centers.select(F.col("node").alias("a"), "k")
    return ranked.join(limits, "a").filter("rank <= k").select("a", "b", "cos", (F.col("fresh") == 1).alias("fresh"))


def _top(cos: np.ndarray, allowed: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the allowed entries among the ``k`` largest of each row."""
    masked = np.where(allowed, cos, -3.0)
    most = min(int(k.max()), masked.shape[1])
    best = np.argpartition(-masked, most - 1, axis=1)[:, :most] if most < masked.shape[1] else np.broadcast_to(np.arange(most), masked.shape)
    best = np.take_along_axis(best, np.argsort(-np.take_along_axis(masked, best, 1), axis=1, kind="stable"), 1)
    keep = (np.arange(most)[None, :] < k[:, None]) & (np.take_along_axis(masked, best, 1) > -2.0)
    i, j = np.nonzero(keep)
    return i, best[i, j]


def first_lists(centers: DataFrame, seeds: range, setup: NeighbourSetup) -> DataFrame:
    """Offers (a, b, cos, fresh) from the neighbours in the orders of ``seeds``."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        unit, node = _stack(rows["vec"], np.float32), rows["node"].to_numpy()
        cos = _cosines(unit, unit)
        i, j = _top(cos, ~np.eye(len(rows), dtype=bool), rows["k"].to_numpy())
        return pd.DataFrame({"a": node[i], "b": node[j], "cos": np.round(cos[i, j].astype(float), 6)})

    parts = [_in_order(centers.select("node", "vec", "k"), s, setup.block, compare, "a long, b long, cos double") for s in seeds]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.withColumn("fresh", F.lit(True))


def join_neighbours(lists: DataFrame, centers: DataFrame, setup: NeighbourSetup) -> DataFrame:
    """One round: offers from comparing the neighbours of each centre, in both directions, with each other.

    Of the centres that have one in their list, those of ``most`` are taken that come first by a hash,
    lest a hub should have too many; what this leaves out comes to a later round or to the audit.
    """
    back = lists.select(F.col("b").alias("at"), F.col("a").alias("node"), "fresh")
    by_hash = W.partitionBy("at").orderBy(F.xxhash64("at", "node"), "node")
    back = back.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= setup.most)
    limits = centers.select(F.col("node").alias("at"), "k")
    back = back.join(limits, "at").filter("rank <= k").select("at", "node", "fresh")
    around = lists.select(F.col("a").alias("at"), F.col("b").alias("node"), "fresh").union(back)
    around = around.groupBy("at", "node").agg(F.max("fresh").alias("fresh"))
    worst = lists.groupBy(F.col("a").alias("node")).agg(F.min("cos").alias("worst"), F.count("*").alias("held"))
    known = centers.join(worst, "node", "left").select(
        "node", "vec", "k", F.when(F.col("held") >= F.col("k"), F.col("worst")).otherwise(F.lit(-2.0)).alias("worst")
    )
    dealt = around.join(known, "node").repartition("at").sortWithinPartitions("at", "node")

    def group(part: pd.DataFrame) -> pd.DataFrame | None:
        fresh = part["fresh"].to_numpy(bool)
        if len(part) < 2 or not fresh.any():
            return None
        unit, node = _stack(part["vec"], np.float32), part["node"].to_numpy()
        cos = np.round(_cosines(unit, unit).astype(float), 6)
        allowed = (fresh[:, None] | fresh[None, :]) & (cos > part["worst"].to_numpy()[:, None]) & ~np.eye(len(part), dtype=bool)
        i, j = _top(cos, allowed, part["k"].to_numpy())
        return pd.DataFrame({"a": node[i], "b": node[j], "cos": cos[i, j]}) if i.size else None

    return dealt.mapInPandas(lambda batches: _grouped(batches, ["at"], group), "a long, b long, cos double").withColumn("fresh", F.lit(True))


def _grouped(batches: Iterator[pd.DataFrame], keys: list[str], group: Callable) -> Iterator[pd.DataFrame]:
    """``group`` on each run of rows with equal keys; rows come sorted by them."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        key = batch[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        held = batch.iloc[starts[-1] :]
        out = [x for a, b in zip(starts, starts[1:], strict=False) if (x := group(batch.iloc[a:b])) is not None]
        if out:
            yield pd.concat(out, ignore_index=True)
    if held is not None and (x := group(held)) is not None:
        yield x


def _saturated(lists: DataFrame, centers: DataFrame, widest: float, setup: NeighbourSetup) -> DataFrame:
    """(node): centres whose list is full, and whose last neighbour may still be linked."""
    ends = lists.groupBy(F.col("a").alias("node")).agg(F.min("cos").alias("worst"), F.count("*").alias("held"))
    limit = F.cos(F.least(F.lit(math.pi), F.lit(setup.angle + widest + _SLACK) + F.col("radius")))
    return centers.join(ends, "node").filter((F.col("held") >= F.col("k")) & (F.col("worst") >= limit)).select("node")


def _kept_pairs(lists: DataFrame, centers: DataFrame, setup: NeighbourSetup) -> DataFrame:
    """(a, b, angle): the pairs of centres, a below b, whose cells may hold a link."""
    radius = lambda side: centers.select(F.col("node").alias(side), F.col("radius").alias(f"radius_{side}"), F.col("members").alias(f"members_{side}"))
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos"))))
    once = lists.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), angle.alias("angle"))
    near = once.filter(F.col("angle") <= setup.angle + 2 * setup.reach + _SLACK).groupBy("a", "b").agg(F.min("angle").alias("angle"))
    return near.join(radius("a"), "a").join(radius("b"), "b").filter(
        F.col("angle") <= F.lit(setup.angle + _SLACK) + F.col("radius_a") + F.col("radius_b")
    )


def audit(lists: DataFrame, centers: DataFrame, crowded: DataFrame, setup: NeighbourSetup) -> tuple[int, int]:
    """(pairs found, pairs there are) among those of a sample of centres, by brute force.

    Half of the sample is drawn among all centres, half among those that have a linked neighbour;
    it holds at most ``audit`` centres and is broadcast. Centres that are ``crowded``, with more
    neighbours than the largest list holds, are compared exactly later and left out.
    """
    every = centers.orderBy(F.xxhash64("node", F.lit("audit"))).limit(setup.audit // 2).select("node")
    linked = lists.filter(F.col("cos") >= setup.threshold).select(F.col("a").alias("node")).distinct()
    linked = linked.orderBy(F.xxhash64("node", F.lit("audit"))).limit(setup.audit // 2)
    asked = every.union(linked).distinct().join(crowded, "node", "left_anti").join(centers, "node").select("node", "vec").toPandas()
    if not len(asked):
        return 0, 0
    shared = centers.sparkSession.sparkContext.broadcast(asked)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        left, node = _stack(own["vec"], np.float32), own["node"].to_numpy()
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                other = part["node"].to_numpy()
                cos = _cosines(left, _stack(part["vec"], np.float32))
                i, j = np.nonzero((cos >= setup.threshold) & (node[:, None] != other[None, :]))
                yield pd.DataFrame({"a": node[i], "b": other[j]})

    there = centers.select("node", "vec").mapInPandas(compare, "a long, b long")
    both = lists.select("a", "b").union(lists.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumn("hit", F.lit(1))
    got = there.join(both, ["a", "b"], "left").agg(F.count("*").alias("there"), F.sum("hit").alias("hit")).first()
    return got.hit or 0, got.there


def neighbour_lists(centers: DataFrame, widest: float, setup: NeighbourSetup) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lists, centres with the length of their list, crowded ones), refined until the audit is content."""
    count = centers.count()
    centers = materialize(centers.withColumn("k", F.lit(setup.neighbours)), "centers")
    seeds = range(100, 100 + setup.orders(count))
    lists = materialize(_nearest(first_lists(centers, seeds, setup), centers, setup), "lists")
    for _ in range(setup.attempts):
        left = setup.rounds
        while True:
            left -= 1
            offers = join_neighbours(lists, centers, setup)
            lists = materialize(_nearest(lists.withColumn("fresh", F.lit(False)).unionByName(offers), centers, setup), "lists")
            if left > 0 and lists.filter("fresh").count() > setup.settled * max(lists.count(), 1):
                continue
            full = _saturated(lists, centers.filter(F.col("k") < setup.most), widest, setup)
            full = materialize(full.withColumn("full", F.lit(True)), "full")
            if full.isEmpty():
                break
            k = F.when(F.col("full"), F.least(F.lit(setup.most), F.col("k") * 2)).otherwise(F.col("k"))
            centers = materialize(centers.join(full, "node", "left").withColumn("k", k).drop("full"), "centers")
            again = lists.join(full.withColumnRenamed("node", "a"), "a", "left")
            lists = materialize(again.select("a", "b", "cos", (F.col("fresh") | F.coalesce("full", F.lit(False))).alias("fresh")), "lists")
            left = max(left, 2)
        crowded = materialize(_saturated(lists, centers.filter(F.col("k") >= setup.most), widest, setup), "crowded")
        held, there = audit(lists, centers, crowded, setup)
        if held >= setup.recall * there:
            return lists, centers, crowded
        seeds = range(seeds.stop, 2 * seeds.stop - seeds.start)
        old = lists.withColumn("fresh", F.lit(False))
        lists = materialize(_nearest(old.unionByName(first_lists(centers, seeds, setup)), centers, setup), "lists")
    warnings.warn(f"neighbour lists hold {held} of {there} audited pairs", stacklevel=2)
    return lists, centers, crowded


def _labels(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """(a, b): a spanning set of the links between the cells of the rows and of the columns."""
    cell, at = np.unique(np.r_[left, right], return_inverse=True)
    row, column = at[: len(left)], at[len(left) :]
    label = np.arange(len(cell))
    if near.any():
        i, j = np.nonzero(near)
        pairs = np.unique(np.stack([row[i], column[j]], 1), axis=0)
        while True:
            low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
            new = label.copy()
            np.minimum.at(new, pairs[:, 0], low)
            np.minimum.at(new, pairs[:, 1], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    moved = np.flatnonzero(label != np.arange(len(cell)))
    return pd.DataFrame({"a": cell[label[moved]], "b": cell[moved]})


def _tiles(sides: DataFrame, setup: NeighbourSetup) -> DataFrame:
    """Counts and links from exact comparisons of two sides of a group, in tiles.

    ``sides`` has (group, right, node, cell, vec, copies, tiles, others): ``tiles`` of the row's own
    side and of the other one. Returns (node, n, a, b): for a row the copies it is linked with on
    the other side, or two cells of the group that a chain of links connects.
    """
    own = F.pmod(F.xxhash64("node", "group", "group2"), F.col("tiles")).cast("int")
    dealt = sides.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    pick = lambda side: F.when(F.col("right") == side, F.col("own")).otherwise(F.col("other"))
    dealt = dealt.withColumn("low", pick(False)).withColumn("high", pick(True)).drop("own", "other", "tiles", "others")
    keys = ["group", "group2", "low", "high"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "right", "node")

    def compare(part: pd.DataFrame) -> pd.DataFrame | None:
        side = part["right"].to_numpy(bool)
        cut = int(np.searchsorted(side, True))
        if cut in (0, len(part)):
            return None
        left, right = part.iloc[:cut], part.iloc[cut:]
        near = _cosines(_stack(left["vec"], np.float64), _stack(right["vec"], np.float64)) >= setup.threshold
        if not near.any():
            return None
        n = [near @ right["copies"].to_numpy(), left["copies"].to_numpy() @ near]
        within = bool(part["within"].iat[0])
        counts = pd.DataFrame(
            {"node": np.r_[left["node"], right["node"]][: cut if within else None], "n": np.r_[n[0], n[1]][: cut if within else None]}
        )
        links = _labels(near, left["cell"].to_numpy(), right["cell"].to_numpy())
        out = pd.concat([counts[counts["n"] > 0], links], ignore_index=True)
        return out.astype({c: "Int64" for c in ("node", "n", "a", "b")})

    return dealt.mapInPandas(lambda b: _grouped(b, keys, compare), "node long, n long, a long, b long")


def link_vectors(nodes: DataFrame, setup: NeighbourSetup) -> DataFrame:
    """(node, n_links, comp) of distinct vectors (node, unit, copies): links with all vectors but itself."""
    small = nodes.withColumn("vec", _narrow("unit"))
    small = materialize(small.select("node", "vec"), "small")
    placed = cells(small, setup)
    weighted = placed.join(nodes.select("node", "copies"), "node")
    about = weighted.groupBy("center").agg(
        F.sum("copies").alias("weight"), F.count("*").alias("members"), F.max("angle").alias("radius")
    )
    about = materialize(about.withColumnRenamed("center", "node"), "about")
    widest = about.agg(F.max("radius")).first()[0] or 0.0
    centers = about.join(small, "node").select("node", "vec", "radius", "members", "weight")
    lists, centers, crowded = neighbour_lists(centers, widest, setup)
    pairs = materialize(_kept_pairs(lists, centers, setup), "pairs")

    # What the largest lists cannot hold: all of a component is compared.
    if crowded.isEmpty():
        dense = small.sparkSession.createDataFrame([], "node long, comp long")
    else:
        groups = components(pairs.select("a", "b"))
        dense = materialize(groups.join(groups.join(crowded, "node").select("comp").distinct(), "comp").select("node", "comp"), "dense")
    pairs = pairs.join(dense.select(F.col("node").alias("a")), "a", "left_anti")

    bound = F.col("angle") + F.col("radius_a") + F.col("radius_b")
    single = (F.col("members_a") == 1) & (F.col("members_b") == 1)
    sure = pairs.filter(~single & (bound <= setup.angle - _SLACK)).select("a", "b")
    open_pairs = pairs.filter(~single & (bound > setup.angle - _SLACK)).select("a", "b", "members_a", "members_b")
    unit = lambda side: nodes.select(F.col("node").alias(side), F.col("unit").alias(f"unit_{side}"))
    # A cell of one node has this node as its centre or has kept it when others moved away.
    only = placed.groupBy(F.col("center").alias("cell")).agg(F.min("node").alias("one"))
    ones = lambda side: only.select(F.col("cell").alias(side), F.col("one").alias(f"one_{side}"))
    near = pairs.filter(single).join(ones("a"), "a").join(ones("b"), "b")
    near = near.join(unit("one_a"), "one_a").join(unit("one_b"), "one_b")
    sure = materialize(sure.union(near.filter(_linked(setup.threshold)("unit_one_a", "unit_one_b")).select("a", "b")), "sure")

    member = weighted.join(nodes.select("node", "unit"), "node").select("node", F.col("center").alias("cell"), F.col("unit").alias("vec"), "copies")
    tiles = lambda n: F.ceil(F.col(n) / setup.tile).cast("int")
    columns = ["group", "group2", "right", "within", "node", "cell", "vec", "copies", "tiles", "others"]

    def side(right: bool) -> DataFrame:
        own, other = ("b", "a") if right else ("a", "b")
        of = open_pairs.select(
            F.col("a").alias("group"), F.col("b").alias("group2"), F.lit(right).alias("right"), F.lit(False).alias("within"),
            F.col(own).alias("cell"), tiles(f"members_{own}").alias("tiles"), tiles(f"members_{other}").alias("others"),
        )
        return of.join(member, "cell").select(columns)

    inside = dense.join(member.withColumnRenamed("cell", "center"), dense["node"] == F.col("center")).drop(dense["node"])
    sizes = inside.groupBy("comp").agg(F.count("*").alias("size"))
    inside = inside.join(sizes, "comp").select(
        F.col("comp").alias("group"), F.lit(-1).cast("long").alias("group2"), F.explode(F.array(F.lit(False), F.lit(True))).alias("right"),
        F.lit(True).alias("within"), "node", F.col("center").alias("cell"), "vec", "copies", tiles("size").alias("tiles"), tiles("size").alias("others"),
    )
    exact = materialize(_tiles(side(False).unionByName(side(True)).unionByName(inside), setup), "exact")

    weight = lambda side: about.select(F.col("node").alias(side), "weight")
    by_cell = sure.join(weight("b"), "b").select(F.col("a").alias("center"), "weight")
    by_cell = by_cell.union(sure.join(weight("a"), "a").select(F.col("b").alias("center"), "weight"))
    in_dense = dense.select(F.col("node").alias("center"), F.lit(True).alias("dense"))
    by_cell = by_cell.union(about.select("node", "weight").join(in_dense, F.col("node") == F.col("center"), "left_anti"))
    by_cell = by_cell.groupBy("center").agg(F.sum("weight").alias("n_cell"))
    by_node = exact.filter("node IS NOT NULL").groupBy("node").agg(F.sum("n").alias("n_node"))
    found = components(sure.union(exact.filter("a IS NOT NULL").select("a", "b")).distinct())
    out = placed.join(by_cell, "center", "left").join(by_node, "node", "left").join(found.withColumnRenamed("node", "center"), "center", "left")
    n = F.coalesce("n_cell", F.lit(0)) + F.coalesce("n_node", F.lit(0)) - 1
    return out.select("node", n.alias("n_links"), F.coalesce("comp", "center").alias("comp"))


@F.pandas_udf(BinaryType())
def _narrow(unit: pd.Series) -> pd.Series:
    return unit.map(lambda u: np.frombuffer(u, np.float64).astype(np.float32).tobytes())


def _linked(threshold: float) -> Callable[..., Column]:
    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [len(x) == len(y) and float(np.frombuffer(x) @ np.frombuffer(y)) >= threshold for x, y in zip(left, right, strict=True)], dtype=bool
        )

    return linked


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", setup: NeighbourSetup = NeighbourSetup()) -> DataFrame:
    """(key, n_links, component_id, kept), one row per vector.

    Vectors are linked if their cosine is at least ``threshold``, in double precision; ``n_links``
    counts the other vectors linked directly, ``component_id`` is the smallest key that can be
    reached, ``kept`` whether it is the vector's own. A vector that is NULL, empty, zero or has a NULL
    or non-finite component is linked with nothing, nor are vectors of different length linked. A
    NULL key takes part in no link, its component is NULL and it is kept. Rows that repeat a key
    count as vectors of their own. Of other columns nothing is read, so they may have any name. An
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    bound_batches(spark)

    @F.pandas_udf("binary")
    def scaled(rows: pd.Series) -> pd.Series:
        return rows.map(_unit)

    rows = vectors.select(F.col(key).alias("key"), scaled(F.col(vector).cast("array<double>")).alias("unit"))
    rows = materialize(rows, "vectors")
    sound = rows.filter("unit IS NOT NULL AND key IS NOT NULL")
    nodes = sound.groupBy("unit").agg(F.count("*").alias("copies"), F.min("key").alias("least"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = materialize(link_vectors(nodes.select("node", "unit", "copies"), setup), "found")
    least = found.join(nodes.select("node", "least"), "node").groupBy("comp").agg(F.min("least").alias("component"))
    by_node = found.join(least, "comp").join(nodes.select("node", "unit"), "node").select("unit", "n_links", "component")
    out = rows.withColumn("usable", F.when(F.col("key").isNotNull(), F.col("unit"))).drop("unit")
    out = out.join(by_node, out["usable"] == by_node["unit"], "left")
    own = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"),
    )


def drop_near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", setup: NeighbourSetup = NeighbourSetup()) -> DataFrame:
    """The vectors without those that a smaller key of their component stands for."""
    gone, name = near_vectors(vectors, key, vector, setup).filter("NOT kept"), free_name(vectors.columns, "__gone")
    gone = gone.select(F.col(key).alias(name)).distinct()
    return vectors.join(gone, vectors[key] == gone[name], "left_anti")
