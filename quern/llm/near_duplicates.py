"""Near-duplicates by MinHash with sequential Bayesian verification.

A document's set of word shingles is hashed into a signature of one-byte MinHash values. Bands of
the signature bring candidates together. Signatures of candidates are compared batch by batch; a
pair is dropped as soon as the posterior probability that it reaches the threshold falls below
the chosen miss probability. What survives is verified on the full shingle sets.

Large groups of similar documents have a number of pairs that grows with the square of their
size, so pairs are never listed. A bucket of a band is cut into tiles; a task compares two tiles
in memory. In the first pass each document keeps its most similar survivors only, which joins
nearly all that belongs together. In the second pass the tasks have the full sets too and return
a spanning forest of the verified links between components. No link between components can be missing after that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import bound_batches, materialize, ship_package

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MATCHES = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class NearSetup:
    """Threshold in percent, words per shingle, and the settings of the search.

    ``miss`` is the probability with which a pair at the threshold may be missed by all bands,
    and with which a pair may be pruned though it reaches the threshold. ``tile`` is the number
    of signatures on one side of a comparison in memory. Sets of at most ``broadcast_rows``
    documents are fetched by a broadcast of their ids, of more by a join.
    """

    percent: int = 85
    width: int = 5
    hashes: int = 384
    batch: int = 64
    miss: float = 1e-6
    tile: int = 1024
    broadcast_rows: int = 1_000_000
    rounds: int = 64

    @cached_property
    def match(self) -> float:
        """Probability that one-byte values of a pair at the threshold are equal."""
        s = self.percent / 100
        return s + (1 - s) / 256

    @cached_property
    def band_rows(self) -> int:
        """The most values per band with which the miss probability is kept."""
        fitting = [r for r in range(1, 17) if (1 - self.match**r) ** (self.hashes // r) <= self.miss]
        return max(fitting, default=1)

    @cached_property
    def least_matches(self) -> list[int]:
        """For each batch end n, the least matches m with which a pair goes on.

        With a uniform prior the similarity has the posterior Beta(m + 1, n - m + 1), and the
        probability that it is t or more equals that of at most m successes of n + 1 with rate t.
        """
        out = []
        for n in range(self.batch, self.hashes + 1, self.batch):
            total, m = 0.0, -1
            while total < self.miss:
                m += 1
                total += comb(n + 1, m) * self.match**m * (1 - self.match) ** (n + 1 - m)
            out.append(m)
        return out


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text.

    A-Z are lower-cased; words are separated by ASCII white space. Fewer words than a shingle
    are one shingle; without words the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1 + len(words))], np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    mixed = h[:n].copy()
    for i in range(1, width):
        mixed = mixed * _STEP + h[i : i + n]
    mixed = (mixed ^ (mixed >> np.uint64(30))) * _MATCHES
    return np.unique(mixed ^ (mixed >> np.uint64(31)))


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    a = random.integers(0, 1 << 63, hashes, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    return a[:, None], random.integers(0, 1 << 63, hashes, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, hashes: int) -> bytes:
    """One byte of each of ``hashes`` MinHash values."""
    a, b = _coefficients(hashes)
    least = np.full(hashes, np.iinfo(np.uint64).max)
    for i in range(0, shingles.size, 256):
        least = np.minimum(least, (a * shingles[None, i : i + 256] + b).min(axis=1))
    # The least value's high bits are near zero for large sets: mix before taking a byte.
    least = (least ^ (least >> np.uint64(30))) * _MATCHES
    return (least >> np.uint64(56)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame, key: str, text: str, setup: NearSetup) -> DataFrame:
    """(key, n_shingles, node, sig): ``node`` identifies the set; NULL for an empty one."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("n long, node long, sig binary")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch:
                s = shingle_set(t, setup.width)
                node = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if s.size else None
                out.append((s.size, node, signature(s, setup.hashes) if s.size else None))
            frame = pd.DataFrame(out, columns=["n", "node", "sig"])
            yield frame.assign(node=pd.array([r[1] for r in out], dtype="Int64"))

    found = docs.select(F.col(key).alias("key"), sketch(F.col(text)).alias("s"))
    return found.select("key", F.col("s.n").alias("n_shingles"), F.col("s.node").alias("node"), F.col("s.sig").alias("sig"))


def bucket_members(nodes: DataFrame, setup: NearSetup) -> DataFrame:
    """(bucket, band, node, tiles): the members of all buckets of two nodes or more."""
    rows = setup.band_rows
    bands = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(setup.hashes // rows - 1))).alias("band"))
    keyed = bands.select(
        F.xxhash64("band", F.substring("sig", F.col("band") * rows + 1, F.lit(rows))).alias("bucket"), "band", "node"
    )
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    tiles = F.ceil(F.col("m") / setup.tile).cast("int")
    return keyed.join(crowded, "bucket").select("bucket", "band", "node", tiles.alias("tiles"))


def _survivors(
    left: np.ndarray, right: np.ndarray, band: int, within: bool, setup: NearSetup
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows that pass every batch, and their numbers of matching values.

    A pair that meets in several bands is reported in the first alone. ``within`` is for a tile
    against itself. A few rows at a time are compared with all others, so memory stays small.
    """
    step, rows = setup.batch, setup.band_rows
    found = []
    for at in range(0, len(left), 64):
        part = left[at : at + 64]
        counts = (part[:, None, :step] == right[None, :, :step]).sum(axis=2, dtype=np.int16)
        i, j = np.nonzero(counts >= setup.least_matches[0])
        if within:
            i, j = i[i + at < j], j[i + at < j]
        m = counts[i, j].astype(np.int64)
        for k, least in enumerate(setup.least_matches[1:], 1):
            if not i.size:
                break
            m = m + (part[i, k * step : (k + 1) * step] == right[j, k * step : (k + 1) * step]).sum(axis=1)
            i, j, m = i[m >= least], j[m >= least], m[m >= least]
        if i.size and band:
            same = (part[i, : band * rows] == right[j, : band * rows]).reshape(len(i), band, rows)
            new = ~same.all(axis=2).any(axis=1)
            i, j, m = i[new], j[new], m[new]
        found.append((i + at, j, m))
    i, j, m = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j, m


def _compare(members: DataFrame, signed: DataFrame, setup: NearSetup, choose: Callable, schema: str) -> DataFrame:
    """Compare all members of each bucket in memory, two tiles at a time.

    ``members`` has a ``comp`` column, ``signed`` the signature of each node and its set, which may
    be NULL. ``choose`` gets the nodes, components and sets of both sides of the surviving pairs,
    and their matches, and returns the rows to keep.
    """
    tile = F.pmod(F.xxhash64("node", "bucket"), F.col("tiles")).cast("int")
    placed = members.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.select(
        "bucket", "band", "node", "tile", "comp",
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
    )
    dealt = placed.join(signed.select("node", "sig", "shingles"), "node").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "tile", "node")

    def group(part: pd.DataFrame) -> pd.DataFrame | None:
        sig = np.frombuffer(b"".join(part["sig"]), np.uint8).reshape(len(part), setup.hashes)
        node, comp, tiles = part["node"].to_numpy(), part["comp"].to_numpy(), part["tile"].to_numpy()
        sets = part["shingles"].to_numpy()
        cut = int(np.searchsorted(tiles, tiles[0], side="right"))
        within = part["low"].iat[0] == part["high"].iat[0]
        if not within and cut == len(part):
            return None  # the other tile is empty
        a, b = (slice(None), slice(None)) if within else (slice(0, cut), slice(cut, None))
        i, j, m = _survivors(sig[a], sig[b], int(part["band"].iat[0]), within, setup)
        return choose(node[a][i], node[b][j], comp[a][i], comp[b][j], sets[a][i], sets[b][j], m) if i.size else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            key = batch[["bucket", "low", "high"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
            held = batch.iloc[starts[-1] :]
            out = [x for a, b in zip(starts, starts[1:], strict=False) if (x := group(batch.iloc[a:b])) is not None]
            if out:
                yield pd.concat(out, ignore_index=True)
        if held is not None and (x := group(held)) is not None:
            yield x

    return dealt.mapInPandas(run, schema)


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, comp): the least node that can be reached, for every node of an edge (a, b).

    Every node has a parent, at first the least of its neighbours and itself. In a round each
    edge offers the grandparent at its other end both to its node and to its node's parent, and
    every node moves up to its own grandparent; each takes the least offer. Trees are hooked on to
    each other and flattened at once, so the number of rounds grows with the logarithm of a
    chain's length. Parents are tables; no component is ever in one task.
    """
    both = materialize(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    parents = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("up")), "parents")
    for _ in range(rounds):
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
        tops = materialize(parents.join(above, "up").select("node", "up", "top"), "parents")
        offers = both.join(tops.select(F.col("node").alias("b"), "top"), "b").groupBy(F.col("a").alias("node")).agg(F.min("top").alias("offer"))
        offered = tops.join(offers, "node")
        each = F.array(
            F.struct("node", F.least("offer", "top", "up").alias("up")), F.struct(F.col("up").alias("node"), F.col("offer").alias("up"))
        )
        moved = offered.select(F.explode(each).alias("x")).groupBy("x.node").agg(F.min("x.up").alias("up"))
        moved = materialize(moved.join(parents.withColumnRenamed("up", "old"), "node"), "parents")
        parents = moved.select("node", "up")
        if moved.filter("up != old").isEmpty():
            return parents.select("node", F.col("up").alias("comp"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _sets(asked: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, setup: NearSetup) -> DataFrame:
    """(node, shingles): the full sets of the nodes asked for, as a table."""
    owners = materialize(asked.distinct().join(nodes.select("node", "rep"), "node"), "owners")
    few = owners.count() <= setup.broadcast_rows
    body = docs.select(F.col(key).alias("rep"), F.col(text).alias("text"))
    wanted = body.join(F.broadcast(owners) if few else owners, "rep")

    @F.pandas_udf("node long, shingles binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, setup.width).tobytes() for t in batch]
            yield pd.DataFrame({"node": [xxhash.xxh3_64_intdigest(s) - (1 << 63) for s in sets], "shingles": sets})

    # Rows that share the key but not the text are told apart by their node. The function counts as
    # not deterministic, lest Spark should make the comparison a join key and encode all documents.
    coded = wanted.select("node", encode.asNondeterministic()("text").alias("s")).filter("node = s.node")
    return materialize(coded.select("node", "s.shingles").dropDuplicates(["node"]), "sets")


def _linked(left: bytes, right: bytes, percent: int) -> bool:
    """Whether two full sets reach the threshold."""
    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    # No intersection can be larger than the smaller set.
    if 100 * min(x.size, y.size) < percent * max(x.size, y.size):
        return False
    both = np.intersect1d(x, y, assume_unique=True).size
    return 100 * both >= percent * (x.size + y.size - both)


def _verified(pairs: DataFrame, sets: DataFrame, setup: NearSetup) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([_linked(x, y, setup.percent) for x, y in zip(left, right, strict=True)], dtype=bool)

    of = lambda side: sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(linked("set_a", "set_b")).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", setup: NearSetup = NearSetup()) -> DataFrame:
    """(key, n_shingles, component_id, kept), one row per document.

    Documents whose sets have at least ``percent`` of their union in common are linked;
    ``component_id`` is the smallest key that can be reached by links, ``kept`` whether it is the
    document's own. Documents without words are linked with nothing. A NULL key takes part in no
    link, its component is NULL and it is kept. Rows that repeat a key are each returned; texts of
    the same key are linked like others. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession, mb=8)
    sketched = materialize(sketches(docs, key, text, setup), "sketches")
    nodes = materialize(
        sketched.filter("node IS NOT NULL AND key IS NOT NULL").groupBy("node").agg(F.min("key").alias("rep"), F.first("sig").alias("sig")),
        "nodes",
    )
    members = materialize(bucket_members(nodes, setup), "members")

    def nearest(a, b, _ca, _cb, _sa, _sb, m) -> pd.DataFrame:
        one = pd.DataFrame({"node": np.r_[a, b], "other": np.r_[b, a], "matches": np.r_[m, m].astype(np.int64)})
        one = one.sort_values(["matches", "other"], ascending=[False, True])
        return one.groupby("node", sort=False).head(2)

    def crossing(a, b, ca, cb, sa, sb, _m) -> pd.DataFrame:
        at, up = [], {}

        def top(c: int) -> int:
            while (above := up.get(c, c)) != c:
                up[c] = c = up.get(above, above)
            return c

        # Links that join nothing new are neither verified nor returned: a spanning forest is enough.
        for i in np.flatnonzero(ca != cb).tolist():
            x, y = top(int(ca[i])), top(int(cb[i]))
            if x != y and _linked(sa[i], sb[i], setup.percent):
                up[max(x, y)] = min(x, y)
                at.append(i)
        return pd.DataFrame({"a": np.minimum(a, b)[at], "b": np.maximum(a, b)[at]})

    signed = nodes.select("node", "sig", F.lit(None).cast("binary").alias("shingles"))
    best = _compare(members.withColumn("comp", F.col("node")), signed, setup, nearest, "node long, other long, matches long")
    first = best.groupBy("node").agg(F.max(F.struct("matches", "other")).alias("x"))
    pairs = materialize(
        first.select(F.least("node", "x.other").alias("a"), F.greatest("node", "x.other").alias("b")).distinct(), "pairs"
    )
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    links = materialize(_verified(pairs, _sets(asked, nodes, docs, key, text, setup), setup), "links")
    found = components(links, setup.rounds)

    known = members.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    known = materialize(known, "members")
    open_buckets = known.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("bucket")
    # Documents of one group may have very many pairs just below the threshold. They are verified
    # where they are found, so that only links leave the task.
    still = materialize(known.join(open_buckets, "bucket", "left_semi"), "members")
    sets = _sets(still.select("node"), nodes, docs, key, text, setup)
    more = materialize(_compare(still, nodes.join(sets, "node"), setup, crossing, "a long, b long"), "links")
    final = components(links.unionByName(more), setup.rounds)

    placed = sketched.select("key", "n_shingles", "node").join(final, "node", "left")
    placed = placed.withColumn("comp", F.coalesce("comp", "node"))
    least = placed.filter("node IS NOT NULL AND key IS NOT NULL").groupBy("comp").agg(F.min("key").alias("component"))
    own = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return placed.join(least, "comp", "left").select(
        F.col("key").alias(key),
        F.col("n_shingles"),
        own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", setup: NearSetup = NearSetup()) -> DataFrame:
    """The documents without those that a smaller key of their group stands for."""
    gone = near_duplicates(docs, key, text, setup).filter("NOT kept").select(F.col(key).alias("__gone")).distinct()
    return docs.join(gone, docs[key] == gone["__gone"], "left_anti")
