"""A smoothed bigram model whose counts live in a log-frequency Bloom filter.

A count c has the level 1 + floor(log2 c). For every level up to its own, an n-gram is put into
that level's bit array; its count is read back by probing the levels upwards until one is empty.
Bit arrays are cut into segments by the n-gram's hash, so that Spark counts and fills them
independently. The filter is broadcast; scoring needs nothing but probes.

What is broadcast has a fixed bound. If all levels together are larger, nothing is broadcast: the
distinct n-grams of a batch of texts go to their segments, are probed there on all levels, and their
levels come back to the batch. Both ways give the same levels.

Levels are read once: they are one byte for a token and one for a pair, from which both the weights
and the scores follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import bound_batches, materialize, ship_package

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: No word has a space, so the end of a text cannot be one.
_END = xxhash.xxh3_64_intdigest(b" end ")


@dataclass(frozen=True)
class LmSetup:
    """Bits per entry, probes, and the bounds of what is broadcast and held by one task.

    ``filter_bytes`` bounds the broadcast bit arrays and ``vocabulary`` the broadcast words with their exact
    counts; beyond either, n-grams are probed by segment. ``segment_chars`` is the text per segment, ``run`` the
    number of neighbouring segments that one task holds, and ``batch_chars`` the text whose n-grams a task holds at once.
    """

    bits: int = 10
    probes: int = 7
    filter_bytes: int = 1 << 27
    vocabulary: int = 8_000_000
    segment_chars: int = 1 << 23
    run: int = 8
    batch_chars: int = 1 << 23
    add: float = 0.1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def token_keys(text: str | None) -> np.ndarray:
    """64-bit keys of the words of a whole text, A-Z lower-cased, and of its end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    keys = np.empty(len(words) + 1, np.uint64)
    keys[:-1] = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    keys[-1] = _END
    return keys


def pair_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of neighbouring tokens, one fewer than tokens, of 48 bits each."""
    x = keys[:-1] * _A + (keys[1:] ^ _B)
    x = (x ^ (x >> np.uint64(29))) * _B
    return x >> np.uint64(16)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]  # 1 + floor(log2 c)


def expected(levels: np.ndarray) -> np.ndarray:
    """Mean count of a level's range; 0 at level 0."""
    return np.where(levels > 0, (np.exp2(levels - 1.0) + np.exp2(levels) - 1) / 2, 0.0)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segment of each key; it does not fall as the keys of pairs rise."""
    return (((keys >> np.uint64(16)) & np.uint64(0xFFFFFFFF)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _start_and_step(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (keys ^ (keys >> np.uint64(23))) * _B
    x ^= x >> np.uint64(32)
    return x * _A, x * _B | np.uint64(1)


def bit_array(keys: np.ndarray, setup: LmSetup) -> bytes:
    size = -(-keys.size * setup.bits // 8) * 8
    full = np.zeros(size, bool)
    at, step = _start_and_step(keys)
    for _ in range(setup.probes):
        full[(at >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)] = True
        at += step
    return np.packbits(full).tobytes()


def has(array: np.ndarray, keys: np.ndarray, setup: LmSetup, begin: np.ndarray | None = None, size: np.ndarray | None = None) -> np.ndarray:
    """Which keys are in a bit array, false positives included.

    With ``begin`` (a byte) and ``size`` (a number of bits), each key has a part of the array of its own.
    """
    alive = np.arange(keys.size)
    begin = np.zeros(keys.size, np.uint64) if begin is None else begin
    size = np.full(keys.size, array.size * 8, np.uint64) if size is None else size
    at, step = _start_and_step(keys)
    for _ in range(setup.probes):
        place = (at >> np.uint64(32)) * size >> np.uint64(32)
        byte = array[begin + (place >> np.uint64(3))]
        hit = np.flatnonzero(byte >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8)) & 1)
        if hit.size < alive.size:
            alive, at, step, begin, size = alive[hit], at[hit], step[hit], begin[hit], size[hit]
        at += step
    out = np.zeros(keys.size, bool)
    out[alive] = True
    return out


@dataclass
class LogFrequencyFilter:
    """Bit arrays of ``count`` neighbouring segments from ``first`` on, one array for each level.

    Segment ``s`` of a level has ``bits[level][s]`` bits from byte ``begin[level][s]`` on. Without ``arrays``
    they were too large to hold; n-grams are then probed in the table of counts.
    """

    segments: int
    setup: LmSetup
    first: int
    arrays: list[np.ndarray] | None = None
    begin: np.ndarray | None = None
    bits: np.ndarray | None = None

    @property
    def nbytes(self) -> int:
        return sum(a.size for a in self.arrays or [])

    def fill(self, rows: Iterator[tuple[int, int, bytes]], count: int, sizes: list[int]) -> LogFrequencyFilter:
        """Take in the arrays (segment, level, data); ``sizes`` are the bytes of the levels from 1 on."""
        self.arrays = [np.empty(n, np.uint8) for n in sizes]
        self.begin, self.bits = np.zeros((2, len(sizes), count), np.uint64)
        ends = [0] * len(sizes)
        for segment, level, data in rows:
            j, s, at = level - 1, segment - self.first, ends[level - 1]
            self.begin[j, s], self.bits[j, s] = at, len(data) * 8
            ends[j] += len(data)
            self.arrays[j][at : ends[j]] = np.frombuffer(data, np.uint8)
        return self

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key's count, 0 if it is not held; a false positive can only raise it."""
        if self.arrays is None:
            raise ValueError("the bit arrays are too large to hold: score with score_texts")
        segment = segment_of(keys, self.segments) - self.first
        # In order of segments, neighbouring probes fall into the same part of an array.
        alive = np.argsort(segment, kind="stable")
        out = np.zeros(keys.size, np.uint8)
        for j, array in enumerate(self.arrays):
            bits = self.bits[j][segment[alive]]
            alive, bits = alive[bits > 0], bits[bits > 0]
            alive = alive[has(array, keys[alive], self.setup, self.begin[j][segment[alive]], bits)]
            out[alive] = j + 1
        return out


def _grouped(texts: list[str | None], chars: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _gathered(batches: Iterator[pd.DataFrame], chars: int) -> Iterator[list[str | None]]:
    """Texts of several Arrow batches, about ``chars`` characters at a time."""
    held, size = [], 0
    for batch in batches:
        for t in batch["text"]:
            held.append(t)
            size += len(t or "")
            if size >= chars:
                yield held
                held, size = [], 0
    if held:
        yield held


def count_ngrams(docs: DataFrame, text: str, segments: int, setup: LmSetup) -> DataFrame:
    """The model's table: (segment, level, n, data, counts).

    Level 0 has the segment's words with exact counts, the levels above are bit arrays. Keys and
    counts are packed by segment and summed up within each batch before the shuffle, so a frequent
    word is one entry per batch and its segment no larger than others.
    """
    ship_package(docs.sparkSession)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts in _gathered(batches, setup.batch_chars):
            each = [token_keys(t) for t in texts]
            pairs = np.concatenate([pair_keys(k) for k in each])
            for kind, keys in enumerate((np.concatenate(each), pairs)):
                keys, counts = np.unique(keys, return_counts=True)
                segment = segment_of(keys, segments)
                order = np.argsort(segment, kind="stable")
                keys, counts, cuts = keys[order], counts[order].astype("<u4"), np.searchsorted(segment[order], np.arange(segments + 1))
                # Nearly all pairs of a batch occur once: those need no count.
                once = counts == 1
                rows = []
                for s in np.flatnonzero(np.diff(cuts)):
                    k, c, o = (x[cuts[s] : cuts[s + 1]] for x in (keys, counts, once))
                    k = np.concatenate([k[~o], k[o]])
                    rows.append((s, kind, _shorten(k, kind), c[~o].tobytes()))
                yield pd.DataFrame(rows, columns=["segment", "kind", "data", "counts"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        segment = int(part["segment"].iat[0])
        total: list[tuple[np.ndarray, np.ndarray]] = []
        for kind in (0, 1):
            keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            own = part[part["kind"] == kind]
            for data, more in zip(own["data"], own["counts"], strict=True):
                k = _lengthen(data, kind)
                c = np.ones(k.size, np.int64)
                c[: len(more) // 4] = np.frombuffer(more, "<u4")
                keys.append(k)
                counts.append(c)
            k, where = np.unique(np.concatenate(keys), return_inverse=True)
            total.append((k, np.bincount(where, np.concatenate(counts), k.size).astype(np.int64)))
        words, word_counts = total[0]
        rows = [(segment, 0, words.size, words.tobytes(), word_counts.astype("<i8").tobytes())]
        keys, level = np.concatenate([words, total[1][0]]), _levels(np.concatenate([word_counts, total[1][1]]))
        for j in range(1, int(level.max(initial=0)) + 1):
            held = keys[level >= j]
            rows.append((segment, j, held.size, bit_array(held, setup), b""))
        return pd.DataFrame(rows, columns=["segment", "level", "n", "data", "counts"])

    packed = docs.select(F.col(text).alias("text")).mapInPandas(pack, "segment int, kind int, data binary, counts binary")
    return packed.groupBy("segment").applyInPandas(merge, "segment int, level int, n long, data binary, counts binary")


def _shorten(keys: np.ndarray, kind: int) -> bytes:
    """Words keep all 64 bits, as their counts are exact; the keys of pairs have 48 bits."""
    if kind == 0:
        return keys.astype("<u8").tobytes()
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _lengthen(data: bytes, kind: int) -> np.ndarray:
    if kind == 0:
        return np.frombuffer(data, "<u8")
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


@dataclass
class LanguageModel:
    """The filter, the weights of bigrams by level of the context, and the corpus totals.

    ``words`` and ``counts`` are the exact counts, sorted by key, if the filter is held.
    """

    filter: LogFrequencyFilter
    weights: np.ndarray
    tokens: int
    distinct: int
    words: np.ndarray | None = None
    counts: np.ndarray | None = None

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        add = self.filter.setup.add
        return (counts + add) / (self.tokens + add * (self.distinct + 1))

    def evidence(self, texts: list[str | None]) -> pd.DataFrame:
        """``_EVIDENCE`` of each text, by the filter and the words that are held."""
        each = [token_keys(t) for t in texts]
        keys = np.concatenate(each)
        first = np.r_[0, np.cumsum([k.size for k in each])[:-1]].astype(np.int64)
        distinct, where = np.unique(keys, return_inverse=True)
        own, back = np.unique(np.concatenate([pair_keys(k) for k in each]), return_inverse=True)
        exact = _looked_up(distinct, self.words, self.counts)
        return self.measured(first, self.filter.levels(distinct)[where], self.filter.levels(own)[back], exact[where])

    def measured(self, first: np.ndarray, level: np.ndarray, pair: np.ndarray, exact: np.ndarray) -> pd.DataFrame:
        """``_EVIDENCE`` of the texts that begin at ``first``; ``pair`` has no entry for a first token."""
        ends = np.r_[first[1:], level.size]
        pairs = np.zeros(level.size, np.uint8)
        single = np.ones(level.size, bool)
        single[first] = False
        pairs[single] = pair
        frame = pd.DataFrame({"n_known": np.add.reduceat((exact > 0).astype(np.int64), first)})
        frame["base_score"] = np.add.reduceat(np.log10(self.unigram(exact)), first)
        for name, values in (("levels", level), ("pairs", pairs)):
            frame[name] = [values[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
        return frame

    def scores(self, first: np.ndarray, level: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Scores of the texts that begin at ``first``, from the levels of their tokens and pairs."""
        count = expected(np.arange(256))
        context = _context(first, level)
        weight = np.where(context > 0, np.r_[self.weights, np.zeros(192)][context], 0.0)
        bigram = np.minimum(count[pair] / np.maximum(count[context], 1.0), 1.0)
        return np.add.reduceat(np.log10(weight * bigram + (1 - weight) * self.unigram(count)[level]), first)


#: What is known of a text: the words that occur in training, their smoothed score by exact counts, and one byte
#: for the level of every token and of its pair with the token before (0 at the first token).
_EVIDENCE = "n_known long, base_score double, levels binary, pairs binary"


def _looked_up(keys: np.ndarray, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Exact counts of keys, 0 of those that are not among the sorted words."""
    if not words.size:
        return np.zeros(keys.size, np.int64)
    at = np.minimum(np.searchsorted(words, keys), words.size - 1)
    return np.where(words[at] == keys, counts[at], 0)


def _context(first: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Level of the token before each token, 0 at the begin of a text."""
    context = np.r_[np.zeros(1, np.uint8), level[:-1]]
    context[first] = 0
    return context


def _opened(levels: pd.Series, pairs: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First tokens, levels and pair levels of several texts in a row; every text has an end, so none is empty."""
    first = np.r_[0, np.cumsum([len(x) for x in levels])[:-1]].astype(np.int64)
    return first, np.frombuffer(b"".join(levels), np.uint8), np.frombuffer(b"".join(pairs), np.uint8)


def _coded(docs: DataFrame, key: Column, text: str, segments: int, setup: LmSetup) -> DataFrame:
    """(key, batch, place, tokens, pairs, words, bigrams), one row per text, written.

    ``tokens`` and ``pairs`` count into the batch's distinct ``words`` and ``bigrams``, which are
    ordered by segment and kept with the first text of the batch.
    """

    @F.pandas_udf("batch long, place long, tokens binary, pairs binary, words binary, bigrams binary")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, rows = batch.tolist(), []
            for a, b in _grouped(texts, setup.batch_chars):
                number += 1
                each = [token_keys(t) for t in texts[a:b]]
                words, tokens = _by_segment(np.concatenate(each), segments)
                bigrams, pairs = _by_segment(np.concatenate([pair_keys(k) for k in each]), segments)
                at = 0
                for i, k in enumerate(each):
                    own = tokens[at : at + k.size].tobytes(), pairs[at - i : at - i + k.size - 1].tobytes()
                    rows.append((number, i, *own, *((None, None) if i else (words.tobytes(), bigrams.tobytes()))))
                    at += k.size
            yield pd.DataFrame(rows, columns=["batch", "place", "tokens", "pairs", "words", "bigrams"])

    return materialize(docs.select(key.alias("key"), code(F.col(text)).alias("c")).select("key", "c.*"), "coded")


def _by_segment(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys ordered by segment, and where each key stands among them."""
    distinct, where = np.unique(keys, return_inverse=True)
    order = np.argsort(segment_of(distinct, segments), kind="stable")
    rank = np.empty(order.size, np.uint32)
    rank[order] = np.arange(order.size, dtype=np.uint32)
    return distinct[order].astype("<u8"), rank[where].astype("<u4")


def _probed(coded: DataFrame, table: DataFrame, model: LanguageModel) -> DataFrame:
    """(key, evidence) of every text, probed by segment.

    A task holds the arrays of one run of segments and the distinct keys that batches have in it; a
    batch's task gets one level per distinct key. Runs grow in number, not in size, and no more rows
    are shuffled than batches have distinct keys.
    """
    segments, setup = model.filter.segments, model.filter.setup
    runs = -(-segments // setup.run)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for batch, *both in zip(part["batch"], part["words"], part["bigrams"], strict=True):
                rows = []
                for kind, data in enumerate(both):
                    keys = np.frombuffer(data, "<u8")
                    cuts = np.searchsorted(segment_of(keys, segments) // setup.run, np.arange(runs + 1))
                    rows += [(batch, r, kind, keys[cuts[r] : cuts[r + 1]].tobytes()) for r in np.flatnonzero(np.diff(cuts))]
                yield pd.DataFrame(rows, columns=["batch", "run", "kind", "keys"])

    def probe(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        own, exact_rows = held[held["level"] > 0], held[held["level"] == 0]
        words = np.frombuffer(b"".join(exact_rows["data"]), "<u8")
        order = np.argsort(words)
        words, counts = words[order], np.frombuffer(b"".join(exact_rows["counts"]), "<i8")[order]
        sizes = own["data"].map(len).groupby(own["level"]).sum()
        rows = zip(own["segment"], own["level"], own["data"], strict=True)
        begin = int(asked["run"].iat[0]) * setup.run if len(asked) else 0
        found = LogFrequencyFilter(segments, setup, begin)
        if len(asked):
            found.fill(rows, setup.run, [int(sizes.get(j, 0)) for j in range(1, int(sizes.index.max() if len(sizes) else 0) + 1)])
        out = []
        for batch, run, kind, data in zip(asked["batch"], asked["run"], asked["kind"], asked["keys"], strict=True):
            keys = np.frombuffer(data, "<u8")
            exact = _looked_up(keys, words, counts).astype("<i8").tobytes() if kind == 0 else b""
            out.append((batch, run, kind, found.levels(keys).tobytes(), exact))
        return pd.DataFrame(out, columns=["batch", "run", "kind", "levels", "exact"])

    def gather(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        texts, found = texts.sort_values("place"), found.sort_values("run")
        words, bigrams = (np.frombuffer(b"".join(found.loc[found["kind"] == k, "levels"]), np.uint8) for k in (0, 1))
        exact = np.frombuffer(b"".join(found.loc[found["kind"] == 0, "exact"]), "<i8")
        tokens = np.frombuffer(b"".join(texts["tokens"]), "<u4")
        first = np.r_[0, np.cumsum([len(t) // 4 for t in texts["tokens"]])[:-1]].astype(np.int64)
        pairs = np.frombuffer(b"".join(texts["pairs"]), "<u4")
        frame = model.measured(first, words[tokens], bigrams[pairs], exact[tokens])
        return pd.concat([texts[["batch", "place"]].reset_index(drop=True), frame], axis=1)

    asked = coded.filter("words IS NOT NULL").select("batch", "words", "bigrams")
    asked = asked.mapInPandas(send, "batch long, run int, kind int, keys binary")
    held = table.select(F.floor(F.col("segment") / setup.run).cast("int").alias("run"), "segment", "level", "data", "counts")
    found = (
        asked.groupBy("run").cogroup(held.groupBy("run"))
        .applyInPandas(probe, "batch long, run int, kind int, levels binary, exact binary")
    )
    texts = coded.select("batch", "place", "tokens", "pairs")
    each = texts.groupBy("batch").cogroup(found.groupBy("batch")).applyInPandas(gather, "batch long, place long, " + _EVIDENCE)
    return coded.select("key", "batch", "place").join(each, ["batch", "place"]).drop("batch", "place")


def evidence(docs: DataFrame, model: LanguageModel, table: DataFrame, key: Column, text: str) -> DataFrame:
    """(key, evidence) of every whole text, by the filter if it is held, else by segment."""
    held = model.filter
    if held.arrays is None:
        return _probed(_coded(docs, key, text, held.segments, held.setup), table, model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_EVIDENCE)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            texts = batch.tolist()
            for a, b in _grouped(texts, own.filter.setup.batch_chars):
                yield own.evidence(texts[a:b])

    return docs.select(key.alias("key"), found(F.col(text)).alias("e")).select("key", "e.*")


def _interpolation(known: DataFrame) -> np.ndarray:
    """Weight of the bigram for each level of its context, over the evidence of all training texts.

    It is the share of tokens, behind contexts of that level, whose pair also occurs elsewhere: each
    training token has itself been counted, so a pair of level 1 is one that was never seen before.
    A context of level 1 has no other occurrence and takes the weight of level 2.
    """

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                first, level, pair = _opened(batch["levels"], batch["pairs"])
                context = _context(first, level)
                n, seen = np.bincount(context, minlength=64)[:64], np.bincount(context, pair >= 2, 64)[:64]
                yield pd.DataFrame({"level": np.arange(64), "n": n.astype(np.int64), "seen": seen.astype(np.int64)})

    sums = known.select("levels", "pairs").mapInPandas(tally, "level long, n long, seen long").groupBy("level").sum("n", "seen")
    weights = np.zeros(64)
    for r in sums.collect():
        weights[r["level"]] = (r["sum(seen)"] + 0.5) / (r["sum(n)"] + 10)
    weights[1] = weights[2]
    return np.clip(weights, 0.0, 0.98)


def counted(docs: DataFrame, text: str, setup: LmSetup) -> tuple[LanguageModel, DataFrame]:
    """A model without weights, and its table of counts."""
    bound_batches(docs.sparkSession)
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    segments = max(8, -(-chars // setup.segment_chars))
    table = materialize(count_ngrams(docs, text, segments, setup), "ngrams")
    sizes = {r.level: (r.b, r.n) for r in table.groupBy("level").agg(F.sum(F.length("data")).alias("b"), F.sum("n").alias("n")).collect()}
    top = max(sizes, default=0)
    distinct = int(sizes.get(0, (0, 0))[1])
    held = LogFrequencyFilter(segments, setup, 0)
    exact = table.filter("level = 0")
    if distinct > setup.vocabulary or sum(sizes[j][0] for j in range(1, top + 1)) > setup.filter_bytes:
        return LanguageModel(held, np.zeros(64), _total(exact), distinct), table
    rows = table.filter("level > 0").select("segment", "level", "data").toLocalIterator()
    held.fill(rows, segments, [sizes[j][0] for j in range(1, top + 1)])
    parts = [(np.frombuffer(r.data, "<u8"), np.frombuffer(r.counts, "<i8")) for r in exact.select("data", "counts").toLocalIterator()]
    words = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)])
    order = np.argsort(words)
    counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])[order]
    return LanguageModel(held, np.zeros(64), int(counts.sum()), distinct, words[order], counts), table


def train(docs: DataFrame, text: str = "text", setup: LmSetup = LmSetup()) -> tuple[LanguageModel, DataFrame]:
    """The model of all texts, and its table of counts. An empty table gives a model without counts."""
    model, table = counted(docs, text, setup)
    model.weights = _interpolation(evidence(docs, model, table, F.lit(None).cast("int"), text))
    return model, table


def _total(exact: DataFrame) -> int:
    """Sum of the exact counts."""
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [sum(int(np.frombuffer(c, "<i8").sum()) for c in batch["counts"])]})

    return int(exact.select("counts").mapInPandas(add_up, "n long").agg(F.sum("n")).first()[0] or 0)


def _scored(known: DataFrame, model: LanguageModel, key: str) -> DataFrame:
    lean = LanguageModel(LogFrequencyFilter(model.filter.segments, model.filter.setup, 0), model.weights, model.tokens, model.distinct)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for levels, pairs in batches:
            yield pd.Series(lean.scores(*_opened(levels, pairs)) if len(levels) else [], dtype="float64")

    return known.select(
        F.col(key), F.length("levels").cast("long").alias("n_tokens"), "n_known", "base_score", score("levels", "pairs").alias("score")
    )


def score_texts(docs: DataFrame, model: LanguageModel, table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of every whole text.

    ``score`` is the model's log10 probability, ``base_score`` that of a smoothed unigram model with
    exact counts. As the model's counts are the mean ones of their levels, the probabilities of all tokens
    behind a context sum to one only nearly. A NULL text is empty: its end is its only token. Repeated
    rows are scored each; an empty table gives an empty result.
    """
    known = evidence(docs, model, table, F.col(key), text)
    return _scored(known.withColumnRenamed("key", key), model, key)


def train_and_score(
    docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", setup: LmSetup = LmSetup()
) -> tuple[DataFrame, LanguageModel]:
    """What ``train`` on the rows of ``training`` and ``score_texts`` on all give, and the model; every text is probed once."""
    model, table = counted(docs.filter(training), text, setup)
    both = F.struct(F.col(key).alias("key"), F.coalesce(training, F.lit(False)).alias("training"))
    known = materialize(evidence(docs, model, table, both, text), "evidence")
    model.weights = _interpolation(known.filter("key.training"))
    return _scored(known.withColumn(key, F.col("key.key")), model, key), model
