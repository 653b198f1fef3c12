"""Byte-level BPE by DuckDB recursive queries inside Spark partitions.

A text is cut into pieces by the tokenizer's pattern. The distinct pieces of a batch become rows
of (piece, position, token), one for each byte. A recursive query joins neighbouring tokens to
the merge table and contracts the leftmost pair of the smallest rank of every piece, until no
piece has a pair left. Ids are decoded by an ordered aggregation over the token table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import ship_package

#: No pair: a rank above all others.
NONE = (1 << 31) - 1

#: The fixpoint. A row is a piece: its tokens between two borders of -1, and the rank of each token with the one
#: that follows it. In a round every piece that still has a pair to merge contracts one, the leftmost of the least
#: rank, and only the two pairs that it now takes part in are looked up. A row without a pair is finished.
CONTRACT = f"""
WITH RECURSIVE rows(piece, ids, ranks, best) AS (
    SELECT piece, ids, ranks, list_min(ranks) FROM start
    UNION ALL
    SELECT piece, ids, ranks, list_min(ranks)
    FROM (
        SELECT piece, ids[1:spot - 1] || [best] || ids[spot + 2:len(ids)] AS ids,
               ranks[1:spot - 2] || [coalesce(l.merged, {NONE}), coalesce(r.merged, {NONE})] || ranks[spot + 2:len(ranks)] AS ranks
        FROM (SELECT piece, ids, ranks, best, list_position(ranks, best) AS spot FROM rows WHERE best < {NONE}) x
        LEFT JOIN merges l ON l.first = x.ids[spot - 1] AND l.second = best
        LEFT JOIN merges r ON r.first = best AND r.second = x.ids[spot + 2]
    )
)
SELECT piece, ids[2:len(ids) - 1] AS ids FROM rows WHERE best = {NONE}
"""

DECODE = """
SELECT segment, unhex(string_agg(t.bytes, '' ORDER BY i.pos)) AS bytes
FROM ids i JOIN tokens t USING (token)
GROUP BY segment
"""


@dataclass(frozen=True)
class BpeSetup:
    """Bytes of pieces in one query, characters of a batch of texts, and pieces remembered.

    Remembering is only to save work: a worker that forgets encodes a piece again.
    """

    query_bytes: int = 1 << 18
    batch_chars: int = 1 << 20
    remembered: int = 300_000
    memory: str = "160MB"


class Remembered(dict):
    """A mapping of bounded size that forgets what was not asked for lately."""

    def __init__(self, most: int):
        super().__init__()
        self._most, self._older = most, {}

    def missing(self, keys: Iterable) -> list:
        """Those of the keys that are not known; keys known of old are known anew."""
        if len(self) > self._most // 2:
            self._older = dict(self)
            self.clear()
        out = []
        for key in [k for k in keys if k not in self]:
            if (value := self._older.get(key)) is not None:
                self[key] = value
            else:
                out.append(key)
        return out


class Vocabulary:
    """Ranks, merge table and pattern of a tokenizer, kept as tables of an own DuckDB database."""

    def __init__(self, ranks: list[tuple[bytes, int]], pattern: str, setup: BpeSetup = BpeSetup()):
        self.ranks, self.pattern, self.setup = ranks, pattern, setup

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "setup": self.setup}

    def _open(self) -> None:
        if hasattr(self, "_db"):
            return
        self._db = duckdb.connect(config={"threads": 1, "memory_limit": self.setup.memory})
        self._split = regex.compile(self.pattern).findall
        self._id = {token: rank for token, rank in self.ranks}
        self._pieces = Remembered(self.setup.remembered)
        self._segments = Remembered(self.setup.remembered)
        # Tokens that begin with a space: ids are cut before them to be decoded.
        self._begins = np.zeros(max(self._id.values(), default=0) + 1, bool)
        self._begins[[r for t, r in self.ranks if t[:1] == b" "]] = True
        # Any two tokens whose concatenation is a token may merge, with the rank of the result.
        pairs = [
            (self._id[t[:k]], self._id[t[k:]], rank)
            for t, rank in self.ranks
            for k in range(1, len(t))
            if t[:k] in self._id and t[k:] in self._id
        ]
        self._byte_ids = np.array([self._id[bytes([b])] for b in range(256)], np.int32)
        self._byte_ranks = np.array([[self._id.get(bytes([a, b]), NONE) for b in range(256)] for a in range(256)], np.int32)
        merges = pa.table([pa.array([p[i] for p in pairs], pa.int32()) for i in range(3)], ["first", "second", "merged"])
        tokens = pa.table({"token": pa.array([r for _, r in self.ranks], pa.int32()), "bytes": pa.array([t.hex() for t, _ in self.ranks], pa.string())})
        for name, data in (("merges", merges), ("tokens", tokens)):
            self._db.register("incoming", data)
            self._db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self._db.unregister("incoming")

    def _contract(self, pieces: list[str]) -> None:
        """Remember the ids of pieces that are no tokens themselves."""
        raw = [p.encode() for p in pieces]
        lengths = np.array([len(b) for b in raw])
        flat = np.frombuffer(b"".join(raw), np.uint8)
        # Borders before and behind each piece, and a rank for each but the last.
        begin = np.r_[0, np.cumsum(lengths + 2)].astype(np.int32)
        tokens = np.full(begin[-1], -1, np.int32)
        inside = np.arange(flat.size) + 2 * np.repeat(np.arange(len(raw)), lengths) + 1
        tokens[inside] = self._byte_ids[flat]
        ranks = np.full(begin[-1], NONE, np.int32)
        paired = np.flatnonzero(np.diff(inside) == 1)
        ranks[inside[paired]] = self._byte_ranks[flat[paired], flat[paired + 1]]
        start = pa.table({"piece": np.arange(len(raw), dtype=np.int32), "ids": pa.ListArray.from_arrays(begin, tokens), "ranks": pa.ListArray.from_arrays(begin, ranks)})
        self._db.register("start", start)
        found = self._db.sql(CONTRACT).to_arrow_table()
        self._db.unregister("start")
        ids = found.column("ids").combine_chunks()
        flat_ids = ids.values.to_numpy().astype("<u4").tobytes()
        offsets = (ids.offsets.to_numpy() * 4).tolist()
        for at, begin, end in zip(_plain(found.column("piece")), offsets, offsets[1:], strict=False):
            self._pieces[pieces[at]] = flat_ids[begin:end]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        self._open()
        cut = [self._split(t) for t in texts]
        coded = pa.array(list(chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        distinct = _plain(coded.dictionary)
        fresh: list[str] = []
        size = 0
        for piece in self._pieces.missing(distinct):
            raw = piece.encode()
            if (whole := self._id.get(raw)) is not None:
                self._pieces[piece] = whole.to_bytes(4, "little")
                continue
            fresh.append(piece)
            size += len(raw)
            if size >= self.setup.query_bytes:
                self._contract(fresh)
                fresh, size = [], 0
        if fresh:
            self._contract(fresh)
        return _joined(list(map(self._pieces.__getitem__, distinct)), coded.indices, [len(c) for c in cut])

    def _assemble(self, segments: list[bytes]) -> None:
        """Remember the bytes of sequences of ids."""
        lengths = np.array([len(x) // 4 for x in segments])
        flat = np.frombuffer(b"".join(segments), "<u4").astype(np.int32)
        ends = np.cumsum(lengths)
        table = pa.table(
            {
                "segment": np.repeat(np.arange(len(segments), dtype=np.int32), lengths),
                "pos": (np.arange(flat.size) - np.repeat(ends - lengths, lengths)).astype(np.int32),
                "token": flat,
            }
        )
        self._db.register("ids", table)
        found = self._db.sql(DECODE).to_arrow_table()
        self._db.unregister("ids")
        for at, raw in zip(_plain(found.column("segment")), _plain(found.column("bytes")), strict=True):
            self._segments[segments[at]] = raw

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids.

        Sequences are cut before tokens that begin with a space; each distinct segment is
        decoded once, by ordered aggregation.
        """
        self._open()
        flat = np.frombuffer(b"".join(ids), "<u4")
        ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
        cut = self._begins[flat]
        cut[(edges := np.r_[0, ends])[edges < flat.size]] = True
        starts = np.flatnonzero(cut)
        offsets = pa.py_buffer(np.r_[starts, flat.size].astype(np.int64) * 4)
        coded = pa.Array.from_buffers(pa.large_binary(), starts.size, [None, offsets, pa.py_buffer(flat)]).dictionary_encode()
        distinct = _plain(coded.dictionary)
        fresh: list[bytes] = []
        size = 0
        for segment in self._segments.missing(distinct):
            fresh.append(segment)
            size += len(segment)
            if size >= 4 * self.setup.query_bytes:
                self._assemble(fresh)
                fresh, size = [], 0
        if fresh:
            self._assemble(fresh)
        return _joined(list(map(self._segments.__getitem__, distinct)), coded.indices, np.diff(np.searchsorted(starts, np.r_[0, ends])))


def _plain(column: pa.Array | pa.ChunkedArray) -> list:
    """As ``to_pylist``, which makes an object of Arrow's for every value."""
    return column.to_numpy(zero_copy_only=False).tolist() if isinstance(column, pa.Array) else column.to_numpy().tolist()


def _joined(parts: list[bytes], at: pa.Array, counts: Sequence[int]) -> list[bytes]:
    """For each of ``counts`` the next so many of the parts that ``at`` names, joined."""
    found = pa.array(parts, pa.large_binary()).take(at)
    offsets = np.frombuffer(found.buffers()[1], np.int64)
    edges = offsets[np.r_[0, np.cumsum(counts, dtype=np.int64)]].tolist()
    data = memoryview(found.buffers()[2] or b"")
    return [bytes(data[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    """Tokens and ranks of a vocabulary file; the file's size bounds what is sent to workers."""
    with open(path, "rb") as file:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in file if line.strip())]


def _batches(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encode_and_decode(
    docs: DataFrame, keep: list[str], path: str, pattern: str, text: str = "text", setup: BpeSetup = BpeSetup(), ids: bool = False
) -> DataFrame:
    """``keep``, then the number of tokens, and digests of the ids and of the decoded bytes.

    Every whole text is encoded without special tokens, and the ids are decoded again. With
    ``ids`` the column ``ids`` (binary, unsigned 32-bit little-endian) is returned as well. A
    NULL text counts as empty and has no ids; repeated rows are encoded each; an empty table
    gives an empty result. Text that is not valid Unicode cannot occur in a Spark string.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern, setup))
    kind = "n long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if ids else "")

    @F.pandas_udf(kind)
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = _kept(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch]
            out = []
            for a, b in _batches(texts, setup.batch_chars):
                coded = own.encode(texts[a:b])
                for x, raw in zip(coded, own.decode(coded), strict=True):
                    row = (len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(raw).hexdigest())
                    out.append((*row, x) if ids else row)
            yield pd.DataFrame(out, columns=["n", "ids_sha256", "decoded_sha256", "ids"][: 3 + ids])

    found = docs.select(*keep, encode(F.col(text)).alias("__e"))
    return found.select(
        *keep,
        F.col("__e.n").alias("n_tokens"),
        F.col("__e.ids_sha256").alias("ids_sha256"),
        F.col("__e.decoded_sha256").alias("decoded_sha256"),
        *([F.col("__e.ids").alias("ids")] if ids else []),
    )


_VOCABULARIES: dict[str, Vocabulary] = {}


def _kept(new: Vocabulary) -> Vocabulary:
    """One vocabulary and database for each tokenizer in a worker, with what it remembers."""
    content = hashlib.sha256(repr((len(new.ranks), new.ranks[:64], new.ranks[-64:], new.pattern, new.setup)).encode()).hexdigest()
    return _VOCABULARIES.setdefault(content, new)
