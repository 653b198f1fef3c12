"""Alignment of two tokenizers' tokens over the bytes that both stand for.

Byte offsets where a token of both ends cut a text into groups; tokens whose byte ranges overlap are
linked. An identity map, made once from both vocabularies, gives for each id of A the id of B with
the same bytes. A group of one token each that the map predicts needs no pair: such groups are
counted in vectors as long as A's vocabulary. Only links of other groups are shuffled as pairs.

A text is encoded once. What its links are is written as a table of numbers; the corpus-wide counts
are made from it, and then looked up for each text: identity links and the most frequent pairs in
arrays of bounded size, which are broadcast, the remaining pairs by a join. No pair that is left to
the join can be hot, as those that are frequent enough are all in the arrays.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.text import free_name, whole
from quern.session import bound_batches, materialize, ship_package


@dataclass(frozen=True)
class AlignSetup:
    """Characters encoded at once, and how many pairs at most are broadcast.

    A pair is broadcast if it holds at least one in ``frequent`` of all links, so that at most
    ``frequent`` pairs can.
    """

    batch_chars: int = 1 << 19
    frequent: int = 1 << 18


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others, in order, for the letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Fixed value: the pieces that byte-level pre-tokenizers cut a text into.
BYTE_LEVEL_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of characters whose classes are the same in every library and version of Unicode.
_SETTLED = re.compile(r"[\x00-\x1B\x20-\x84\x86-\u024F\u2010-\u2027\u20AC]*+")


class TokenizerPair:
    """Two tokenizers made from the contents of their files, and what is derived from their vocabularies."""

    def __init__(self, a_file: bytes, b_file: bytes):
        self.a_file, self.b_file = a_file, b_file

    def __getstate__(self):
        return {"a_file": self.a_file, "b_file": self.b_file}

    def open(self) -> None:
        if hasattr(self, "to_b"):
            return
        # One thread for each task: Spark has the others.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(self.a_file.decode())
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=self.b_file)
        letters = _byte_letters()
        entries = self._a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            own = all(c in letters for c in entry)
            self.a_bytes[i] = bytes(letters[c] for c in entry) if own else entry.encode()
        self.b_bytes = [self._piece(i) for i in range(self._b.get_piece_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # Of several ids of B with the same bytes the last is taken; the map only has to be a function.
        place = {x: i for i, x in enumerate(self.b_bytes)}
        self.to_b = np.array([place.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)
        self.a_text, self.b_text = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(self.b_bytes))]
        # What stands for a group of one token each that the map predicts.
        self.alone_text = np.array([f"{i}|{j}" for i, j in enumerate(self.to_b.tolist())], object)
        self._fast = self._by_ranks(json.loads(self.a_file), entries)

    def _by_ranks(self, file: dict, entries: dict[str, int]):
        """A's encoder by ranks, several times faster, where its file says that the ids are the same.

        So it is if pieces are cut at the byte level, nothing is normalised, and the merges stand in the
        order of the ids that they make.
        """
        import tiktoken

        kind, model = file.get("pre_tokenizer") or {}, file["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        made = [entries[x + y] for x, y in pairs]
        byte_level = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space", True)
        if not byte_level or file.get("normalizer") or model["type"] != "BPE" or made != sorted(set(made)):
            return None
        added = {t["id"] for t in file.get("added_tokens", [])}
        ranks = {x: i for i, x in enumerate(self.a_bytes) if x and i not in added}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PIECES, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

    def _encode_a(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        others = []
        for i, t in enumerate(texts):
            if self._fast and _SETTLED.fullmatch(t):
                out[i] = self._fast.encode_to_numpy(f" {t}", disallowed_special=())
            else:
                others.append(i)
        for i, x in zip(others, self._a.encode_batch_fast([f" {texts[i]}" for i in others], add_special_tokens=False), strict=True):
            out[i] = np.array(x.ids, "<u4")
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B; none where the texts rebuilt from them differ from the text."""
        a, b = self._encode_a(texts), [np.array(x, "<u4") for x in self._b.encode(texts, num_threads=1)]
        for i, t in enumerate(texts):
            raw = f" {t}".encode()
            rebuilt = lambda ids, table: b"".join(map(table.__getitem__, ids.tolist()))
            if not t or rebuilt(a[i], self.a_bytes) != raw or rebuilt(b[i], self.b_bytes) != raw:
                a[i] = b[i] = np.zeros(0, "<u4")
        return a, b


def codes_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


@dataclass
class Aligned:
    """Links and groups of a batch of texts, in order; ``ends`` are exclusive ends for each text."""

    n_a: np.ndarray
    n_b: np.ndarray
    group_ends: np.ndarray
    groups: np.ndarray
    link_text: np.ndarray
    code: np.ndarray
    identity: np.ndarray


def align(a: list[np.ndarray], b: list[np.ndarray], pair: TokenizerPair) -> Aligned:
    """Groups and links of texts whose tokens stand for the same bytes.

    Between two neighbouring ends of tokens lies exactly one pair of overlapping tokens, so the
    links are as many as the different ends.
    """
    n_a, n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    ids_a, ids_b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
    ends_a, ends_b = np.cumsum(pair.a_length[ids_a]), np.cumsum(pair.b_length[ids_b])
    size = int(ends_a[-1]) if ends_a.size else 0
    is_a, is_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    is_a[ends_a], is_b[ends_b] = True, True
    ends = np.flatnonzero(is_a | is_b)
    # The token that covers an end is the one behind all ends before it.
    at_a, at_b = np.cumsum(is_a, dtype=np.int32)[ends - 1], np.cumsum(is_b, dtype=np.int32)[ends - 1]
    both = is_a[ends] & is_b[ends]
    alone = both & np.r_[True, both[:-1]][: ends.size]
    left, right = ids_a[at_a], ids_b[at_b]
    identity = alone & (pair.to_b[left] == right)
    # Texts without tokens have no bytes here, so a text's tokens end where its bytes do.
    link_text = np.repeat(np.arange(len(a)), n_a)[at_a]
    group_of = np.cumsum(both) - both
    groups = np.empty(int(both.sum()), object)
    groups[group_of[identity]] = pair.alone_text[left[identity]]
    other = both & ~identity
    number = group_of[other]
    stop_a, stop_b = at_a[both] + 1, at_b[both] + 1
    begin_a, begin_b = np.r_[0, stop_a[:-1]][number], np.r_[0, stop_b[:-1]][number]
    text_a, text_b = pair.a_text.__getitem__, pair.b_text.__getitem__
    list_a, list_b = ids_a.tolist(), ids_b.tolist()
    for g, x, u, y, v in zip(number.tolist(), begin_a.tolist(), stop_a[number].tolist(), begin_b.tolist(), stop_b[number].tolist(), strict=True):
        groups[g] = f"{','.join(map(text_a, list_a[x:u]))}|{','.join(map(text_b, list_b[y:v]))}"
    group_ends = np.cumsum(np.bincount(link_text[both], minlength=len(a)))
    return Aligned(n_a, n_b, group_ends, groups, link_text, codes_of(left, right), identity)


_PAIRS: dict[str, TokenizerPair] = {}


def _kept(new: TokenizerPair) -> TokenizerPair:
    """One opened pair for each two files in a worker."""
    own = _PAIRS.setdefault(hashlib.sha256(new.a_file + new.b_file).hexdigest(), new)
    own.open()
    return own


def _batches(texts: list[str], chars: int) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def _link_table(docs: DataFrame, keep: list[str], text: str, shared, setup: AlignSetup, groups: bool) -> DataFrame:
    """(row, keep, counts, digest or groups, identity ids, other links) of every text, as a table."""

    @F.pandas_udf("n_a long, n_b long, n_groups long, n_links long, groups string, same binary, other binary")
    def link(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pair = _kept(shared.value)
        for batch in batches:
            out = []
            for texts in _batches(batch.tolist(), setup.batch_chars):
                found = align(*pair.encode(texts), pair)
                ends = found.group_ends.tolist()
                link_ends = np.cumsum(np.bincount(found.link_text, minlength=len(texts))).tolist()
                begin = link_begin = 0
                for i, (end, link_end) in enumerate(zip(ends, link_ends, strict=True)):
                    listed = ";".join(found.groups[begin:end])
                    if not groups and listed:
                        listed = hashlib.sha256(listed.encode()).hexdigest()
                    code, same = found.code[link_begin:link_end], found.identity[link_begin:link_end]
                    out.append(
                        (found.n_a[i], found.n_b[i], end - begin, link_end - link_begin, listed,
                         (code[same] >> 32).astype("<u4").tobytes(), code[~same].astype("<i8").tobytes())
                    )
                    begin, link_begin = end, link_end
            yield pd.DataFrame(out, columns=["n_a", "n_b", "n_groups", "n_links", "groups", "same", "other"])

    made, row = free_name(keep, "__made"), free_name(keep, "__row")
    linked = docs.select(*keep, link(whole(text)).alias(made))
    return materialize(linked.select(*keep, F.monotonically_increasing_id().alias(row), f"{made}.*"), "links")


def pair_counts(links: DataFrame, shared) -> DataFrame:
    """(code, n): how many links of all texts hold each pair of ids; A's id is above 32 bits."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = _kept(shared.value)
        same = np.zeros(len(pair.to_b), np.int64)
        for batch in batches:
            same += np.bincount(np.frombuffer(b"".join(batch["same"]), "<u4").astype(np.int64), minlength=same.size)
            code, n = np.unique(np.frombuffer(b"".join(batch["other"]), "<i8"), return_counts=True)
            if code.size:
                yield pd.DataFrame({"code": code, "n": n})
        seen = np.flatnonzero(same)
        yield pd.DataFrame({"code": codes_of(seen, pair.to_b[seen]), "n": same[seen]})

    counted = links.select("same", "other").mapInPandas(tally, "code long, n long")
    return materialize(counted.groupBy("code").agg(F.sum("n").alias("n")), "pairs")


def align_tokens(
    docs: DataFrame, keep: list[str], a_path: str, b_path: str, text: str = "text", setup: AlignSetup = AlignSetup(), groups: bool = False
) -> DataFrame:
    """``keep``, then ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A (a byte-level file of ``tokenizers``) encodes a space and the text, B (a model of
    ``sentencepiece``, which adds the space) the text. ``n_best`` counts the links whose pair has the
    highest count of its id of B in the whole table, ``count_sum`` adds the counts of all links.
    With ``groups`` the groups themselves are returned as ``groups`` in place of their digest.

    A NULL or empty text, or one that either tokenizer does not give back, has no tokens: zeros and
    an empty string. Rows are judged each, also if they repeat a key or have none, and repeated
    rows count each. ``keep`` may not hold a name of the results; other columns may have any
    name. An empty table gives an empty result.
    """
    last = "groups" if groups else "groups_sha256"
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", last]
    if clash := {c.lower() for c in keep} & {*names, "groups", "same", "other", "code", "n"}:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        pair = TokenizerPair(a.read(), b.read())
    shared = spark.sparkContext.broadcast(pair)  # as large as the two files
    links = _link_table(docs, keep, text, shared, setup, groups)
    row = links.columns[len(keep)]
    pairs = pair_counts(links, shared)
    pair.open()
    best_of_b = pairs.groupBy(F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")).agg(F.max("n").alias("most"))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    # At most one row for each id of B, one for each id of A, and ``frequent`` rows.
    best = np.zeros(len(pair.b_bytes), np.int64)
    for r in best_of_b.collect():
        best[r.b] = r.most
    mapped = np.flatnonzero(pair.to_b >= 0)
    wanted = spark.createDataFrame(pd.DataFrame({"code": codes_of(mapped, pair.to_b[mapped])}))
    same = np.zeros(len(pair.to_b), np.int64)
    for r in pairs.join(F.broadcast(wanted), "code").collect():
        same[r.code >> 32] = r.n
    often = pairs.filter(F.col("n").cast("double") * setup.frequent >= float(total)).orderBy("code").collect()
    hot, hot_n = np.array([r.code for r in often], np.int64), np.array([r.n for r in often], np.int64)
    tables = spark.sparkContext.broadcast((same, best, hot, hot_n))

    def split(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions among the frequent pairs, and whether each code is one of them."""
        _, _, known, _ = tables.value
        at = np.minimum(np.searchsorted(known, codes), max(known.size - 1, 0))
        return at, known[at] == codes if known.size else np.zeros(codes.size, bool)

    @F.pandas_udf("n_best long, count_sum long")
    def near(identities: pd.Series, others: pd.Series) -> pd.DataFrame:
        total_of, most_of, _, counts = tables.value
        to_b = _kept(shared.value).to_b
        out = []
        for x, y in zip(identities, others, strict=True):
            ids, code = np.frombuffer(x, "<u4").astype(np.int64), np.frombuffer(y, "<i8")
            n = total_of[ids]
            best, summed = int((n == most_of[to_b[ids]]).sum()), int(n.sum())
            at, hit = split(code)
            n = counts[at[hit]]
            out.append((best + int((n == most_of[code[hit] & 0xFFFFFFFF]).sum()), summed + int(n.sum())))
        return pd.DataFrame(out, columns=["n_best", "count_sum"])

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["other"].map(len).to_numpy() // 8
            code = np.frombuffer(b"".join(batch["other"]), "<i8")
            rows = np.repeat(batch["row"].to_numpy(), sizes)
            left = ~split(code)[1]
            if left.any():
                yield pd.DataFrame({"row": rows[left], "code": code[left]}).value_counts(sort=False).reset_index(name="times")

    few = links.select(F.col(row).alias("row"), "other").mapInPandas(rare, "row long, code long, times long")
    few = few.join(pairs, "code").join(F.broadcast(best_of_b), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("b"))
    near_, of, more = (free_name(links.columns, x) for x in ("__near", "__of", "__more"))
    best_of = F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0))
    few = few.groupBy(F.col("row").alias(of)).agg(F.struct(best_of.alias("best"), F.sum(F.col("n") * F.col("times")).alias("sum")).alias(more))
    done = links.select("*", near("same", "other").alias(near_)).join(few, F.col(row) == F.col(of), "left")
    return done.select(
        *keep, "n_a", "n_b", "n_groups", "n_links",
        (F.col(f"{near_}.n_best") + F.coalesce(f"{more}.best", F.lit(0))).alias("n_best"),
        (F.col(f"{near_}.count_sum") + F.coalesce(f"{more}.sum", F.lit(0))).alias("count_sum"),
        F.col("groups").alias(last),
    )
