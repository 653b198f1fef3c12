"""Text to token ids and back.

A *vocabulary*, a DataFrame ``(token, id)``, maps blank-separated words and can be checked in
plain SQL. A token that it lists more than once has its smallest id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quern.functions.tokens import BOS_ID, END_OF_TURN_ID, EOS_ID, IM_START_ID, PAD_ID, UNK_ID
from quern.operators.ordered import with_position
from quern.session import materialize, ship_package

#: The first ids are taken by the unknown, begin and end tokens.
FIRST_WORD_ID = max(UNK_ID, BOS_ID, EOS_ID) + 1
#: Ids of added tokens, which no word gets.
ADDED_IDS = (END_OF_TURN_ID, PAD_ID, IM_START_ID)
#: A vocabulary up to this many entries, whose tokens have at most this many bytes, is broadcast as sorted arrays
#: (12 bytes an entry and the tokens); of a larger one the smallest ids, which the most frequent words have, are
#: broadcast, and the rest is joined by shuffle.
BROADCAST_ENTRIES = 8_000_000
BROADCAST_BYTES = 128 << 20
#: The same for a broadcast join, whose hash table takes far more memory an entry.
JOIN_ENTRIES = 1_000_000
#: Ids from here down stand for words that the broadcast part does not have; real ids are 32-bit.
_MISSING = -(1 << 40)
#: An id that no vocabulary gives.
_NO_ID = -(1 << 31)


def words(text: Column) -> Column:
    """Blank-separated words of a text."""
    return F.array_remove(F.split(text, " "), "")


def word_vocabulary(df: DataFrame, text: str = "text", size: int | None = None) -> DataFrame:
    """An id for every word, the most frequent first, as ``(token, id)``.

    Stands in for a vocabulary file, of which none is shipped. Counting combines before the
    shuffle. All words are ranked by sorted ranges, so no task sees more than one of them;
    only if ``size`` asks for at most so many ids in all is the rest left to ``<unk>``.
    """
    counted = df.select(F.explode(words(F.col(text))).alias("token")).groupBy("token").count()
    least = counted.select("token", (-F.col("count")).alias("least"))
    if size is not None:
        least = least.orderBy("least", "token").limit(size - FIRST_WORD_ID)
    ranked = with_position(least, ["least", "token"], "rank")
    number = F.col("rank") + FIRST_WORD_ID
    passed = F.when(number >= END_OF_TURN_ID, len(ADDED_IDS)).otherwise(0)
    return ranked.select("token", (number + passed).cast("int").alias("id"))


def one_id(vocabulary: DataFrame) -> DataFrame:
    """The vocabulary with every token once."""
    return vocabulary.groupBy("token").agg(F.min("id").cast("int").alias("id"))


def bounded_rows(df: DataFrame, limit: int) -> pa.Table | None:
    """The rows of ``df``, a stored table, when there are at most ``limit`` with tokens of bounded size, else None."""
    rows, size = _extent(df)
    return df.toArrow() if rows <= limit and size <= BROADCAST_BYTES else None


def _extent(table: DataFrame) -> tuple[int, int]:
    """Number of rows, and bytes of their tokens."""
    return table.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("token")), F.lit(0))).first()


def head_of(table: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, int | None]:
    """(head, rest, largest id of the head) of a stored table: the rows with the smallest ids, and the others.

    The head has at most ``limit`` rows and about half of the table. Without one the largest id is None.
    """
    n, size = _extent(table)
    limit = min(limit, n * BROADCAST_BYTES // max(size, 1))
    if n and limit > 0:
        cut = table.agg(F.percentile_approx("id", F.lit(min(0.5, 0.9 * limit / n)))).first()[0]
        head = table.where(F.col("id") <= F.lit(cut))
        if cut is not None and head.count() <= limit:
            return head, table.where(F.coalesce(F.col("id") > F.lit(cut), F.lit(True))), cut
    return table.limit(0), table, None


class WordIndex:
    """Ids of words as arrays in the order of the words' hashes, which a worker searches as they are.

    A found place counts only if its word is the same one. Words whose hash another word has first are in a dictionary.
    """

    def __init__(self, table: pa.Table):
        table = table.filter(pc.and_(pc.is_valid(table["token"]), pc.is_valid(table["id"]))).combine_chunks()
        tokens, ids = pa.concat_arrays([pa.array([], pa.string()), *table["token"].chunks]), table["id"].to_numpy()
        hashes = _hashes(tokens)
        order = np.argsort(hashes)
        first = np.r_[True, hashes[order][1:] != hashes[order][:-1]][: len(hashes)]
        again = np.flatnonzero(~first)
        # Of words with the same hash, mostly the same word, the one with the smallest id comes first.
        run = np.union1d(again, again - 1)
        order[run] = order[run][np.lexsort((ids[order[run]], hashes[order[run]]))]
        tokens, ids, hashes = tokens.take(pa.array(order)), ids[order], hashes[order]
        place = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))[again]
        other = again[pc.not_equal(tokens.take(pa.array(again)), tokens.take(pa.array(place))).to_numpy(zero_copy_only=False).astype(bool)]
        self._more: dict[str, int] = {}
        for at in other:
            self._more.setdefault(tokens[at].as_py(), int(ids[at]))
        self._tokens, self._hashes = tokens.filter(pa.array(first)), hashes[first]
        self._ids = pa.array(ids[first]).cast(pa.int32()).to_numpy()

    def look_up(self, words: pa.Array, unknown: int, kind: type = np.int32) -> np.ndarray:
        out = np.full(len(words), unknown, kind)
        if not len(self._ids) or not len(words):
            return out
        at = np.minimum(np.searchsorted(self._hashes, _hashes(words)), len(self._ids) - 1)
        same = pc.equal(self._tokens.take(pa.array(at)), words).fill_null(False).to_numpy(zero_copy_only=False)
        out[same] = self._ids[at[same]]
        if self._more:
            for i in np.flatnonzero(~same):
                out[i] = self._more.get(words[i].as_py(), unknown)
        return out


def _hashes(words: pa.Array, step: int = 1 << 16) -> np.ndarray:
    parts = [pd.util.hash_array(words[i : i + step].fill_null("").to_numpy(zero_copy_only=False), categorize=False) for i in range(0, len(words), step)]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


def _flat_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and the row of each."""
    split = pc.split_pattern(texts, " ")
    flat, parent = split.flatten(), pc.list_parent_indices(split)
    real = pc.not_equal(flat, "")
    return flat.filter(real), parent.filter(real).to_numpy(zero_copy_only=False)


def flat_lists(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The items of all lists, and the row of each."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)


def _offsets(parent: np.ndarray, rows: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(parent, minlength=rows))])


def _word_encoder(index: WordIndex, unknown: int) -> Callable[[pa.Array], pa.Array]:
    """A function from a text array to a list<int32> array.

    Words are made distinct within a batch by Arrow, and only the distinct ones are looked up.
    """

    def encode(texts: pa.Array) -> pa.Array:
        flat, parent = _flat_texts(texts)
        coded = flat.dictionary_encode()
        own = index.look_up(coded.dictionary, unknown)
        found = pa.array(own[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int32))
        return pa.ListArray.from_arrays(pa.array(_offsets(parent, len(texts)), pa.int32()), found)

    return encode


def _partly(index: WordIndex, flat: pa.Array, parent: np.ndarray, rows: int, unknown: int) -> pa.StructArray:
    """(ids, rest) of each row: words that the index lacks are once in ``rest``, and their ids say where; NULL is unknown."""
    coded = flat.dictionary_encode()
    own = np.r_[index.look_up(coded.dictionary, _MISSING, np.int64), np.int64(unknown)]
    code = coded.indices.fill_null(len(own) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = own[code]
    missing = ids == _MISSING
    once, at = np.unique(parent[missing] * len(own) + code[missing], return_inverse=True)
    row = once // len(own)
    begin = _offsets(row, rows)
    ids[missing] = _MISSING - (np.arange(len(once)) - begin[row])[at]
    rest = coded.dictionary.take(pa.array(once % len(own)))
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(_offsets(parent, rows), pa.int32()), pa.array(ids)), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), rest)],
        names=["ids", "rest"],
    )


def encode_words(
    df: DataFrame, vocabulary: DataFrame, text: str = "text", tokens: str = "tokens", unknown: int = UNK_ID, keep_text: bool = True
) -> DataFrame:
    """Add ``tokens``: the ids of the words of ``text``, ``unknown`` for words without one.

    A vocabulary of checked size travels once to every worker and the text never leaves its
    partition. A larger vocabulary is joined (:func:`encode_words_by_join`), which writes the rows;
    without ``keep_text`` the text is left out of the result and is not written.
    """
    ship_package(df.sparkSession)
    known = materialize(vocabulary.select("token", "id"), "vocabulary")
    rows = bounded_rows(known, BROADCAST_ENTRIES)
    if rows is None:
        return _encode_by_join(df, known, text, tokens, unknown, keep_text)
    shared = df.sparkSession.sparkContext.broadcast(WordIndex(rows))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = _word_encoder(shared.value, unknown)
        for texts in batches:
            yield run(texts)

    encoded = df.withColumn(tokens, encode(F.coalesce(F.col(text), F.lit(""))))
    return encoded if keep_text else encoded.drop(text)


def encode_words_by_join(
    df: DataFrame, vocabulary: DataFrame, text: str = "text", tokens: str = "tokens", unknown: int = UNK_ID, keep_text: bool = True
) -> DataFrame:
    """As :func:`encode_words` for a vocabulary too large to broadcast."""
    return _encode_by_join(df, materialize(vocabulary.select("token", "id"), "vocabulary"), text, tokens, unknown, keep_text)


def _encode_by_join(df: DataFrame, known: DataFrame, text: str, tokens: str, unknown: int, keep_text: bool) -> DataFrame:
    kept = [c for c in df.columns if keep_text or c != text]
    return ids_by_join(df, F.coalesce(F.col(text), F.lit("")), _flat_texts, known, tokens, unknown, kept)


def ids_by_join(
    df: DataFrame,
    cells: Column,
    flat: Callable[[pa.Array], tuple[pa.Array, np.ndarray]],
    known: DataFrame,
    out: str,
    unknown: int,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add ``out``: the ids of the words that ``flat`` makes of each of ``cells``, by a stored vocabulary ``known``.

    Words of the broadcast head get their ids where they are. Only the others become rows, once for
    each document, so that the most that a single word has is a narrow row a document; they meet the rest of
    the vocabulary in a join and are gathered per document. Of the other columns those of ``keep`` stay, all by default.
    """
    keep = df.columns if keep is None else keep
    ship_package(df.sparkSession)
    head, rest, _ = head_of(known, BROADCAST_ENTRIES)
    shared = df.sparkSession.sparkContext.broadcast(WordIndex(head.toArrow()))

    @F.arrow_udf("struct<ids:array<bigint>,rest:array<string>>")
    def partly(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield _partly(shared.value, *flat(batch), len(batch), unknown)

    keyed = _pin(df.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("__doc"), partly(cells).alias("__e")))
    missing = keyed.select("__doc", F.posexplode("__e.rest").alias("__slot", "token"))
    # Each token once, by the partitioning of the join: the vocabulary is not shuffled for that alone.
    found = missing.join(one_id(rest), "token", "left").select(
        "__doc", F.struct("__slot", F.coalesce("id", F.lit(unknown)).cast("int").alias("id")).alias("__t")
    )
    gathered = found.groupBy("__doc").agg(F.sort_array(F.collect_list("__t"))["id"].alias("__ids"))
    whole = lambda t: F.when(t <= _MISSING, F.get("__ids", (F.lit(_MISSING) - t).cast("int"))).otherwise(t.cast("int"))
    joined = keyed.join(gathered, "__doc", "left").withColumn(out, F.transform("__e.ids", whole))
    return joined.select(*[F.col(f"`{c}`") for c in keep], out)


def _pin(df: DataFrame) -> DataFrame:
    """Write out rows carrying generated keys, which a second evaluation could renumber."""
    return materialize(df, "keyed")


def lookup_ids(
    tokens: DataFrame, vocabulary: DataFrame, broadcast_limit: int = JOIN_ENTRIES
) -> DataFrame:
    """Left join of ``token`` rows with ``(token, id)``; ``id`` is NULL where unknown.

    ``vocabulary`` must list a token once (:func:`one_id`). Of a large one the head is broadcast, and
    only the rows of other tokens are shuffled to the rest.
    """
    vocab = materialize(vocabulary.select("token", "id"), "vocabulary")
    if vocab.count() <= broadcast_limit:
        return tokens.join(F.broadcast(vocab), "token", "left")
    head, rest, cut = head_of(vocab, broadcast_limit)
    if cut is None:
        return tokens.join(rest, "token", "left")
    met = tokens.join(F.broadcast(head), "token", "left")
    return met.where("id IS NOT NULL").unionByName(met.where("id IS NULL").drop("id").join(rest, "token", "left"))


def token_to_id(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """:func:`lookup_ids` that fails the job on the first unknown token."""
    message = F.concat(F.lit("token not in the vocabulary: "), F.col("token"))
    found = lookup_ids(tokens, one_id(vocabulary))
    return found.withColumn("id", F.when(F.col("id").isNull(), F.raise_error(message)).otherwise(F.col("id")))


def encode_known_words(df: DataFrame, vocabulary: DataFrame, text: str = "text", tokens: str = "tokens") -> DataFrame:
    """:func:`encode_words`, without the text, that fails the job on the first word without an id.

    For whole texts: their words become no rows, as those of :func:`token_to_id` are, and meet the vocabulary once.
    """
    ids = encode_words(df, vocabulary, text, tokens, _NO_ID, keep_text=False)
    unknown = F.exists(tokens, lambda t: t == _NO_ID)
    return ids.withColumn(tokens, F.when(unknown, F.raise_error(F.lit("a word is not in the vocabulary"))).otherwise(F.col(tokens)))


def decode_words(
    df: DataFrame,
    vocabulary: DataFrame,
    specials: DataFrame | None = None,
    tokens: str = "tokens",
    text: str = "text",
    skip_special_tokens: bool = False,
) -> DataFrame:
    """Add ``text``: the words of ``tokens`` joined by blanks; unknown ids give ``<unk>``.

    ``specials`` is a ``(token, id)`` table of special tokens, left out of the text when
    ``skip_special_tokens`` is set.
    """
    table = vocabulary.select("token", F.col("id").cast("int"), F.lit(False).alias("special"))
    if specials is not None:
        table = table.unionByName(
            specials.select("token", F.col("id").cast("int"), F.lit(True).alias("special"))
        )
    ship_package(df.sparkSession)
    # Of two tokens with the same id the special one counts, and then the first by name.
    table = table.groupBy("id").agg(F.min_by(F.struct("token", "special"), F.struct(~F.col("special"), F.col("token"))).alias("t")).select("t.token", "id", "t.special")
    table = materialize(table, "names")
    rows = bounded_rows(table, BROADCAST_ENTRIES)
    if rows is None:
        return _decode_by_join(df, table, tokens, text, skip_special_tokens)
    shared = df.sparkSession.sparkContext.broadcast(_name_columns(rows))

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield _decoded(shared.value, lists, None, skip_special_tokens)

    return df.withColumn(text, decode(F.col(tokens)))


def _name_columns(rows: pa.Table) -> list[pa.Array]:
    """Ids in order, their tokens, and whether each is special."""
    if not rows.num_rows:
        return [pa.array([], pa.int32()), pa.array([], pa.string()), pa.array([], pa.bool_())]
    rows = rows.sort_by("id").combine_chunks()
    return [rows[c].combine_chunks() for c in ("id", "token", "special")]


def _decoded(known: list[pa.Array], lists: pa.Array, own: pa.Array | None, skip_special_tokens: bool) -> pa.Array:
    """Texts of lists of ids by the shared columns and, with ``own``, by the names that each row brings along."""
    ids, names, special = known
    ids = ids.to_numpy()
    flat, parent = flat_lists(lists)
    wanted = flat.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
    # The slot behind the shared ones stands for an unknown id, the row's own follow.
    slot = np.minimum(np.searchsorted(ids, wanted), max(len(ids) - 1, 0))
    slot = np.where(ids[slot] == wanted, slot, len(ids)) if len(ids) else np.zeros(len(wanted), np.int64)
    names = pa.concat_arrays([names, pa.array(["<unk>"], pa.string())])
    special = np.r_[special.to_numpy(zero_copy_only=False).astype(bool), False]
    if own is not None:
        items, row = flat_lists(own)
        key = lambda r, i: (r << 33) + i + (1 << 32)
        brought = key(row, items.field("id").cast(pa.int64()).to_numpy(zero_copy_only=False))
        order = np.argsort(brought)
        brought, asked = brought[order], key(parent, wanted)
        at = np.minimum(np.searchsorted(brought, asked), max(len(brought) - 1, 0))
        if len(brought):
            slot = np.where((slot == len(ids)) & (brought[at] == asked), len(names) + order[at], slot)
        names = pa.concat_arrays([names, items.field("token").cast(pa.string())])
        special = np.r_[special, items.field("special").to_numpy(zero_copy_only=False).astype(bool)]
    if skip_special_tokens:
        keep = ~special[slot]
        slot, parent = slot[keep], parent[keep]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(_offsets(parent, len(lists)), pa.int32()), names.take(pa.array(slot))), " ")


def _decode_by_join(
    df: DataFrame, table: DataFrame, tokens: str, text: str, skip_special_tokens: bool
) -> DataFrame:
    """As :func:`decode_words` for a stored ``table`` too large to broadcast: only ids beyond its head are joined, once a row."""
    head, rest, cut = head_of(table, BROADCAST_ENTRIES)
    shared = df.sparkSession.sparkContext.broadcast(_name_columns(head.toArrow()))
    keyed = _pin(df.withColumn("__doc", F.monotonically_increasing_id()))
    beyond = F.col(tokens) if cut is None else F.filter(tokens, lambda t: t > cut)
    missing = keyed.select("__doc", F.explode(F.array_distinct(beyond)).alias("id"))
    gathered = missing.join(rest, "id").groupBy("__doc").agg(F.collect_list(F.struct("id", "token", "special")).alias("__own"))

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lists, own in batches:
            yield _decoded(shared.value, lists, own, skip_special_tokens)

    joined = keyed.join(gathered, "__doc", "left").withColumn(text, decode(F.col(tokens), F.col("__own")))
    return joined.select(*df.columns, text)
