"""Packing token arrays into fixed-length sequences, chunks and blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quern.operators.ordered import _as_list, ordered_sums, whole_div, with_ordinal

#: Default context window and number of sequences per chunk; each sequence carries one
#: extra token because the last position predicts the next one.
CONTEXT_LENGTH = 16384
SEQUENCES_PER_CHUNK = 1024


def chunk_size_for(context: int = CONTEXT_LENGTH, sequences: int = SEQUENCES_PER_CHUNK) -> int:
    return (context + 1) * sequences


def with_batches(
    df: DataFrame, group: str | Sequence[str], order: str, batch_size: int, name: str = "batch_no"
) -> DataFrame:
    """Number consecutive documents of a group into batches of ``batch_size``."""
    out = with_ordinal(df, group, order, name="__ordinal")
    return out.withColumn(name, whole_div(F.col("__ordinal"), batch_size)).drop("__ordinal")


def cut_pieces(
    df: DataFrame, keys: Sequence[str], size: int, number: str, tokens: str = "tokens", start: str = "start"
) -> DataFrame:
    """Split each row's tokens at multiples of ``size`` of the running offset ``start``.

    A row of n tokens gives at most ``n/size + 2`` pieces, each with its first position.
    """
    n = F.size(tokens)
    first = whole_div(F.col(start), size)
    last = whole_div(F.col(start) + n - 1, size)
    spread = df.where(n > 0).select(
        *keys, start, tokens, F.explode(F.sequence(first, last)).alias(number)
    )
    low = F.greatest(F.col(start), F.col(number) * size)
    high = F.least(F.col(start) + F.size(tokens), (F.col(number) + 1) * size)
    piece = F.slice(tokens, (low - F.col(start) + 1).cast("int"), (high - low).cast("int"))
    return spread.select(*keys, number, low.alias("__low"), piece.alias("__piece"))


def join_pieces(pieces: DataFrame, keys: Sequence[str], number: str, tokens: str = "tokens") -> DataFrame:
    """Concatenate the pieces of each ``(keys, number)`` in order; adds ``n_real``.

    What one group collects is bounded by the packed length, never by the size of a source.
    """
    gathered = pieces.groupBy(*keys, number).agg(
        F.sort_array(F.collect_list(F.struct("__low", "__piece"))).alias("__pieces")
    )
    packed = gathered.select(*keys, number, F.flatten(F.col("__pieces.__piece")).alias(tokens))
    return packed.withColumn("n_real", F.size(tokens))


def padded(tokens: Column, size: int, pad: int | Column) -> Column:
    pad = pad if isinstance(pad, Column) else F.lit(int(pad))
    return F.concat(tokens, F.array_repeat(pad.cast("int"), F.lit(size) - F.size(tokens)))


def pack_chunks(
    df: DataFrame,
    group: str | Sequence[str],
    order: str,
    chunk_size: int,
    pad: int,
    tokens: str = "tokens",
    length: Column | None = None,
) -> DataFrame:
    """Concatenate each group's documents and cut every ``chunk_size`` tokens.

    The last chunk of a group is padded with ``pad``; no chunk is made of padding alone.
    ``length`` may give the token count by a cheaper expression than ``tokens`` itself, so
    that the pass over block totals does not tokenize.
    """
    groups = _as_list(group)
    length = F.size(tokens) if length is None else length
    narrow = df.select(*groups, order, tokens, length.alias("__n"))
    laid_out = ordered_sums(narrow, groups, order, {"start": F.col("__n")})
    packed = join_pieces(cut_pieces(laid_out, groups, chunk_size, "chunk_no", tokens), groups, "chunk_no", tokens)
    return packed.withColumn(tokens, padded(F.col(tokens), chunk_size, pad))


def pack_sequences(
    df: DataFrame,
    group: str | Sequence[str],
    order: str,
    seq_length: int,
    pad: int,
    tail: tuple[int, int] = (8, 10),
    tokens: str = "tokens",
) -> DataFrame:
    """Concatenate each group's documents into sequences of ``seq_length + 1`` tokens.

    A shorter tail is kept, padded with ``pad``, when it holds at least ``tail`` (a ratio of
    integers) of a full sequence, and dropped otherwise. Groups are batches of bounded size
    (:func:`with_batches`), so one window per group is bounded too, and the hash
    partitioning on the group also serves the final assembly: one shuffle for both.
    """
    groups, size = _as_list(group), seq_length + 1
    order_window = (
        Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    n = F.size(tokens).cast("long")
    laid_out = df.select(*groups, order, tokens, (F.sum(n).over(order_window) - n).alias("start"))
    packed = join_pieces(cut_pieces(laid_out, groups, size, "seq_no", tokens), groups, "seq_no", tokens)
    kept = packed.where(F.col("n_real") * tail[1] >= tail[0] * size)
    return kept.withColumn(tokens, padded(F.col(tokens), size, pad))


def explode_blocks(df: DataFrame, block_size: int, tokens: str = "tokens") -> DataFrame:
    """One row per full block of each chunk, widened to 64 bits; the rest of a chunk is ignored."""
    n_blocks = whole_div(F.size(tokens), block_size).cast("int")
    others = [c for c in df.columns if c != tokens]
    spread = df.where(n_blocks > 0).select(
        *others, tokens, F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block_no")
    )
    block = F.slice(tokens, F.col("block_no") * block_size + 1, block_size).cast("array<bigint>")
    return spread.select(*others, F.col("block_no").cast("long").alias("block_no"), block.alias(tokens))
