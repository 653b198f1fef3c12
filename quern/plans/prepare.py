"""Whole pipelines from documents to packed tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from quern.functions.text import drop_blank
from quern.functions.tokens import BOS_ID, EOS_ID, PAD_ID, require_specials, with_specials
from quern.operators.encode import encode_words
from quern.operators.ordered import ordered_sums, whole_div
from quern.operators.packing import cut_pieces, join_pieces, pack_sequences, padded, with_batches
from quern.operators.sampling import ratio_split
from quern.session import materialize

#: A tokenizer: a ``(token, id)`` vocabulary, or a function adding ``tokens`` to ``text``.
Tokenizer = DataFrame | Callable[[DataFrame], DataFrame]


def tokenize(
    docs: DataFrame,
    tokenizer: Tokenizer,
    bos: int | None = BOS_ID,
    eos: int | None = EOS_ID,
    max_length: int = -1,
) -> DataFrame:
    """Replace ``text`` by ``tokens`` with the wanted special tokens around them."""
    encoded = encode_words(docs, tokenizer, keep_text=False) if isinstance(tokenizer, DataFrame) else tokenizer(docs)
    return encoded.withColumn("tokens", with_specials(F.col("tokens"), bos, eos, max_length)).drop("text")


def prepare_sequences(
    docs: DataFrame,
    tokenizer: Tokenizer,
    seq_length: int = 4096,
    batch_size: int = 1000,
    bos: int | None = BOS_ID,
    eos: int | None = EOS_ID,
    pad: int | None = None,
    source: str = "source",
    order: str = "row_index",
    within: str | None = None,
) -> DataFrame:
    """Documents to sequences of ``seq_length + 1`` tokens, packed within batches of a source.

    Batches begin anew at each source and, with ``within``, at each of its parts, such as the
    ``row_group`` of ``with_row_groups``.

    Text, not tokens, crosses the shuffle that numbers the documents; the tokens are made
    where they are packed. Returns ``(source, within, batch_no, seq_no, tokens, n_real)``.
    """
    pad = eos if pad is None else pad
    require_specials(bos, pad, bos is not None, True)
    groups = [source, within] if within else [source]
    narrow = drop_blank(docs.select(*groups, order, "text"))
    batched = with_batches(narrow, groups, order, batch_size)
    tokens = tokenize(batched, tokenizer, bos, eos)
    return pack_sequences(tokens, [*groups, "batch_no"], order, seq_length, pad)


def prepare_chunks(
    docs: DataFrame,
    tokenizer: Tokenizer,
    chunk_size: int,
    train_ratio: float | str = 1.0,
    pad: int = PAD_ID,
    bos: int | None = BOS_ID,
    eos: int | None = EOS_ID,
    source: str = "source",
    order: str = "row_index",
    splitter: Callable[[DataFrame], DataFrame] | None = None,
    split_within: str | None = None,
) -> DataFrame:
    """Documents to padded chunks: ``(split, source, chunk_no, counter, tokens, n_real)``.

    ``chunk_no`` counts within a split and source, ``counter`` within a split over all sources in
    order, so that the chunks of a split can be files of one prefix. The ratio split counts over
    all documents, by source and order, or starts anew in each group of ``split_within``.
    ``splitter`` may replace it; it adds the column ``split`` to the documents.

    Text is tokenized once, into a table. Splits and offsets are worked out on its narrow
    columns, splits kept as a narrow table too, and joined back by row, so tokens are shuffled
    twice: to meet their offset, by a key that spreads a huge source evenly, and to be assembled.
    """
    narrow = docs.select(source, order, "text")
    ready = tokenize(splitter(narrow) if splitter else narrow, tokenizer, bos, eos)
    numbered = ready.select(
        "*", F.size("tokens").cast("long").alias("__n"), F.monotonically_increasing_id().alias("__row")
    )
    tokens = materialize(numbered, "tokens")
    rows = tokens.drop("tokens")
    # The split is itself an ordered scan; the next one would otherwise repeat it per branch.
    if not splitter:
        group, along = ([split_within], order) if split_within else ([], [source, order])
        rows = materialize(ratio_split(rows, group, along, train_ratio), "split")
    placed = ordered_sums(rows, ["split", source], order, {"start": F.col("__n")})
    whole = tokens.select("__row", "tokens").join(placed, "__row")
    keys = ["split", source]
    chunks = join_pieces(cut_pieces(whole, keys, chunk_size, "chunk_no"), keys, "chunk_no")
    totals = rows.groupBy(*keys).agg(F.sum("__n").alias("n"))
    sizes = totals.withColumn("n", whole_div(F.col("n") + (chunk_size - 1), chunk_size))
    bases = ordered_sums(sizes, "split", source, {"base": F.col("n")}).drop("n")
    bases = bases.select(F.col("split").alias("__split"), F.col(source).alias("__source"), "base")
    of_source = chunks["split"].eqNullSafe(bases["__split"]) & chunks[source].eqNullSafe(bases["__source"])
    numbered = chunks.join(bases, of_source).withColumn("counter", F.col("base") + F.col("chunk_no"))
    return numbered.drop("base", "__split", "__source").withColumn("tokens", padded(F.col("tokens"), chunk_size, pad))
