"""Column expressions on token arrays, and the fixed ids of the special tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Special tokens and their ids.
UNK, UNK_ID = "<unk>", 0
BOS, BOS_ID = "<s>", 1
EOS, EOS_ID = "<|im_end|>", 2
END_OF_TURN, END_OF_TURN_ID = "<|end_of_turn|>", 32000
PAD, PAD_ID = "<|pad|>", 32001
IM_START, IM_START_ID = "<|im_start|>", 32002

#: Vocabularies below this size are stored in two bytes, others in four.
TWO_BYTE_VOCAB = 65500

#: Storage type codes of the chunk header.
TYPE_CODES = {
    1: "uint8",
    2: "int8",
    3: "int16",
    4: "int32",
    5: "int64",
    6: "float32",
    7: "float64",
    8: "uint16",
}


def token_width(vocab_size: int) -> str:
    """Storage type for ids of a vocabulary: ``uint16`` or ``int32``."""
    return "uint16" if vocab_size < TWO_BYTE_VOCAB else "int32"


def too_narrow(token_size: int, vocab_size: int) -> bool:
    """True when two-byte storage cannot hold every id of the vocabulary."""
    return token_size == 2 and vocab_size >= 65536


def with_specials(
    tokens: Column, bos: int | None = None, eos: int | None = None, max_length: int = -1
) -> Column:
    """Prepend ``bos``, append ``eos`` and, only when both are wanted, cap the length.

    With ``max_length > 0`` and ``eos``, a sequence that already has ``max_length`` tokens
    is cut there and its last token replaced by ``eos``. Without ``eos`` nothing is cut.
    """
    out = tokens if bos is None else F.concat(F.array(F.lit(int(bos))), tokens)
    if eos is None:
        return out
    closing = F.array(F.lit(int(eos)))
    if max_length > 0:
        return F.when(
            F.size(out) >= max_length, F.concat(F.slice(out, 1, max_length - 1), closing)
        ).otherwise(F.concat(out, closing))
    return F.concat(out, closing)


def specials_length(n_tokens: Column, bos: bool, eos: bool, max_length: int = -1) -> Column:
    """Length of :func:`with_specials` from the plain length alone."""
    n = n_tokens + int(bool(bos)) + int(bool(eos))
    return F.least(n, F.lit(max_length)) if eos and max_length > 0 else n


def require_specials(bos: int | None, eos: int | None, add_bos: bool, add_eos: bool) -> None:
    """Fail before running when a wanted special token has no id."""
    for wanted, value, name in ((add_bos, bos, "BOS"), (add_eos, eos, "EOS")):
        if wanted and value is None:
            raise ValueError(f"{name} is wanted but the tokenizer defines no {name} token")


def id_range(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row with the smallest and largest id and whether two bytes can hold them."""
    return df.select(
        F.array_min(tokens).alias("lo"), F.array_max(tokens).alias("hi")
    ).agg(
        F.min("lo").alias("min_id"),
        F.max("hi").alias("max_id"),
        ((F.min("lo") >= 0) & (F.max("hi") <= 65535)).alias("fits_two_bytes"),
    )
