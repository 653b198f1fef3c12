"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words: space and U+0009 to U+000D, nothing else.
SPACES = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def whole(text: Column | str) -> Column:
    """The text itself, empty for NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters that are no white space, as an array; empty without any."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def split_share(key: Column, parts: int) -> Column:
    """CRC-32 of a key as text modulo ``parts``; NULL keys count as the text ``null``."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("null"))), F.lit(parts))


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
