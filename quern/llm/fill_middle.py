"""Fill-in-the-middle: texts rearranged so that a model learns to write a middle.

A text is a sequence of units, a run of letters or one other character. One full match of the
repeated unit keeps every repetition; the ends of the captures give the number of units and both
cuts. Texts beyond ``window`` characters are matched window by window, so the captures held at a
time stay bounded; windows end between units, and their ends are those of one match.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import free_name, whole
from quern.session import bound_batches, ship_package

#: Possessive, so that no repetition is kept for going back.
UNITS = regex.compile(r"((?>[A-Za-z]+|[^A-Za-z]))*+")
LETTERS = regex.compile(r"[A-Za-z]*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FORMS = ("plain", "psm", "spm")


@dataclass(frozen=True)
class FillSetup:
    """Percent of texts left plain, percent of the others in suffix-first form, and the seed."""

    plain_from: int = 90
    spm_below: int = 20
    seed: str = "1"
    window: int = 1 << 19


def _windows(text: str, window: int) -> Iterator[tuple[int, int]]:
    """Spans of about ``window`` characters that end between units; a run of letters is one unit."""
    begin = 0
    while begin < len(text):
        end = LETTERS.match(text, min(begin + window, len(text))).end()
        yield begin, end
        begin = end


def unit_cuts(text: str, h1: int, h2: int, window: int = FillSetup.window) -> tuple[int, int, int]:
    """(n, first cut, second cut): the number of units, and offsets in characters."""
    if len(text) <= window:
        ends = UNITS.fullmatch(text).ends(1)
        n = len(ends)
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0
    spans = list(_windows(text, window))
    counts = [len(UNITS.fullmatch(text, a, b).ends(1)) for a, b in spans]
    n = sum(counts)

    def offset(units: int) -> int:
        for (a, b), count in zip(spans, counts, strict=True):
            if units <= count:
                return UNITS.fullmatch(text, a, b).ends(1)[units - 1] if units else a
            units -= count
        raise AssertionError("more units than the text has")

    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, offset(low), offset(high)


def rearrange(text: str, h: tuple[int, int, int, int], setup: FillSetup) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix characters, middle characters, output) of one text."""
    n, low, high = unit_cuts(text, h[0], h[1], setup.window)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= setup.plain_from:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < setup.spm_below:
        return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output was made of.

    No text with a mark in it is rearranged, and a mark cannot arise across a border, as it
    begins with the only ``<`` that it has; so the first occurrence of each mark is the one set.
    """
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at = output.index(second, len(first))
    end = output.index(MIDDLE, at + len(second))
    one, two, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + two if form == "psm" else two + middle + one


def draws(key: Column, seed: str) -> list[Column]:
    """The first four groups of eight hexadecimal digits of a key's hash, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, keep: list[str], key: str = "doc_id", text: str = "text", setup: FillSetup = FillSetup()
) -> DataFrame:
    """``keep``, then ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    One row per row of ``docs``, repeated rows included. A NULL text counts as empty and is plain;
    a NULL key counts as the text ``null``. Only ``keep`` is carried over, and no column of it may
    be named like a result; other columns of ``docs`` may have any name. An empty table gives an
    empty result.
    """
    if clash := {c.lower() for c in keep} & {"n", "form", "prefix_chars", "middle_chars", "output"}:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    made = free_name(keep, "__made")

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def arrange(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *hashes in batches:
            rows = [rearrange(t, h, setup) for t, *h in zip(texts, *hashes, strict=True)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    done = docs.select(*keep, arrange(whole(text), *draws(F.col(key), setup.seed)).alias(made))
    return done.select(*keep, *[F.col(f"{made}.{c}").alias(c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")])


def restored(output: Column | str, form: Column | str) -> Column:
    """The texts that outputs of :func:`fill_in_middle` were made of."""

    @F.pandas_udf("string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output, form)
