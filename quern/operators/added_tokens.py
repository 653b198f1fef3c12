"""Added tokens inside of texts: found before words are split, by their own rules.

All tokens are one pattern, the longest first, so that a token that another begins with never wins. A token
may take the white space before (``lstrip``) or behind it (``rstrip``), may have to stand alone
(``single_word``), and is looked for in the text as it is, or with ``normalized`` in what the normaliser
makes of the text between the others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.functions.tokens import UNK_ID
from quern.operators import encode
from quern.operators.encode import WordIndex, bounded_rows, flat_lists, ids_by_join, words
from quern.session import materialize, ship_package

_PIECE = "array<struct<piece:string,id:int>>"
#: Rows of a table of added tokens that a query may hold as a pattern.
MOST_TOKENS = 100_000


def _pattern(rows: list) -> str:
    """A Java pattern of the tokens, the longest first; of equal ones the first by name."""
    parts = []
    for r in sorted(rows, key=lambda r: (-len(r.token), r.token)):
        # Java takes what is between these marks as it stands.
        literal = r"\Q" + r.token.replace(r"\E", r"\E\\E\Q") + r"\E"
        literal = rf"(?<!\w){literal}(?!\w)" if r.single_word else literal
        parts.append((r"\s*" if r.lstrip else "") + literal + (r"\s*" if r.rstrip else ""))
    return "(?U)(?:" + "|".join(parts) + ")"


def _cut(text: Column, rows: list) -> Column:
    """(piece, id) of a text in order; ``id`` is NULL for what is between the tokens."""
    if not rows:
        return F.array(F.struct(text.alias("piece"), F.lit(None).cast("int").alias("id"))).cast(_PIECE)
    pattern = _pattern(rows)
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ids = F.create_map(*[x for r in rows for x in (F.lit(r.token), F.lit(r.id))])
    bare = {r.token for r in rows if r.lstrip or r.rstrip}
    of = lambda m: F.coalesce(ids[m], ids[F.regexp_replace(m, r"(?U)^\s+|\s+$", "")]) if bare else ids[m]
    tokens = F.transform(found, lambda m: F.struct(m.alias("piece"), of(m).alias("id")))
    plain = F.transform(between, lambda p: F.struct(p.alias("piece"), F.lit(None).cast("int").alias("id")))
    both = F.flatten(F.transform(F.arrays_zip(plain.alias("p"), tokens.alias("t")), lambda z: F.array(z["p"], z["t"])))
    return F.filter(both, lambda x: x.isNotNull() & (x["id"].isNotNull() | (x["piece"] != ""))).cast(_PIECE)


def split_added(text: Column, tokens: DataFrame, normalize: Callable[[Column], Column] | None = None) -> Column:
    """The pieces (``piece``, ``id``) of a text, cut at the tokens of a table of :func:`read_special_tokens`.

    The table is a configuration of a few dozen rows and becomes part of the query. A NULL text has no pieces.
    """
    rows = tokens.select("token", "id", "normalized", "lstrip", "rstrip", "single_word").where("token <> ''").limit(MOST_TOKENS + 1).collect()
    if len(rows) > MOST_TOKENS:
        raise ValueError(f"more than {MOST_TOKENS} added tokens")
    raw = [r for r in rows if not r.normalized or normalize is None]
    late = [r for r in rows if r.normalized and normalize is not None]
    first = _cut(F.coalesce(text, F.lit("")), raw)
    if normalize is None:
        return first
    again = lambda p: F.when(p["id"].isNotNull(), F.array(p).cast(_PIECE)).otherwise(_cut(normalize(p["piece"]), late))
    return F.flatten(F.transform(first, again))


def token_ids(df: DataFrame, tokens: DataFrame, wanted: str = "token") -> DataFrame:
    """Add ``id`` of the token in ``wanted``; a token that the table does not have fails the job."""
    known = tokens.groupBy(F.col("token").alias("__token")).agg(F.min("id").alias("id"))
    found = df.join(known, F.col(wanted) == F.col("__token"), "left").drop("__token")
    message = F.concat(F.lit("token not in the table: "), F.coalesce(F.col(wanted), F.lit("NULL")))
    return found.withColumn("id", F.coalesce("id", F.raise_error(message).cast("int")))


def encode_added(
    df: DataFrame,
    vocabulary: DataFrame,
    tokens: DataFrame,
    text: str = "text",
    out: str = "tokens",
    unknown: int = UNK_ID,
    normalize: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``out``: ids of a text's words and of the added tokens in it, in order."""
    ship_package(df.sparkSession)
    known = materialize(vocabulary.select("token", "id"), "vocabulary")
    none = F.lit(None).cast("string")
    spread = lambda p: F.when(p["id"].isNotNull(), F.array(F.struct(none.alias("word"), p["id"].alias("id")))).otherwise(
        F.transform(words(p["piece"]), lambda w: F.struct(w.alias("word"), F.lit(None).cast("int").alias("id")))
    )
    listed = F.flatten(F.transform(split_added(F.col(text), tokens, normalize), spread))

    cut = df.withColumn("__pieces", listed)
    word = F.col("__pieces")["word"]
    rows = bounded_rows(known, encode.BROADCAST_ENTRIES)
    if rows is None:
        found = ids_by_join(cut, word, flat_lists, known, "__words", unknown)
    else:
        found = cut.withColumn("__words", _looker(WordIndex(rows), df.sparkSession, unknown)(word))
    ids = F.zip_with(F.col("__pieces")["id"], F.col("__words"), lambda added, word: F.coalesce(added, word))
    return found.withColumn(out, ids).drop("__pieces", "__words")


def _looker(index: WordIndex, spark: SparkSession, unknown: int) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast(index)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            coded = lists.flatten().dictionary_encode()
            own = np.r_[shared.value.look_up(coded.dictionary, unknown), np.int32(unknown)]
            slots = coded.indices.fill_null(len(own) - 1).to_numpy(zero_copy_only=False)
            offsets = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(own[slots].astype(np.int32)))

    return look_up
