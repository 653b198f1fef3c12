"""Language by compression: the dictionary that shortens a text most names its language.

Each language has a raw-content dictionary of training text. A text is cut into chunks, each
chunk is compressed against every dictionary, and the language with the smallest total wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.session import ship_package


_LETTER = re.compile(r"[^\W\d_]")
_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageSetup:
    """Bounds of the training sample, size of a compressed chunk, and the least margin.

    ``sample_texts`` pieces of ``piece_chars`` characters are taken per language; a
    dictionary keeps at most ``dictionary_bytes``. ``margin`` is the share of the best size by
    which the second must be larger, else the text is rejected. More than ``most_languages``
    labels are an error, as they could not all be broadcast.
    """

    sample_texts: int = 128
    piece_chars: int = 1200
    dictionary_bytes: int = 1 << 17
    chunk_bytes: int = 1 << 13
    margin: float = 0.01
    most_languages: int = 256


@dataclass
class LanguageModel:
    """Dictionaries by language; compressors are made once in each process that uses them."""

    dictionaries: dict[str, bytes]
    #: Training texts by language; of languages that shorten a text alike the more frequent wins.
    texts: dict[str, int]
    setup: LanguageSetup = field(default_factory=LanguageSetup)

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "texts": self.texts, "setup": self.setup}

    def _compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        if not hasattr(self, "_made"):
            # Matches of four bytes are allowed: syllables tell a language, whole words are too rare.
            greedy = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=19, hash_log=17, chain_log=17,
                search_log=3, target_length=0, write_content_size=False,
            )
            self._made = {}
            for lang in sorted(self.dictionaries):
                raw = self.dictionaries[lang]
                data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(compression_params=greedy)
                self._made[lang] = zstandard.ZstdCompressor(dict_data=data, compression_params=greedy)
        return self._made

    def sizes(self, text: str) -> dict[str, int]:
        """Bytes of the whole text under each language's dictionary."""
        raw = normal_form(text)
        step = self.setup.chunk_bytes
        chunks = [raw[i : i + step] for i in range(0, len(raw), step)]
        return {lang: sum(len(c.compress(x)) for x in chunks) for lang, c in self._compressors().items()}

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Best language, score in 0 to 1, and whether the margin is too narrow to trust.

        A NULL text, one without a letter, or a model without languages gives
        ``("und", 0.0, True)``. Ties go to the language with more training texts, then to
        the one that comes first in the alphabet.
        """
        if not text or not self.dictionaries or not _LETTER.search(text):
            return "und", 0.0, True
        order = sorted(self.sizes(text).items(), key=lambda x: (x[1], -self.texts.get(x[0], 0), x[0]))
        if len(order) == 1:
            return order[0][0], 1.0, False
        (best, small), (_, second) = order[:2]
        gap = (second - small) / max(small, 1)
        return best, gap / (gap + self.setup.margin), gap < self.setup.margin


def normal_form(text: str) -> bytes:
    """Lower case, letters only, runs of anything else as one space: the language, not the layout."""
    return f" {_NO_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "surrogatepass")


def train(docs: DataFrame, text: str = "text", lang: str = "lang", setup: LanguageSetup = LanguageSetup()) -> LanguageModel:
    """Dictionaries from texts with a language.

    For each language the pieces with the smallest hashes of their text are taken, so the
    sample does not depend on partitions. Copies count once: hashes are made distinct before
    they are ranked, and Spark keeps at most ``sample_texts`` of them per language and partition
    for that. Pieces come from the middle of a text, where there is least of headers.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0))
    begin = F.greatest(((F.length(text) - setup.piece_chars) / 2).cast("int"), F.lit(0)) + 1
    pieces = known.select(
        F.col(lang).cast("string").alias("lang"),
        F.substring(F.col(text), begin, F.lit(setup.piece_chars)).alias("piece"),
    ).withColumn("order", F.xxhash64("piece"))
    # The smallest hashes first, without their texts; copies are one row by then.
    smallest = (
        pieces.groupBy("lang", "order").count()
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order")))
        .filter(F.col("rank") <= setup.sample_texts)
    )
    bounds = smallest.groupBy("lang").agg(F.max("order").alias("last")).limit(setup.most_languages + 1).collect()
    languages = sorted(r.lang for r in bounds)
    if len(languages) > setup.most_languages:
        raise ValueError(f"more than {setup.most_languages} languages: {len(languages)}")
    last = docs.sparkSession.createDataFrame([tuple(r) for r in bounds], "lang string, last long")
    chosen = pieces.join(F.broadcast(last), "lang").filter(F.col("order") <= F.col("last")).groupBy("lang", "order", "piece").count()
    rows = chosen.select("lang", "order", "piece").collect()
    made = {}
    for one in languages:
        parts = sorted((r.order, r.piece) for r in rows if r.lang == one)
        raw = b"".join(normal_form(p) for _, p in parts)
        # zstd reads a dictionary from its end, where the nearest matches are
        made[one] = raw[: setup.dictionary_bytes]
    counts = {r.lang: r["count"] for r in known.groupBy(F.col(lang).cast("string").alias("lang")).count().collect()}
    return LanguageModel({k: v for k, v in made.items() if len(v) >= 8}, counts, setup)


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, then ``lang_pred``, ``score`` and ``rejected`` for every whole text.

    ``score`` grows with the margin over the second language and is one half at the least
    margin; ``rejected`` marks what is below it. Texts without letters are ``und``; repeated
    rows are classified each; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def classify(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in texts:
            yield pd.DataFrame([own.predict(t) for t in batch], columns=["lang", "score", "rejected"])

    found = docs.select(*keep, classify(F.col(text)).alias("found"))
    return found.select(*keep, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))
