"""A training corpus from raw documents, in stages that are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least probability of good quality with which a document stays.
QUALITY = 0.7


def _numbered(docs: DataFrame, first: str | None = None) -> tuple[DataFrame, str]:
    """The documents, written with an id of each row, and the id's column.

    Rows may share a ``doc_id`` or have none, so stages that drop documents tell rows apart by this
    id. With ``first`` it is ordered by that column, NULLs last.
    """
    from quern.llm.text import free_name
    from quern.session import materialize

    row = free_name(docs.columns, "row_id")
    number = F.monotonically_increasing_id()
    if first:
        number = F.struct(F.col(first).isNull().alias("none"), F.col(first).alias("first"), number.alias("row"))
    return materialize(docs.withColumn(row, number), "rows"), row


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, accepts."""
    from quern.llm.quality_model import score_quality, train
    from quern.llm.text import free_name

    score = free_name(docs.columns, "quality_score")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, docs.columns, name=score).filter(F.col(score) >= QUALITY).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    from quern.llm.near_duplicates import NearSetup, drop_near_duplicates

    rows, row = _numbered(docs, "doc_id")
    return drop_near_duplicates(rows, row, setup=NearSetup(percent=80)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    from quern.llm.decontaminate import drop_leaks

    rows, row = _numbered(docs)
    return drop_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), row).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    from quern.llm.pii import mask_pii

    return mask_pii(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document, and digests of its ids and of the ids decoded."""
    import public_tokenizers

    from quern.llm.byte_bpe import encode_and_decode

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_and_decode(docs, ["doc_id"], path, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_copies),
    ("benchmark decontamination", decontaminate),
    ("PII", mask_personal_data),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: Trained models, iterated graphs and tokenizers are nothing that SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    from quern.session import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
