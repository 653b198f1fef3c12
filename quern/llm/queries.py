"""One query per operator, over whole tables, with the production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.oracles import ORACLES  # noqa: F401
from quern.llm.text import split_share


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned outside a fifth of them."""
    from quern.llm.language import identify, train

    docs = table(spark, folder, "documents")
    held_out = split_share(F.col("doc_id"), 5) == 0
    found = identify(docs, train(docs.filter(~held_out)), ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of every document, learned outside a tenth of them."""
    from quern.llm.language_model import train_and_score

    docs = table(spark, folder, "documents")
    held_out = split_share(F.col("doc_id"), 10) == 0
    scored, model = train_and_score(docs, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, by weak supervision."""
    from quern.llm.toxicity import score_toxicity, train

    docs = table(spark, folder, "documents")
    model, _, _ = train(docs, table(spark, folder, "labels"))
    scored = score_toxicity(docs, model, ["doc_id"])
    return _judged(scored, 0.3)


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document by the byte-level BPE of a public vocabulary, and the ids decoded."""
    import public_tokenizers

    from quern.llm.byte_bpe import encode_and_decode

    docs = table(spark, folder, "documents")
    return encode_and_decode(docs, ["doc_id"], public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, by naive Bayes support vectors."""
    from quern.llm.quality_model import score_quality, train

    docs = table(spark, folder, "documents")
    scored = score_quality(docs, train(docs, table(spark, folder, "labels")), ["doc_id"])
    return _judged(scored, 0.7)


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    held_out = split_share(F.col("doc_id"), 4) == 2
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain four fifths or more of a benchmark item's shingles."""
    from quern.llm.decontaminate import find_leaks

    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    from quern.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and detections of every document."""
    from quern.llm.license_rules import scan_licenses

    found = scan_licenses(table(spark, folder, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.size("detections").cast("long").alias("n_detections"),
    )


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data of every document."""
    from quern.llm.pii import BASE, KINDS, detect_pii, spans_text

    found = detect_pii(table(spark, folder, "documents"), ["doc_id"])

    def count(kind: str) -> Column:
        # A second parameter of the lambda, a default included, would be the position in the array.
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans")
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule failures of every document and the verdict on its host."""
    from quern.llm.quality_rules import score_hosts

    return score_hosts(table(spark, folder, "documents")).withColumn("host_rate", F.round("host_rate", 9))


def op11_embedding_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all embeddings, by NN-descent."""
    from quern.llm.embedding_duplicates import near_vectors

    return near_vectors(table(spark, folder, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut in three and rearranged, with digests of the output and of the text rebuilt from it."""
    from quern.llm.fill_middle import fill_in_middle, restored

    made = fill_in_middle(table(spark, folder, "documents"), ["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


def op13_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two public tokenizers in every document."""
    import public_tokenizers

    from quern.llm.cross_tokens import align_tokens

    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokens(table(spark, folder, "documents"), ["doc_id"], *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_lm_score,
        op3_toxicity,
        op4_benchmark_decontamination,
        op5_near_duplicates,
        op6_license_scan,
        op7_pii,
        op8_byte_bpe,
        op9_quality_classifier,
        op10_quality_rules,
        op11_embedding_near_duplicates,
        op12_fill_in_middle,
        op13_cross_tokenizer_alignment,
    )
}
