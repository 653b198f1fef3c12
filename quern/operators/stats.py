"""Counts, totals and metadata of a prepared corpus, and error quarantine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def docs_per_source(docs: DataFrame, source: str = "source") -> DataFrame:
    return docs.groupBy(source).agg(F.count("*").alias("n_docs"))


def corpus_totals(packed: DataFrame, tokens: str = "tokens", source: str = "source") -> DataFrame:
    """One row: sequences, tokens and files.

    Sources are first reduced to one row each, so the distinct count never has to hold
    the rows of a large source.
    """
    per_source = packed.groupBy(source).agg(
        F.count("*").alias("n"), F.sum(F.size(tokens).cast("long")).alias("t")
    )
    return per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_sequences"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("total_tokens"),
        F.count("*").alias("total_files"),
    )


def chunk_totals(docs: DataFrame, length: Column, chunk_size: int, source: str = "source") -> DataFrame:
    """What :func:`corpus_totals` gives for chunks packed by source, from the documents' lengths alone.

    A source of n tokens fills ``ceil(n / chunk_size)`` chunks, the last one padded; so nothing has to
    be encoded or packed to know the totals.
    """
    per_source = docs.groupBy(source).agg(F.sum(length.cast("long")).alias("t")).where("t > 0")
    chunks = F.call_function("div", F.col("t") + F.lit(chunk_size - 1), F.lit(chunk_size))
    return per_source.agg(
        F.coalesce(F.sum(chunks), F.lit(0)).alias("total_sequences"),
        F.coalesce(F.sum(chunks * chunk_size), F.lit(0)).alias("total_tokens"),
        F.count("*").alias("total_files"),
    )


def subset_stats(files: DataFrame, subset: str = "subset", size: str = "bytes") -> DataFrame:
    """Files, bytes and a readable size per subset."""
    stats = files.groupBy(subset).agg(
        F.count("*").alias("files"), F.sum(F.col(size).cast("long")).alias("total_size_bytes")
    )
    gigabytes = F.col("total_size_bytes") / F.lit(float(1024**3))
    return stats.withColumn("total_size_human", F.format_string("%.2f GB", gigabytes))


def file_counts(files: DataFrame, by: str = "ext") -> DataFrame:
    return files.groupBy(by).agg(F.count("*").alias("files"))


def corpus_metadata(
    packed: DataFrame, shard_files: DataFrame, settings: Mapping[str, object], source: str = "source"
) -> DataFrame:
    """One row of corpus metadata: settings, totals and a map of per-subset statistics.

    Only the totals, one row, and the subsets, three at most plus unlabelled files, meet.
    """
    labelled = subset_stats(shard_files.where(F.col("subset") != ""))
    entry = F.struct("files", "total_size_bytes", "total_size_human")
    by_subset = labelled.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("subset", entry)))).alias("subset_stats")
    )
    totals = corpus_totals(packed, source=source).select(
        *[F.lit(v).alias(k) for k, v in settings.items()],
        "total_sequences",
        "total_tokens",
        F.col("total_files").alias("total_files_processed"),
    )
    both = totals.unionByName(by_subset, allowMissingColumns=True)
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])


def with_quarantine(df: DataFrame, valid: Column, text: str, stage: str) -> tuple[DataFrame, DataFrame]:
    """Split into good rows and quarantined ones.

    Quarantined rows keep their key columns, the stage that refused them and the first fifty
    characters of the text, so a bad row is reported and counted but never stops a run.
    """
    ok = F.coalesce(valid, F.lit(False))
    keys = [c for c in df.columns if c != text]
    bad = df.where(~ok).select(
        *keys, F.lit(stage).alias("stage"), F.substring(F.col(text), 1, 50).alias("excerpt")
    )
    return df.where(ok), bad


def error_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("stage").agg(F.count("*").alias("errors"))


def skip_existing(files: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """Files that are not among those already done."""
    return files.join(done.select(key).distinct(), key, "left_anti")
