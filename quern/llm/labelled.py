"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.text import split_share


def training_labels(labels: DataFrame, key: str, label: str, parts: int, held_out: int) -> DataFrame:
    """(key, label) of the labels to learn from: one row per key, no NULLs, no held-out keys.

    Of contradictory labels of a key the smallest counts.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    return (
        known.filter(split_share(F.col(key), parts) != held_out)
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
    )


def thinned(rows: DataFrame, by: list, most: int) -> DataFrame:
    """About ``most`` rows, chosen by a hash of ``by``; all rows if there are no more."""
    count = rows.count()
    if count <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64(*by, F.lit("sample")), F.lit(count)) < most)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, parts: int, held_out: int, most: int
) -> DataFrame:
    """(label, text) of at most about ``most`` labelled documents.

    The labels are thinned before the join, so what is broadcast has that many rows however
    many labels there are.
    """
    chosen = thinned(training_labels(labels, key, label, parts, held_out), ["key"], most)
    body = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return body.join(F.broadcast(chosen), "key").select("label", "text")
