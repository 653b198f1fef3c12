"""Benchmark items inside long documents, by size-partitioned MinHash containment search.

An item is small and a document is long, so their Jaccard similarity says little; what is
asked is the share of the item's shingles that the document has. Items are put into
partitions by the size of their shingle sets. The sketch of an item is its bottom-k MinHash,
the k shingles with the smallest hashes, where k is chosen for the partition so that a
document with the asked containment has at least one of them: of n shingles at most
``floor((1 - t) n)`` may be missing, so ``floor((1 - t) n) + 1`` cannot all be. Documents are
probed with all their shingle hashes; each pair found is verified on the whole sets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import whole, words
from quern.session import materialize


@dataclass(frozen=True)
class Containment:
    """Words per shingle, least containment in percent, and the most sketch rows to broadcast."""

    width: int = 5
    percent: int = 80
    broadcast_rows: int = 1_000_000


def _hash_at(array: str, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(array, at + i) for i in range(width)])


def _shingle_at(array: str, at: Column, width: int) -> Column:
    return F.concat_ws(" ", *[F.get(array, at + i) for i in range(width)])


def _positions(array: str, width: int) -> Column:
    """Where shingles start; one position for a sequence shorter than a shingle, none for no words."""
    n = F.size(array)
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))))


def item_sketches(items: DataFrame, item: str = "item_id", text: str = "text", setup: Containment = Containment()):
    """The items' shingle sets, and their sketches with the partition and its least document size.

    Returns two tables: (item, n_item, hashes) and (item, partition, least, hash). Items with
    the same id are one item per distinct text; items without words are left out.
    """
    body = items.filter(F.col(item).isNotNull()).select(F.col(item).alias("item"), words(F.lower(whole(text))).alias("w"))
    sets = (
        body.filter(F.size("w") > 0)
        .select("item", F.transform(_positions("w", setup.width), lambda i: F.struct(_hash_at("w", i, setup.width).alias("h"), _shingle_at("w", i, setup.width).alias("s"))).alias("p"))
        .select(
            "item",
            F.array_sort(F.array_distinct(F.transform("p", lambda p: p["h"]))).alias("hashes"),
            F.array_sort(F.array_distinct(F.transform("p", lambda p: p["s"]))).alias("shingles"),
        )
        .dropDuplicates(["item", "hashes"])
        .withColumn("n_item", F.size("shingles"))
    )
    sets = materialize(sets, "items")
    # Partition j has sets of 2^j to 2^(j+1) - 1 shingles.
    partition = F.floor(F.log2(F.col("n_item"))).cast("int")
    missing = F.floor(F.col("n_item") * (100 - setup.percent) / 100).cast("int")
    sketch = sets.select(
        "item",
        "n_item",
        partition.alias("partition"),
        F.ceil(F.pow(F.lit(2.0), partition) * setup.percent / 100).cast("int").alias("least"),
        F.explode(F.slice("hashes", F.lit(1), missing + 1)).alias("hash"),
    )
    return sets, sketch


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    setup: Containment = Containment(),
) -> DataFrame:
    """Pairs of documents and items that they contain.

    Returns (key, item, n_item, n_found, containment), one row per pair of ids with at least
    ``percent`` of the item's distinct shingles in the document; of several rows or texts with
    the same ids the best counts. Words are compared in lower case. An item of fewer words than
    a shingle is one shingle, found only in documents of just these words. Documents or items
    without words, and items with a NULL id, match nothing; documents with a NULL key are
    reported under NULL. Either table may be empty.

    Sketches are broadcast only if their counted rows are within ``broadcast_rows``; beyond
    that Spark joins by the hash. No pair of documents is ever formed.
    """
    sets, sketch = item_sketches(items, item, item_text, setup)
    # One row per hash: a passage that many items share is still one probe.
    probes = materialize(
        sketch.groupBy("hash").agg(F.collect_set(F.struct("item", "least")).alias("owners")), "sketches"
    )
    bounded = probes.count() <= setup.broadcast_rows
    low = F.lower(whole(text))
    body = docs.select(F.col(key).alias("key"), F.xxhash64(low).alias("text_id"), words(low).alias("w"))
    shingles = body.select("key", "text_id", F.size("w").alias("n_words"), "w", F.explode(_positions("w", setup.width)).alias("at"))
    hashed = shingles.select("key", "text_id", "n_words", _hash_at("w", F.col("at"), setup.width).alias("hash"))
    hits = hashed.join(F.broadcast(probes) if bounded else probes, "hash")
    pairs = materialize(
        hits.select("key", "text_id", "n_words", F.explode("owners").alias("o"))
        .filter(F.greatest(F.col("n_words") - (setup.width - 1), F.lit(1)) >= F.col("o.least"))
        .select("key", "text_id", F.col("o.item").alias("item"))
        .distinct(),
        "candidates",
    )
    # Verified once per text and item: exact copies share their text_id.
    wanted = pairs.select("text_id").distinct()
    texts = (
        docs.select(F.xxhash64(F.lower(whole(text))).alias("text_id"), F.col(text).alias("body"))
        .join(wanted, "text_id", "left_semi")
        .dropDuplicates(["text_id"])
        .select("text_id", words(F.lower(whole("body"))).alias("w"))
        .select("text_id", F.array_distinct(F.transform(_positions("w", setup.width), lambda i: _shingle_at("w", i, setup.width))).alias("has"))
    )
    checked = (
        pairs.select("text_id", "item").distinct()
        .join(sets.select("item", "shingles", "n_item"), "item")
        .join(texts, "text_id")
        .select("text_id", "item", "n_item", F.size(F.array_intersect("shingles", "has")).alias("n_found"))
        .filter(F.col("n_found") * 100 >= F.col("n_item") * setup.percent)
    )
    best = pairs.join(checked, ["text_id", "item"]).groupBy("key", "item").agg(
        F.max_by(F.struct("n_found", "n_item"), F.struct(F.col("n_found") / F.col("n_item"), F.col("n_item"))).alias("b")
    )
    return best.select(
        F.col("key").alias(key),
        F.col("item").alias(item),
        F.col("b.n_item").cast("long").alias("n_item"),
        F.col("b.n_found").cast("long").alias("n_found"),
        (F.col("b.n_found") / F.col("b.n_item")).alias("containment"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", setup: Containment = Containment()) -> DataFrame:
    """The documents that contain no item; the columns stay as they are."""
    leaked = find_leaks(docs, items, key, text, setup=setup).select(F.col(key).alias("__leaked")).distinct()
    return docs.join(leaked, docs[key].eqNullSafe(leaked["__leaked"]), "left_anti")
