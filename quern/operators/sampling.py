"""Splitting, subsampling, sharding, shuffling and mixing, all seeded and deterministic."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quern.functions.text import subset_rank
from quern.operators.ordered import seeded_block, seeded_key, whole_div, with_ordinal
from quern.sources.paths import spread

#: Hash draws are integers below this bound.
DRAW_RANGE = 1 << 32
#: Draws that are made from one row.
DRAW_BLOCK = 1 << 16
#: Ratios are exact fractions; a larger denominator is refused.
MAX_DENOMINATOR = 10**9


def limit_files(files: DataFrame, k: int, path: str = "path") -> DataFrame:
    """The first ``k`` files by path."""
    return files.orderBy(path).limit(k)


def ratio_split(
    df: DataFrame, group: str | Sequence[str], order: str | Sequence[str], ratio: float | str, name: str = "split"
) -> DataFrame:
    """Send each document to 'train' or 'validation' so that every prefix keeps the ratio.

    A document goes to train while the share of train among the earlier ones, counted with
    this one as denominator, is below the ratio. With the ratio as an exact fraction p/q the
    number of train documents among the first d is ceil(p·d/q), so document d is validation
    exactly when that count does not grow. Integer arithmetic throughout.
    """
    share = Fraction(str(ratio))
    if not 0 <= share <= 1:
        raise ValueError("ratio must lie between 0 and 1")
    if share.denominator > MAX_DENOMINATOR:
        raise ValueError(f"ratio {ratio} is no fraction with a denominator of at most {MAX_DENOMINATOR}")
    if share == 1:
        return df.withColumn(name, F.lit("train"))
    p, q = share.numerator, share.denominator
    ranked = with_ordinal(df, group, order, name="__before")
    # The count of train documents grows by p with every q documents: only d mod q matters,
    # which also keeps the products within a long.
    inside = F.col("__before") % q
    before = whole_div(inside * p + (q - 1), q)
    upto = whole_div((inside + 1) * p + (q - 1), q)
    return ranked.withColumn(
        name, F.when(before == upto, F.lit("validation")).otherwise(F.lit("train"))
    ).drop("__before")


def shuffle_files(files: DataFrame, seed: int, path: str = "path", name: str = "position") -> DataFrame:
    """Add a zero-based ``position`` in a seeded random order of the files."""
    keyed = files.withColumn("__key", seeded_key(seed, path))
    ranked = with_ordinal(keyed, [], ["__key", path], name, block=seeded_block(F.col("__key")))
    return ranked.drop("__key")


def subsample_files(
    files: DataFrame, percentage: float, split_ratio: float, seed: int = 888, path: str = "path"
) -> DataFrame:
    """Keep ``percentage / split_ratio`` of the files, drawn without replacement.

    The count is rounded half to even. A rate above one leaves the files as they are.
    """
    rate = percentage / split_ratio
    if rate > 1.0:
        return files
    keyed = files.withColumn("__key", seeded_key(seed, path))
    ranked = with_ordinal(
        keyed, [], ["__key", path], "__rank", total="__files", block=seeded_block(F.col("__key"))
    )
    kept = ranked.where(F.col("__rank") < F.bround(F.col("__files") * F.lit(rate), 0))
    return kept.select(*files.columns)


def split_even(files: DataFrame, n: int, order: str = "path", name: str = "slice_no") -> DataFrame:
    """Cut the ordered files into ``n`` runs whose sizes differ by at most one, larger first."""
    ranked = with_ordinal(files, [], order, "__rank", total="__files")
    small = whole_div(F.col("__files"), n)
    longer = F.col("__files") % n
    border = longer * (small + 1)
    slice_no = F.when(
        F.col("__rank") < border, whole_div(F.col("__rank"), small + 1)
    ).otherwise(longer + whole_div(F.col("__rank") - border, F.greatest(small, F.lit(1))))
    return ranked.withColumn(name, slice_no.cast("long")).drop("__rank", "__files")


def assign_shards(files: DataFrame, n_shards: int, order: str = "path") -> DataFrame:
    """Deal the ordered files to shards in turn; the last incomplete round is left out.

    Adds ``shard`` and ``file_no``, the file's position within its shard, and
    ``files_in_shard``.
    """
    ranked = with_ordinal(files, [], order, "__rank", total="__files")
    rounds = whole_div(F.col("__files"), n_shards)
    kept = ranked.where(F.col("__rank") < rounds * n_shards)
    return kept.select(
        *files.columns,
        (F.col("__rank") % n_shards).alias("shard"),
        whole_div(F.col("__rank"), n_shards).alias("file_no"),
        rounds.alias("files_in_shard"),
    )


def order_subsets(files: DataFrame, subset: str = "subset", path: str = "path") -> DataFrame:
    """Train, then validation, then test, then unlabelled files, each by path."""
    return files.orderBy(subset_rank(F.col(subset)), path)


def repeat_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch: a bounded form of starting over at the end."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def block_permutation(seed: int, epoch: Column, run: Column, blocks: Column | int) -> Column:
    """The numbers 0 to ``blocks`` - 1 of a run in their shuffled order, as an array."""
    prefix = F.concat_ws("-", F.lit(str(seed)), epoch, run)
    indices = F.sequence(F.lit(0), (blocks if isinstance(blocks, Column) else F.lit(blocks)) - 1)
    keyed = F.transform(indices, lambda i: F.struct(F.md5(F.concat_ws("-", prefix, i)).alias("k"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda e: e["i"])


def shuffle_blocks(
    chunks: DataFrame,
    n_chunks: int,
    block_size: int,
    chunk_size: int,
    seed: int,
    tokens: str = "tokens",
) -> DataFrame:
    """Blocks of each run of ``n_chunks`` consecutive chunks of a shard, in shuffled order.

    Expects ``shard, file_no, files_in_shard``, optionally ``epoch``, one chunk per row. The
    permutation of a run is a function of seed, epoch and run number, so every chunk works out
    the positions of its own blocks: no shuffle, and tokens never leave their partition. A last
    run of fewer than ``n_chunks`` chunks is left out. ``position`` counts within the run.
    """
    n_blocks = chunk_size // block_size
    if n_blocks < 1:
        raise ValueError("a chunk holds no full block")
    source = chunks if "epoch" in chunks.columns else chunks.withColumn("epoch", F.lit(0))
    run = whole_div(F.col("file_no"), n_chunks)
    in_run = (F.col("file_no") % n_chunks).cast("int")
    complete = whole_div(F.col("files_in_shard"), n_chunks)
    others = [c for c in source.columns if c not in (tokens, "files_in_shard")]
    base = source.where(run < complete).select(
        *others, tokens, run.alias("run_no"), in_run.alias("__chunk")
    )
    shuffled = block_permutation(seed, F.col("epoch"), F.col("run_no"), n_chunks * n_blocks)
    placed = F.transform(shuffled, lambda i, p: F.struct(p.alias("position"), i.alias("i")))
    mine = F.filter(placed, lambda e: whole_div(e["i"], n_blocks) == F.col("__chunk"))
    spread = base.select(*others, "run_no", tokens, F.explode(mine).alias("__e"))
    block_no = F.col("__e.i") % n_blocks
    return spread.select(
        *others,
        "run_no",
        F.col("__e.position").cast("long").alias("position"),
        block_no.cast("long").alias("block_no"),
        F.slice(tokens, block_no * block_size + 1, block_size).cast("array<bigint>").alias(tokens),
    )


def mix(
    datasets: Sequence[DataFrame],
    order: str,
    weights: Sequence[float] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Draw from several datasets at random by weight until one of them runs out.

    Draw i picks a dataset by a hash of (seed, i); the k-th draw of a dataset takes its k-th
    row by ``order``. The output ends before the first draw that finds its dataset exhausted.
    Adds ``draw_no`` and ``dataset``. All datasets share their columns. With more draws than rows some
    dataset is always exhausted, so the end is found exactly. Sizes, the number of draws and the end are
    parts of the query, so for a numeric ``order`` no job runs while it is built.
    """
    weights = list(weights or [1.0] * len(datasets))
    if len(weights) != len(datasets) or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("one non-negative weight per dataset, not all zero")
    rows = reduce(
        DataFrame.unionByName, [d.withColumn("dataset", F.lit(j)) for j, d in enumerate(datasets)]
    )
    sizes = rows.groupBy("dataset").agg(F.count("*").alias("__size"))
    ranked = with_ordinal(rows, ["dataset"], order, "__k")

    draw = F.conv(F.substring(seeded_key(seed, "draw_no"), 1, 8), 16, 10).cast("long")
    bounds = _cumulative(weights)
    pick = F.lit(len(datasets) - 1)
    for j in reversed(range(len(datasets) - 1)):
        pick = F.when(draw < bounds[j], F.lit(j)).otherwise(pick)
    # Draws come in blocks, whose number is known when the query runs; a block is a row until it is dealt.
    last = whole_div(F.coalesce(F.sum("__size"), F.lit(0)).cast("long"), DRAW_BLOCK)
    blocks = sizes.agg(F.sequence(F.lit(0).cast("long"), last).alias("__blocks")).select(F.explode("__blocks").alias("__block"))
    first = F.col("__block") * DRAW_BLOCK
    draws = spread(blocks, "__block").select(F.explode(F.sequence(first, first + (DRAW_BLOCK - 1))).alias("draw_no"))
    numbered = with_ordinal(draws.withColumn("dataset", pick), ["dataset"], "draw_no", "__k")
    # A dataset without rows has no size here, and is exhausted at its first draw.
    missed = numbered.join(sizes, "dataset", "left").where(F.col("__k") == F.coalesce("__size", F.lit(0)))
    end = missed.agg(F.min("draw_no").alias("end"))
    taken = numbered.where(F.col("draw_no") < end.scalar())
    joined = ranked.join(taken, ["dataset", "__k"])
    return joined.select("draw_no", "dataset", *datasets[0].columns)


def _cumulative(weights: Sequence[float]) -> list[int]:
    """Upper draw bounds of each dataset, as integers below :data:`DRAW_RANGE`."""
    shares = [Fraction(str(w)) for w in weights]
    total, running, out = sum(shares), Fraction(0), []
    for share in shares:
        running += share
        out.append(int(running / total * DRAW_RANGE))
    return out


