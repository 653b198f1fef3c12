"""Blocks of packed files, read by byte ranges.

A *plan* is a narrow table with one row per block: its file, byte range and place in the shuffled order. It
is made from names and 24-byte headers, so filters on shard, run, epoch or block are applied with an
ordinary ``where`` before a single token is read. Reading a plan then touches the ranges it lists
and nothing else. The endless form derives the same plan from a stream of run numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quern.operators.ordered import whole_div
from quern.operators.sampling import assign_shards, block_permutation
from quern.session import materialize, ship_package
from quern.sources.packed import HEADER_SIZE, parse_header
from quern.sources.paths import filesystem, spread

_PLAN = ["path", "epoch", "shard", "file_no", "run_no", "position", "block_no", "dtype", "begin", "length"]


def packed_headers(files: DataFrame) -> DataFrame:
    """(path, dtype, itemsize, chunk_size) of packed files; a malformed or short file fails the job."""
    ship_package(files.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_header(p) for p in batch["path"]], columns=["path", "dtype", "itemsize", "chunk_size"])

    return spread(files.select("path"), "path").mapInPandas(read, "path string, dtype string, itemsize int, chunk_size long")


def _header(path: str) -> tuple[str, str, int, int]:
    files, place = filesystem(path)
    with files.open_input_file(place) as file:
        dtype, chunk_size = parse_header(file.read_at(HEADER_SIZE, 0))
        size = np.dtype(dtype).itemsize
        if file.size() != HEADER_SIZE + size * chunk_size:
            raise ValueError(f"{path}: {file.size()} bytes, header says {chunk_size} ids of {size}")
    return path, dtype, size, chunk_size


def run_files(files: DataFrame, n_shards: int, n_chunks: int, block_size: int) -> DataFrame:
    """The files of complete runs, dealt to shards, with what their headers say; as a table.

    All files of a run must hold as many blocks, as its blocks are shuffled together.
    """
    dealt = assign_shards(files.select("path"), n_shards).join(packed_headers(files), "path")
    run = whole_div(F.col("file_no"), n_chunks)
    placed = dealt.where(run < whole_div(F.col("files_in_shard"), n_chunks)).select(
        "path", "shard", "file_no", run.alias("run_no"), (F.col("file_no") % n_chunks).cast("int").alias("chunk"),
        "dtype", "itemsize", whole_div(F.col("chunk_size"), block_size).cast("int").alias("n_blocks"),
    )
    return materialize(placed, "runs")


def _runs(files: DataFrame) -> DataFrame:
    """(run_no, n_blocks) of every run."""
    least, most = F.min("n_blocks"), F.max("n_blocks")
    alike = F.when((least == most) & (least > 0), least).otherwise(
        F.raise_error(F.concat(F.lit("files without a block or of unlike size in run "), F.col("run_no").cast("string"))).cast("int")
    )
    return files.groupBy("run_no").agg(alike.alias("n_blocks"))


def _placed(runs: DataFrame, files: DataFrame, n_chunks: int, block_size: int, seed: int) -> DataFrame:
    order = block_permutation(seed, F.col("epoch"), F.col("run_no"), F.col("n_blocks") * n_chunks)
    spread_out = runs.select("epoch", "run_no", "n_blocks", F.posexplode(order).alias("position", "__i"))
    block = F.col("__i") % F.col("n_blocks")
    chosen = spread_out.select(
        "epoch", "run_no", F.col("position").cast("long").alias("position"), block.cast("long").alias("block_no"),
        whole_div(F.col("__i"), F.col("n_blocks")).cast("int").alias("chunk"),
    )
    met = chosen.join(files, ["run_no", "chunk"])
    begin = F.lit(HEADER_SIZE) + F.col("block_no") * F.col("itemsize") * block_size
    return met.withColumn("begin", begin).withColumn("length", (F.col("itemsize") * block_size).cast("long")).select(*_PLAN)


def block_plan(files: DataFrame, n_shards: int, n_chunks: int, block_size: int, seed: int, epochs: int = 1) -> DataFrame:
    """One row per block of ``files`` (``path``) in the order that ``shuffle_blocks`` gives to loaded chunks.

    (path, epoch, shard, file_no, run_no, position, block_no, dtype, begin, length). Nothing but headers has
    been read. An incomplete last round of shards and an incomplete last run are left out.
    """
    placed = run_files(files, n_shards, n_chunks, block_size)
    runs = _runs(placed).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))))
    return _placed(runs, placed, n_chunks, block_size, seed)


def read_blocks(plan: DataFrame, tokens: str = "tokens") -> DataFrame:
    """The plan's rows with ``tokens``, the ids of each block as 64-bit integers.

    A task has whole files' blocks where the plan was dealt by :func:`by_file`, and reads each range once.
    Blocks of several files share a frame, as a small file has but a few.
    """
    ship_package(plan.sparkSession)
    kept = [f"`{n}` {t}" for n, t in plan.dtypes]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _read(batch, tokens)

    return plan.mapInPandas(read, ", ".join([*kept, f"`{tokens}` array<bigint>"]))


def _read(plan: pd.DataFrame, tokens: str, most: int = 256) -> Iterator[pd.DataFrame]:
    """The rows of a part of a plan with their ids, ``most`` to a frame."""
    rows = plan.sort_values(["path", "begin"])
    for at in range(0, len(rows), most):
        part = rows.iloc[at : at + most]
        found = []
        for path, own in groupby(part[["path", "begin", "length", "dtype"]].itertuples(index=False, name=None), itemgetter(0)):
            files, place = filesystem(path)
            with files.open_input_file(place) as file:
                found += [_ids(file, *r[1:]) for r in own]
        yield part.assign(**{tokens: found})


def _ids(file, begin: int, length: int, dtype: str) -> np.ndarray:
    raw = file.read_at(length, begin)
    if len(raw) != length:
        raise EOFError(f"{len(raw)} of {length} bytes at {begin}")
    return np.frombuffer(raw, np.dtype(dtype).newbyteorder("<")).astype(np.int64)


def by_file(plan: DataFrame) -> DataFrame:
    """The plan dealt so that the blocks of a file are read by one task, in a bounded number of tasks."""
    return spread(plan, "path")


def stream_blocks(
    spark: SparkSession, files: DataFrame, n_shards: int, n_chunks: int, block_size: int, seed: int, runs_per_batch: int = 1
) -> DataFrame:
    """An endless stream of blocks that starts over behind the last run, as a streaming DataFrame.

    The stream's offset counts runs: number t stands for epoch ``t div runs`` and run ``t mod runs``, of all
    shards. Offsets are kept by the query's checkpoint, so a query that is stopped goes on behind its
    last batch. Each epoch has its own order, the one that :func:`block_plan` gives to it.
    """
    placed = run_files(files, n_shards, n_chunks, block_size)
    runs = materialize(_runs(placed), "runs")
    count = runs.count()  # one row per run of files
    if not count:
        raise ValueError("no complete run of files")
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", runs_per_batch).option("numPartitions", 1).load()
    turn: Column = F.col("value")
    numbered = ticks.select(whole_div(turn, count).alias("epoch"), (turn % count).alias("run_no")).join(runs, "run_no")
    return read_blocks(by_file(_placed(numbered, placed, n_chunks, block_size, seed)))
