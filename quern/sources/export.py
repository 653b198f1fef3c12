"""Resumable bulk export of prepared files with a manifest of what was done."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.operators.ordered import whole_div, with_ordinal
from quern.session import materialize, ship_package
from quern.sources.packed import _filesystem
from quern.sources.paths import spread

#: While a job of rounds takes less than this, the next one has twice as many.
JOB_SECONDS = 60.0

MANIFEST = "path string, target string, chunk_id long, status string, error string, started double, finished double"


def export_plan(
    files: DataFrame,
    manifest: DataFrame | None = None,
    chunk_size: int = 1000,
    start_chunk: int = 0,
) -> DataFrame:
    """Files still to copy with their ``chunk_id``: runs of ``chunk_size`` files by path.

    Files that the manifest records as copied are left out; chunk numbers do not depend on it.
    """
    ranked = with_ordinal(files, [], "path", "__rank")
    plan = ranked.withColumn("chunk_id", whole_div(F.col("__rank"), chunk_size)).drop("__rank")
    plan = plan.where(F.col("chunk_id") >= start_chunk)
    if manifest is not None:
        done = manifest.where(F.col("status") == "ok").select("path").distinct()
        plan = plan.join(done, "path", "left_anti")
    return plan


def export_files(plan: DataFrame, root: str, target: str, attempts: int = 3, wait: float = 0.5) -> DataFrame:
    """Copy the planned files, keeping their place below ``root``, as manifest rows.

    Chunks are the unit of distribution. A failing file is tried again after ``wait`` seconds, twice
    as many before each further attempt, and then recorded as failed; it never stops the others.
    The copies are made when the rows are computed: :func:`export` writes them to a manifest at once.
    """
    ship_package(plan.sparkSession)
    base, goal = root.rstrip("/"), target.rstrip("/")

    def copy(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([_copy_one(p, c, base, goal, attempts, wait) for p, c in zip(part["path"], part["chunk_id"])])

    return spread(plan.select("path", "chunk_id"), "chunk_id").mapInPandas(copy, MANIFEST)


def _plain(path: str) -> str:
    return "/" + path[len("file:") :].lstrip("/") if path.startswith("file:") else path


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The rows of a manifest, the latest of each file; none if there is no manifest yet."""
    files, place = _filesystem(manifest)
    if not _has_rows(files, place):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).parquet(manifest)
    latest = rows.groupBy("path").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "path"]), F.struct("finished", "status")).alias("r"))
    return latest.select("path", "r.*")


def _has_rows(files, place: str) -> bool:
    from pyarrow import fs as pafs

    found = files.get_file_info(pafs.FileSelector(place, allow_not_found=True))
    return any(i.base_name.endswith(".parquet") for i in found)


def export(
    spark: SparkSession,
    files: DataFrame,
    root: str,
    target: str,
    manifest: str,
    chunk_size: int = 1000,
    start_chunk: int = 0,
    chunks_per_round: int = 64,
    attempts: int = 3,
    wait: float = 0.5,
) -> DataFrame:
    """Copy ``files`` in rounds of chunks, appending the rounds to the ``manifest``; returns the manifest.

    The first round is a Spark job of its own. While jobs are short, each has twice as many rounds as the one
    before, so that small rounds do not cost a job each, and a lost job is never much longer than
    ``JOB_SECONDS``. A job's rows are appended to the manifest by Spark's commit protocol, as a whole or not at all. After a lost driver the same call goes on: files that the manifest records as copied are left
    out, failed ones are tried again, and a round that was not recorded is copied again, over what it left.
    Chunk numbers depend on the names alone. ``start_chunk`` leaves out the chunks before it.
    """
    plan = materialize(export_plan(files, None, chunk_size, start_chunk), "export")
    last = plan.agg(F.max("chunk_id")).first()[0]
    first, chunks = start_chunk, chunks_per_round
    while last is not None and first <= last:
        begun = time.time()
        done = read_manifest(spark, manifest).where(F.col("status") == "ok").select("path")
        left = plan.where(F.col("chunk_id").between(first, first + chunks - 1)).join(done, "path", "left_anti")
        export_files(left, root, target, attempts, wait).write.mode("append").parquet(manifest)
        first += chunks
        if time.time() - begun < JOB_SECONDS:
            chunks *= 2
    return read_manifest(spark, manifest)


def _copy_one(path: str, chunk_id: int, base: str, goal: str, attempts: int, wait: float = 0.0) -> dict:
    from pyarrow import fs as pafs

    relative = _plain(path)[len(_plain(base)) :].lstrip("/").replace("\\", "/")
    key, started, error = f"{goal}/{relative}", time.time(), None
    for attempt in range(attempts):
        if attempt:
            time.sleep(wait * 2 ** (attempt - 1))
        try:
            source_fs, source = _filesystem(path)
            target_fs, destination = _filesystem(key)
            target_fs.create_dir(destination.rsplit("/", 1)[0], recursive=True)
            pafs.copy_files(source, destination, source_filesystem=source_fs, destination_filesystem=target_fs)
            error = None
            break
        except Exception as problem:  # recorded in the manifest
            error = str(problem)
    return {
        "path": path,
        "target": key,
        "chunk_id": chunk_id,
        "status": "ok" if error is None else "failed",
        "error": error,
        "started": started,
        "finished": time.time(),
    }


def export_stats(manifest: DataFrame) -> DataFrame:
    """One row: copied and failed files, seconds and copied files per second."""
    seconds = F.max("finished") - F.min("started")
    totals = manifest.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count_if(F.col("status") != "ok").alias("failed"),
        seconds.alias("seconds"),
    )
    rate = F.when((F.col("succeeded") > 0) & (F.col("seconds") > 0), F.col("succeeded") / F.col("seconds"))
    return totals.withColumn("files_per_second", rate)
