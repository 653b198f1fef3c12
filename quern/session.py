"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Defaults that hold for a laptop and for a large cluster. The number of shuffle
#: partitions is left to the caller; adaptive execution coalesces what is too fine.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows holding packed chunks are large: bound Arrow batches by bytes, not only rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(app_name: str = "quern", **conf: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Functions that run in Python workers are pickled by name, so a worker has to be able to
    import the package whatever folder it was started in.
    """
    _ship(spark.sparkContext.applicationId, spark)


_shipped: set[str] = set()


def _ship(application: str, spark: SparkSession) -> None:
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, str(file.relative_to(root.parent)))
    # The driver's own copy, from which Spark serves it to the executors.
    name = os.path.join(tempfile.mkdtemp(prefix="quern-code-"), f"quern-{uuid.uuid4().hex}.zip")
    Path(name).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(name)
    _shipped.add(application)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a fresh temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="quern-")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where a plan reads an expensive result more than once. Unlike a checkpoint the
    table can be column-pruned by each reader, and it survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than there are task slots over all of them.

    A file with one row group is read by one task, however large. Inputs with enough splits,
    which is every large corpus, are returned as they are.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(slots) if splits < slots else df


def bound_batches(spark: SparkSession, rows: int = 1000, mb: int = 16) -> None:
    """Lower this session's bounds of the Arrow batches that go to Python workers.

    A row of text or of a set may be large, so a batch is bounded by rows and by bytes. Bounds
    that are already lower stay.
    """
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", rows),
        ("spark.sql.execution.arrow.maxBytesPerBatch", mb << 20),
    ):
        now = spark.conf.get(key, None)
        value = int(now.rstrip("b")) if now and now.rstrip("b").isdigit() else 0
        if not 0 < value <= most:
            spark.conf.set(key, str(most))
