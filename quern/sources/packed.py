"""Packed token files: a Python Data Source that writes them and a distributed reader.

A chunk file is a 24-byte little-endian header (7-byte magic, u64 version, u8 type code,
u64 chunk size) and the raw ids. A shard file is the raw ids alone.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quern.functions.tokens import TYPE_CODES
from quern.session import materialize, ship_package
from quern.sources.paths import filesystem as _filesystem, spread

# File format.
MAGIC = b"LITPKDS"
VERSION = 1
HEADER_SIZE = 24
CODE_OF = {name: code for code, name in TYPE_CODES.items()}


def header(dtype: str, chunk_size: int) -> bytes:
    return MAGIC + struct.pack("<Q", VERSION) + struct.pack("<B", CODE_OF[dtype]) + struct.pack("<Q", chunk_size)


def parse_header(content: bytes) -> tuple[str, int]:
    """Type and chunk size; fails on a wrong magic, version or type code."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a packed token file")
    version, code, chunk_size = struct.unpack("<QBQ", content[len(MAGIC) : HEADER_SIZE])
    if version != VERSION:
        raise ValueError(f"unknown version {version}")
    if code not in TYPE_CODES:
        raise ValueError(f"unknown type code {code}")
    return TYPE_CODES[code], chunk_size


def narrow(ids: np.ndarray, dtype: str) -> bytes:
    """Raw little-endian bytes of ``ids``; fails when an id does not fit."""
    kind = np.dtype(dtype).newbyteorder("<")
    if kind.kind in "iu" and len(ids):
        info = np.iinfo(kind)
        if ids.min() < info.min or ids.max() > info.max:
            raise ValueError(f"token id outside {dtype}")
    return ids.astype(kind).tobytes()


class PackedTokens(DataSource):
    """``df.write.format("packed_tokens")`` for rows ``(file string, tokens array<int>)``.

    Rows of one file must be consecutive within a task (:func:`write_chunks` and
    :func:`write_shards` see to that). Options: ``dtype``; ``header`` ("true" for chunk
    files, which have one row each). Tasks write into a folder of their own attempt, and the commit
    records the attempts that count; :func:`publish` then gives the files their names. Nothing of a
    failed job or of a lost attempt is ever seen. A name that two rows or tasks claim, or that is
    already taken, fails the write.
    """

    @classmethod
    def name(cls) -> str:
        return "packed_tokens"

    def schema(self) -> str:
        return "file string, tokens array<int>"

    def writer(self, schema, overwrite: bool) -> "PackedWriter":
        return PackedWriter(self.options)


@dataclass
class WrittenFiles(WriterCommitMessage):
    """The manifest of an attempt: a file that lists what the attempt wrote, and under which names it belongs."""

    manifest: str


class PackedWriter(DataSourceArrowWriter):
    """Writes an attempt's files and their manifest; the commit only lists the manifests of the attempts.

    The files get their names from :func:`publish`, which is a job of its own.
    """

    def __init__(self, options):
        self.root = options["path"].rstrip("/")
        self.dtype = options.get("dtype", "uint16")
        self.with_header = options.get("header", "true").lower() == "true"
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _filesystem(self.root)
        attempt = f"{root}/{self.staging}/{uuid.uuid4().hex}"
        fs.create_dir(attempt, recursive=True)
        current, stream, written = None, None, {}
        for batch in iterator:
            files = batch.column("file").to_pylist()
            lists = batch.column("tokens")
            for i, name in enumerate(files):
                ids = lists[i].values.to_numpy(zero_copy_only=False)
                if name != current or self.with_header:
                    if stream is not None:
                        stream.close()
                    if name in written:
                        raise ValueError(f"two rows for the file {name}")
                    current, written[name] = name, f"{attempt}/{len(written)}"
                    stream = fs.open_output_stream(written[name])
                    if self.with_header:
                        stream.write(header(self.dtype, len(ids)))
                stream.write(narrow(ids, self.dtype))
        if stream is not None:
            stream.close()
        manifest = f"{attempt}/manifest"
        with fs.open_output_stream(manifest) as out:
            out.write("".join(json.dumps([place, name]) + "\n" for name, place in written.items()).encode())
        return WrittenFiles(manifest)

    def commit(self, messages) -> None:
        fs, root = _filesystem(self.root)
        fs.create_dir(f"{root}/{_COMMITS}", recursive=True)
        listed = json.dumps({"staging": self.staging, "manifests": [m.manifest for m in messages if m is not None]})
        # Written aside and then named, so that a commit is there as a whole or not at all.
        with fs.open_output_stream(f"{root}/{self.staging}/commit") as out:
            out.write(listed.encode())
        fs.move(f"{root}/{self.staging}/commit", f"{root}/{_COMMITS}/{self.staging}")

    def abort(self, messages) -> None:
        """Nothing has been published; the attempts' files go."""
        _clear(*_filesystem(self.root), self.staging)


#: Folder of the commits that wait to be published.
_COMMITS = "_commits"


def _clear(fs, root: str, staging: str) -> None:
    from pyarrow import fs as pafs

    if fs.get_file_info(f"{root}/{staging}").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/{staging}")


def publish(spark: SparkSession, path: str) -> int:
    """Give the files of every committed write below ``path`` their names; returns how many there are.

    A Spark job reads the manifests, checks that no name is claimed twice or taken, and moves the files, all
    in tasks. If it, an executor or the driver is lost half-way, call it again: a file that has its
    name already is passed over, and what is left is moved. Names that clash fail the call
    before anything is moved, and the write is discarded.
    """
    ship_package(spark)
    fs, root = _filesystem(path.rstrip("/"))
    total = 0
    for staging, manifests in _waiting(fs, root):
        files = materialize(_listed(spark, path, manifests), "manifest")
        twice = files.groupBy("name").count().where("count > 1").orderBy("name").limit(5)
        claimed = [r.name for r in twice.collect()]
        taken = [r.name for r in _over_files(files, path, _state).where("staged AND named").orderBy("name").limit(5).collect()]
        if claimed or taken:
            _settle(fs, root, staging)
            raise ValueError(f"names claimed twice: {claimed}, names already taken: {taken}")
        total += _over_files(files, path, _move).count()
        _settle(fs, root, staging)
    with fs.open_output_stream(f"{root}/_SUCCESS"):
        pass
    return total


def _settle(fs, root: str, staging: str) -> None:
    """Forget a commit: the staged files go first, so that a loss in between leaves nothing unlisted."""
    _clear(fs, root, staging)
    fs.delete_file(f"{root}/{_COMMITS}/{staging}")
    if not _waiting(fs, root):
        fs.delete_dir(f"{root}/{_COMMITS}")


def _waiting(fs, root: str) -> list[tuple[str, list[str]]]:
    """(staging folder, manifests) of the commits that are not published: a line for each task that wrote."""
    from pyarrow import fs as pafs

    out = []
    for found in fs.get_file_info(pafs.FileSelector(f"{root}/{_COMMITS}", allow_not_found=True)):
        with fs.open_input_stream(found.path) as file:
            commit = json.loads(file.read())
        out.append((commit["staging"], commit["manifests"]))
    return sorted(out)


def _listed(spark: SparkSession, path: str, manifests: list[str]) -> DataFrame:
    """(place, name) of every file that the manifests, paths on the file system of ``path``, list."""
    listed = spark.createDataFrame([(m,) for m in manifests], "manifest string")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = _filesystem(path)
        for batch in batches:
            for manifest in batch["manifest"]:
                with fs.open_input_stream(manifest) as file:
                    rows = [json.loads(line) for line in file.read().splitlines()]
                if rows:
                    yield pd.DataFrame(rows, columns=["place", "name"])

    return spread(listed, "manifest").mapInPandas(read, "place string, name string")


def _over_files(files: DataFrame, path: str, work: Callable) -> DataFrame:
    """``work`` on each file, in tasks: (name, staged, named)."""
    goal = path.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _filesystem(goal)
        for batch in batches:
            rows = [(name, *work(fs, place, f"{root}/{name}")) for place, name in zip(batch["place"], batch["name"], strict=True)]
            yield pd.DataFrame(rows, columns=["name", "staged", "named"])

    return spread(files, "name").mapInPandas(run, "name string, staged boolean, named boolean")


def _state(fs, place: str, name: str) -> tuple[bool, bool]:
    from pyarrow import fs as pafs

    return tuple(i.type != pafs.FileType.NotFound for i in fs.get_file_info([place, name]))


def _move(fs, place: str, name: str) -> tuple[bool, bool]:
    """Move a file unless an earlier attempt has done so."""
    staged, named = _state(fs, place, name)
    if staged:
        fs.create_dir(name.rsplit("/", 1)[0], recursive=True)
        fs.move(place, name)
    elif not named:
        raise FileNotFoundError(f"{name} is neither staged nor published")
    return staged, True


def write_chunks(
    chunks: DataFrame,
    path: str,
    prefix: str | Column,
    dtype: str,
    number: str = "counter",
    tokens: str = "tokens",
) -> None:
    """Write one chunk file per row, named ``{prefix}_{counter:010d}.bin``.

    ``prefix`` may be a column, such as the split and a slash, within which ``number`` counts;
    ``prepare_chunks`` counts per split in ``counter`` and per source in ``chunk_no``. Rows that
    would share a name fail the job, and so do names that the folder already has.
    """
    ship_package(chunks.sparkSession)
    chunks.sparkSession.dataSource.register(PackedTokens)
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    name = F.format_string("%s_%010d.bin", prefix, F.col(number).cast("long"))
    rows = chunks.select(name.alias("file"), F.col(tokens).alias("tokens"))
    rows.write.format("packed_tokens").option("dtype", dtype).mode("append").save(path)
    publish(chunks.sparkSession, path)


def write_shards(
    sequences: DataFrame,
    path: str,
    token_size: int,
    shard: str = "shard_id",
    part: str = "part",
    subset: str = "subset",
    order: tuple[str, ...] = ("batch_no", "seq_no"),
    tokens: str = "tokens",
) -> None:
    """Write headerless shard files ``{subset}/tokens_shard_{id:06d}_{part:06d}.ds``.

    A shard is one input file; ``part`` splits it after a bounded number of batches, so a huge
    input file becomes many files of like size written by many tasks.
    """
    ship_package(sequences.sparkSession)
    sequences.sparkSession.dataSource.register(PackedTokens)
    dtype = {2: "uint16", 4: "uint32"}[token_size]
    folder = F.when(F.col(subset) == "", F.lit("")).otherwise(F.concat(F.col(subset), F.lit("/")))
    name = F.concat(folder, F.format_string("tokens_shard_%06d_%06d.ds", F.col(shard), F.col(part)))
    rows = (
        sequences.withColumn("file", name)
        .repartition("file")
        .sortWithinPartitions("file", *order)
        .select("file", F.col(tokens).alias("tokens"))
    )
    rows.write.format("packed_tokens").options(dtype=dtype, header="false").mode("append").save(path)
    publish(sequences.sparkSession, path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk files as ``(path, dtype, chunk_size, tokens)``; fails on a malformed file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.bin")
        .load(path)
        .select("path", "content")
    )
    return files.mapInArrow(
        _decode_chunks, "path string, dtype string, chunk_size long, tokens array<bigint>"
    )


def _decode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                raw = content.as_buffer()
                dtype, chunk_size = parse_header(raw.slice(0, min(HEADER_SIZE, raw.size)).to_pybytes())
                ids = np.frombuffer(raw, np.dtype(dtype).newbyteorder("<"), offset=HEADER_SIZE).astype(np.int64)
                if len(ids) != chunk_size:
                    raise ValueError(f"{path.as_py()}: {len(ids)} ids, header says {chunk_size}")
                yield path.as_py(), dtype, chunk_size, ids

    return _gathered(rows(), {"path": pa.string(), "dtype": pa.string(), "chunk_size": pa.int64()})


def _gathered(rows: Iterator[tuple], others: dict[str, pa.DataType], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of rows of ``others`` and ids, as ``tokens``; a batch has at most ``most`` ids, or one row."""

    def batch() -> pa.RecordBatch:
        *columns, ids = zip(*part, strict=True)
        offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
        arrays = [pa.array(c, t) for c, t in zip(columns, others.values(), strict=True)]
        return pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))], names=[*others, "tokens"])

    part, size = [], 0
    for row in rows:
        # A row counts as some ids itself, so that empty ones are bounded too.
        weight = len(row[-1]) + 64
        if part and size + weight > most:
            yield batch()
            part, size = [], 0
        part.append(row)
        size += weight
    if part:
        yield batch()


def read_shards(spark: SparkSession, path: str, token_size: int) -> DataFrame:
    """Headerless shard files as ``(path, tokens)``."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.ds")
        .load(path)
        .select("path", "content")
    )
    kind = np.dtype({2: "<u2", 4: "<u4"}[token_size])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pair for batch in batches for pair in zip(batch.column("path"), batch.column("content")))
        rows = ((where.as_py(), np.frombuffer(content.as_buffer(), kind).astype(np.int64)) for where, content in pairs)
        return _gathered(rows, {"path": pa.string()})

    return files.mapInArrow(decode, "path string, tokens array<bigint>")
