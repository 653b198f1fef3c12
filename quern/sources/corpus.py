"""Listing corpus files and reading them as ``(source, row_index, text)`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quern.functions.text import (
    RECORD_TEXT_KEYS,
    TABLE_TEXT_NAMES,
    extension_of,
    not_blank,
    record_text,
    resolve_text_column,
    stripped,
    subset_of,
)
from quern.operators.ordered import ordered_sums
from quern.operators.stats import with_quarantine
from quern.sources.footers import parquet_footers, read_parquet_files
from quern.sources.json_ranges import json_array_records, json_line_records, read_text_files

# Extensions found by automatic discovery, and the directories searched first.
AUTO_EXTENSIONS = ("txt", "json", "csv", "parquet", "jsonl", "zst")
AUTO_SUBDIRS = ("train", "test", "validation", "val")

#: Row keys of line formats: the split's offset in units of 2**16 bytes, above the
#: record number within the reading task.
_RECORD_BITS = 33
_OFFSET_BITS = 16


def _children(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the directories directly under ``path``, or None if it does not exist."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return None
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]


def _list_files(spark: SparkSession, root: str | list[str], glob: str) -> DataFrame:
    """Files below ``root`` with size, subset and extension; contents are never read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return found.select(
        "path",
        extension_of(F.col("path")).alias("ext"),
        subset_of(F.col("path")).alias("subset"),
        F.col("length").alias("bytes"),
    )


def list_corpus(
    spark: SparkSession,
    root: str,
    extension: str = "auto",
    subset: str | None = None,
    dataset_name: str | None = None,
) -> DataFrame:
    """Corpus files under ``root`` as ``(path, ext, subset, bytes)``; fails when there is none.

    ``extension="auto"`` looks for every known format, only in the train, test, validation and
    val directories if any exists, and descends first into a single subdirectory named like
    the last part of ``dataset_name``. A file is listed once even if several patterns match.
    """
    root = root.rstrip("/")
    if extension != "auto":
        base = f"{root}/{subset}" if subset else root
        if _children(spark, base) is None:
            raise FileNotFoundError(f"no {extension} files under {base}")
        files = _list_files(spark, base, f"*.{extension}")
    else:
        inside = _children(spark, root)
        if inside is None:
            raise FileNotFoundError(f"{root} does not exist")
        if dataset_name and len(inside) == 1 and inside[0] == dataset_name.split("-")[-1]:
            root = f"{root}/{inside[0]}"
            inside = _children(spark, root)
        bases = [f"{root}/{d}" for d in AUTO_SUBDIRS if d in inside] or [root]
        if subset:
            bases = [f"{root}/{subset}"]
        files = _list_files(spark, bases, "*.{" + ",".join(AUTO_EXTENSIONS) + "}")
        files = files.dropDuplicates(["path"])
    if files.isEmpty():
        raise FileNotFoundError(f"no {extension} files under {root}")
    return files


def whole_tables(files: DataFrame) -> DataFrame:
    """The tables of listed files: a folder named like a file of its ``ext``, as Spark writes tables, is one."""
    found = F.regexp_extract("path", r"^(.*?/[^/]+\.(?:" + "|".join(AUTO_EXTENSIONS) + r"))(?:/.*)?$", 1)
    named = files.withColumn("path", F.when(F.endswith(found, F.concat(F.lit("."), F.col("ext"))), found).otherwise(F.col("path")))
    summed = named.groupBy("path", "ext").agg(F.sum("bytes").alias("bytes"))
    return summed.select("path", "ext", subset_of(F.col("path")).alias("subset"), "bytes")


def _line_key() -> Column:
    """A long that grows along the lines of one file, without a pass over the data.

    A file is read in splits that start at known offsets; within a split the records of the
    reading task are numbered upwards.
    """
    offset = F.shiftright(F.col("_metadata.file_block_start"), _OFFSET_BITS)
    record = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _RECORD_BITS) - 1))
    return F.shiftleft(offset, _RECORD_BITS).bitwiseOR(record)


def _lines(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("source"), _line_key().alias("row_index"), "value"
    )


def read_parquet_text(
    spark: SparkSession, paths: str | list[str], text_column: str | None = "text", strict: bool = False, across: bool = False
) -> DataFrame:
    """Text rows of Parquet files in file order; only the text column is read.

    ``row_index`` counts within a file, or with ``across`` over all files by their names, as rows of one table.

    The column is ``text_column``, else one whose name contains "text" (no rows if none). With
    ``strict`` the fixed list of names is tried instead and a table without any is an error.
    """
    table = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(
        *([paths] if isinstance(paths, str) else paths)
    )
    if strict:
        name = resolve_text_column(table.schema, candidates=TABLE_TEXT_NAMES)
    else:
        name = resolve_text_column(table.schema, text_column)
    keys = [F.col("_metadata.file_path").alias("source"), F.col("_metadata.row_index").alias("row_index")]
    if name is None:
        return table.select(*keys, F.lit(None).cast("string").alias("text")).where(F.lit(False))
    rows = table.select(*keys, F.col(f"`{name}`").cast("string").alias("text"))
    if across:
        sizes = table.groupBy(keys[0]).agg(F.count("*").alias("rows"))
        before = ordered_sums(sizes, [], "source", {"before": F.col("rows")}).select("source", "before")
        # One row per file, whose list the scan takes from the driver anyway.
        rows = rows.join(F.broadcast(before), "source").select(
            "source", (F.col("row_index") + F.col("before")).alias("row_index"), "text"
        )
    return rows.na.drop(subset=["text"]) if strict else rows.where(not_blank(F.col("text")))


def read_txt(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One document per non-blank line, trimmed."""
    lines = _lines(spark, paths, "*.txt").select("source", "row_index", stripped(F.col("value")).alias("text"))
    return lines.where(F.length("text") > 0)


def read_json_lines(
    spark: SparkSession, paths: str | list[str] | DataFrame, compressed: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents of JSON Lines files, and the lines and files that hold none; ``paths`` may list files.

    A line is a JSON string or an object with ``text``; in compressed files ``content``,
    ``document`` and ``data`` are tried as well. Lines of any length are read, and files in parts.
    """
    keys = RECORD_TEXT_KEYS if compressed else RECORD_TEXT_KEYS[:1]
    files = paths if isinstance(paths, DataFrame) else _list_files(spark, paths, "*.zst" if compressed else "*.jsonl")
    rows = json_line_records(files, keys, compressed)
    ok = F.col("stage").isNull()
    return rows.where(ok).select("source", "row_index", "text"), rows.where(~ok).select("source", "row_index", "stage", "excerpt")


def parse_json_lines(lines: DataFrame, keys: tuple[str, ...] = RECORD_TEXT_KEYS) -> tuple[DataFrame, DataFrame]:
    """Documents of JSON ``value`` lines, and the lines that hold none; blank lines are skipped.

    For values that are in a table already; Spark's own parser refuses values above some 16 MB, which
    :func:`read_json_lines` reads from files.
    """
    others = [c for c in lines.columns if c != "value"]
    parsed = lines.where(not_blank(F.col("value"))).withColumn("text", record_text(F.col("value"), keys))
    good, bad = with_quarantine(parsed, F.col("text").isNotNull(), "value", "parse")
    return good.select(*others, "text"), bad.drop("text")


def read_json_documents(spark: SparkSession, paths: str | list[str] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of ``.json`` files, an array each, and bad files; ``paths`` may list files."""
    return json_array_records(paths if isinstance(paths, DataFrame) else _list_files(spark, paths, "*.json"))


def parse_json_arrays(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of JSON arrays in ``value``: all strings, or all objects with ``text``.

    Values of any other shape are returned as bad rows. Objects without ``text`` are left out.
    Spark's own parser refuses values above some 16 MB, which :func:`read_json_documents` reads.
    """
    others = [c for c in values.columns if c != "value"]
    parsed = F.try_parse_json("value")
    items = F.try_variant_get(parsed, "$", "array<variant>")
    kinds = F.transform(items, lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID")))
    strings = F.forall(kinds, lambda k: k == "STRING")
    objects = F.forall(kinds, lambda k: k.startswith("OBJECT"))
    shaped = values.withColumn("__items", items).withColumn("__ok", items.isNotNull() & (strings | objects))
    good, bad = with_quarantine(shaped, F.col("__ok"), "value", "parse")
    spread = good.select(*others, F.posexplode("__items").alias("row_index", "item"))
    text = F.when(
        F.schema_of_variant("item") == "STRING", F.variant_get("item", "$", "string")
    ).otherwise(F.try_variant_get("item", "$.text", "string"))
    docs = spread.select(*others, F.col("row_index").cast("long").alias("row_index"), text.alias("text"))
    return docs.where(F.col("text").isNotNull()), bad.drop("__items", "__ok")


def read_corpus(
    spark: SparkSession, root: str | list[str] | DataFrame, fmt: str, text_column: str | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Documents ``(source, row_index, text)`` and refused ``(source, stage, excerpt)`` of one format.

    ``root`` may list files (``path``, ``bytes``). A file or record that cannot be read is refused and
    the others are read. Parquet files may have a text column of their own each; ``strict`` tries
    the fixed list of names.
    """
    if fmt == "parquet":
        files = root if isinstance(root, DataFrame) else _list_files(spark, root, "*.parquet")
        return read_parquet_files(spark, parquet_footers(files), text_column or "text", TABLE_TEXT_NAMES if strict else None)
    if fmt == "txt":
        files = root if isinstance(root, DataFrame) else _list_files(spark, root, "*.txt")
        return read_text_files(files)
    if fmt == "jsonl":
        good, bad = read_json_lines(spark, root)
    elif fmt in ("jsonl.zst", "zst"):
        good, bad = read_json_lines(spark, root, compressed=True)
    elif fmt == "json":
        good, bad = read_json_documents(spark, root)
    else:
        raise ValueError(f"no reader for {fmt!r}")
    return good, bad.select("source", "stage", "excerpt")


#: Formats with a reader.
READABLE = ("txt", "json", "parquet", "jsonl", "jsonl.zst", "zst")


def read_any(spark: SparkSession, files: DataFrame, text_column: str | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """The documents of exactly the files that ``files`` (``path``, ``ext``, ``bytes``) lists, and what was refused.

    A selection of files, such as the first of them or those that are not done, is thus all that is
    read. A file that fails does not stop the others. Formats without a reader are refused file by file.
    """
    unread = files.where(~F.coalesce(F.col("ext").isin(*READABLE), F.lit(False)))
    docs = spark.createDataFrame([], "source string, row_index long, text string")
    bad = unread.select(F.col("path").alias("source"), F.lit("unsupported").alias("stage"), F.col("ext").alias("excerpt"))
    for ext in [r.ext for r in files.select("ext").distinct().orderBy("ext").collect() if r.ext in READABLE]:
        good, refused = read_corpus(spark, files.where(F.col("ext") == ext), ext, text_column, strict)
        docs, bad = docs.unionByName(good), bad.unionByName(refused)
    return docs, bad
