"""Parquet files of unlike schemas: footers as a table, one scan for each text column, row groups.

Footers are read by tasks, a few kilobytes a file. They say which column of each file holds text, which
files cannot be read, and at which rows the row groups begin. The texts themselves come from
Spark's own scan, one for each name that a text column has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quern.functions.text import not_blank
from quern.session import materialize, ship_package
from quern.sources.paths import described, filesystem, plain_path, spread

_FOOTER = (
    "path string, columns array<struct<name:string,textual:boolean>>, "
    "groups array<struct<row_group:int,first_row:long,rows:long>>, rows long, error string"
)


def parquet_footers(files: DataFrame) -> DataFrame:
    """(path, columns, groups, rows, error) of every file of ``files`` (``path``), as a table.

    ``columns`` are the top-level columns and whether they hold strings; ``groups`` are the row groups
    with their first row. A file without a readable footer has ``error`` and nothing else.
    """
    ship_package(files.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_footer(p) for p in batch["path"]], columns=["path", "columns", "groups", "rows", "error"])

    return materialize(spread(files.select("path").distinct(), "path").mapInPandas(read, _FOOTER), "footers")


def _footer(path: str) -> tuple:
    import pyarrow as pa
    import pyarrow.parquet as pq

    try:
        files, place = filesystem(path)
        with files.open_input_file(place) as file:
            found = pq.ParquetFile(file)
            meta = found.metadata
            textual = lambda t: pa.types.is_string(t) or pa.types.is_large_string(t) or pa.types.is_binary(t)
            kind = lambda t: t.value_type if pa.types.is_dictionary(t) else t
            columns = [{"name": f.name, "textual": textual(kind(f.type))} for f in found.schema_arrow]
            groups, first = [], 0
            for i in range(meta.num_row_groups):
                groups.append({"row_group": i, "first_row": first, "rows": meta.row_group(i).num_rows})
                first += meta.row_group(i).num_rows
        return path, columns, groups, first, None
    except Exception as error:  # whatever a broken file raises becomes its row
        return path, None, None, None, described(error)


def text_column(names: Column, wanted: str | None = None, candidates: Sequence[str] | None = None) -> Column:
    """The text column among ``names``, an array: by the rules of ``resolve_text_column``, else NULL."""
    if candidates is not None:
        return F.get(F.filter(F.array(*map(F.lit, candidates)), lambda c: F.array_contains(names, c)), 0)
    alike = F.get(F.filter(names, lambda n: F.contains(F.lower(n), F.lit("text"))), 0)
    return alike if wanted is None else F.when(F.array_contains(names, wanted), F.lit(wanted)).otherwise(alike)


def resolved(footers: DataFrame, wanted: str | None = "text", candidates: Sequence[str] | None = None) -> DataFrame:
    """(path, rows, column, stage, excerpt): each file's text column, or why it has none.

    Stages: ``read`` for a file without a readable footer, ``column`` for one without a text
    column, with its columns, and for one whose text column holds no strings.
    """
    names = F.transform("columns", lambda c: c["name"])
    found = footers.withColumn("column", text_column(names, wanted, candidates))
    textual = F.exists("columns", lambda c: (c["name"] == F.col("column")) & c["textual"])
    stage = F.when(F.col("error").isNotNull(), "read").when(~F.coalesce(textual, F.lit(False)), "column")
    return found.select(
        "path", "rows", F.when(stage.isNull(), F.col("column")).alias("column"), stage.alias("stage"),
        F.when(stage.isNotNull(), F.coalesce("error", F.array_join(names, ","))).alias("excerpt"),
    )


def read_parquet_files(
    spark: SparkSession, footers: DataFrame, wanted: str | None = "text", candidates: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(source, row_index, text) of files of any schemas, and (source, stage, excerpt) of what was refused.

    Each file is read by its own text column. A page that cannot be decoded ends the reading of its
    split only; such files are found by their number of rows and are refused with stage ``rows``, and
    none of their rows is returned. With ``candidates`` a blank text is a document, otherwise not.
    """
    chosen = materialize(resolved(footers, wanted, candidates), "resolved")
    parts = []
    # Spark's scan takes the names of its files from the driver; a scan lists nothing else.
    by_column: dict[str, list[str]] = {}
    for r in chosen.where("column IS NOT NULL").select("column", "path").orderBy("column", "path").toLocalIterator():
        by_column.setdefault(r.column, []).append(r.path)
    for column, paths in by_column.items():
        schema = T.StructType([T.StructField(column, T.StringType())])
        scan = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
        name = "`" + column.replace("`", "``") + "`"
        parts.append(
            scan.select(
                plain_path(F.col("_metadata.file_path")).alias("source"), F.col("_metadata.row_index").alias("row_index"), F.col(name).alias("text")
            )
        )
    if not parts:
        rows = spark.createDataFrame([], "source string, row_index long, text string")
    else:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
    # Every page has to be decoded for a row to be counted, so the lengths are part of the sums.
    seen = rows.groupBy("source").agg(F.count("*").alias("seen"), F.sum(F.length("text")).alias("chars"))
    listed = chosen.where("column IS NOT NULL AND rows > 0").select(F.col("path").alias("source"), "rows")
    short = listed.join(seen, "source", "left").where((F.coalesce("seen", F.lit(0)) != F.col("rows")) | (F.col("chars") < 0))
    short = materialize(short.select("source", "rows", F.coalesce("seen", F.lit(0)).alias("seen")), "short")
    good = rows.join(short.select("source"), "source", "left_anti")
    good = good.where(not_blank(F.col("text")) if candidates is None else F.col("text").isNotNull())
    refused = chosen.where("stage IS NOT NULL").select(F.col("path").alias("source"), "stage", "excerpt")
    broken = short.select("source", F.lit("rows").alias("stage"), F.format_string("%d of %d rows", "seen", "rows").alias("excerpt"))
    return good, refused.unionByName(broken)


#: Rows of a file that share a key of the join with row groups.
_BLOCK_BITS = 12


def with_row_groups(docs: DataFrame, footers: DataFrame, source: str = "source", order: str = "row_index") -> DataFrame:
    """Add ``row_group``, the number of the row group of a file that each row lies in.

    A range join by blocks of rows: a row group is listed once for each block that it touches, so
    every row meets the row groups of its own block only.
    """
    group = footers.select(F.col("path").alias("__path"), F.explode("groups").alias("g")).where("g.rows > 0")
    last = F.col("g.first_row") + F.col("g.rows") - 1
    blocks = F.sequence(F.shiftright("g.first_row", _BLOCK_BITS), F.shiftright(last, _BLOCK_BITS))
    bounds = group.select("__path", F.col("g.first_row").alias("__first"), last.alias("__last"), F.col("g.row_group").alias("row_group"), F.explode(blocks).alias("__block"))
    at = F.col(order)
    met = docs.withColumn("__block", F.shiftright(at, _BLOCK_BITS)).join(
        bounds, (F.col(source) == F.col("__path")) & (docs[order].isNotNull()) & (F.shiftright(at, _BLOCK_BITS) == bounds["__block"]) & at.between(F.col("__first"), F.col("__last"))
    )
    return met.select(*[docs[c] for c in docs.columns], "row_group")
