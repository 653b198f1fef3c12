"""Opening files inside tasks, by any address that a file system is known for."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, functions as F


def filesystem(uri: str):
    """File system and path of a file as Spark lists it, unescaped; ``s3a`` is read as ``s3``."""
    from pyarrow import fs as pafs

    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://") :]
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return pafs.FileSystem.from_uri(quote(uri, safe="/:@?=&,+"))


def plain_path(address: Column) -> Column:
    """The path in an address of ``_metadata.file_path``, whose special characters are escaped."""
    return F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Deal rows that are small themselves but stand for much work over all shuffle partitions.

    The number is given, as adaptive execution would coalesce partitions of few bytes into one.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def described(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"
