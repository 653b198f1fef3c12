"""Files that queries write from the tables before they read them: many small ones, in parallel.

Documents are dealt to files by ranges of their ids, so that a file has a bounded number of them
whatever the table. Not part of the library.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, functions as F

from quern.session import scratch_path, ship_package
from quern.sources.paths import filesystem

# Workers have the library, but not the catalog.
register_pickle_by_value(sys.modules[__name__])

#: Documents of a file.
PER_FILE = 128


def file_no(key: str = "doc_id"):
    return F.call_function("div", F.col(key), F.lit(PER_FILE)).cast("long")


def write_files(spark: SparkSession, docs: DataFrame, label: str, write: Callable[[object, str, int, pd.DataFrame], None]) -> str:
    """Call ``write(file system, folder, file number, documents)`` for each file; returns the folder.

    ``docs`` has ``file`` and ``doc_id``. A retried task writes the same bytes to the same names.
    """
    ship_package(spark)
    path = scratch_path(spark, label)

    def one(part: pd.DataFrame) -> pd.DataFrame:
        files, root = filesystem(path)
        files.create_dir(root, recursive=True)
        number = int(part["file"].iloc[0])
        write(files, root, number, part.sort_values("doc_id"))
        return pd.DataFrame({"files": [1]})

    docs.groupBy("file").applyInPandas(one, "files long").agg(F.sum("files")).first()
    return path


def write_mixed_parquet(files, root: str, number: int, docs: pd.DataFrame) -> None:
    """A text column of another name in each fifth of the files, or none, or one that is half NULL."""
    import pyarrow.parquet as pq

    text = docs["text"].astype(object).where(docs["doc_id"] % 2 == 0, None) if number % 5 == 3 else docs["text"]
    name = {0: "text", 1: "Body_Text", 2: "content", 3: "text", 4: "title"}[number % 5]
    table = pa.table({"doc_id": pa.array(docs["doc_id"], pa.int64()), name: pa.array(text, pa.string())})
    with files.open_output_stream(f"{root}/f{number:06d}.parquet") as out:
        pq.write_table(table, out)


def write_row_groups(files, root: str, number: int, docs: pd.DataFrame, rows: int = 50) -> None:
    import pyarrow.parquet as pq

    table = pa.table({"text": pa.array(docs["text"], pa.string())})
    with files.open_output_stream(f"{root}/f{number:06d}.parquet") as out:
        pq.write_table(table, out, row_group_size=rows)


def write_json_array(files, root: str, number: int, docs: pd.DataFrame) -> None:
    """Arrays of objects, of strings, and in each third file of both, which is refused."""
    items = []
    for i, t in zip(docs["doc_id"].tolist(), docs["text"].tolist(), strict=True):
        as_object = number % 3 == 0 or (number % 3 == 2 and i % 2 == 0)
        items.append({"id": i, "tags": ["a]", {"b": "}"}], "text": t} if as_object else t)
    with files.open_output_stream(f"{root}/f{number:06d}.json") as out:
        out.write(json.dumps(items, ensure_ascii=number % 2 == 0, indent=1 if number % 4 == 0 else None).encode())


def write_some_broken(files, root: str, number: int, docs: pd.DataFrame) -> None:
    """Files of four formats; of each format every other file is damaged."""
    import pyarrow.parquet as pq

    broken = number // 4 % 2 == 1
    texts = docs["text"].tolist()
    lines = "".join(json.dumps({"text": t}) + "\n" for t in texts).encode()
    if number % 4 == 0:
        sink = pa.BufferOutputStream()
        pq.write_table(pa.table({"text": pa.array(texts, pa.string())}), sink)
        data, name = sink.getvalue().to_pybytes(), "parquet"
        data = data[:-20] if broken else data
    elif number % 4 == 1:
        data, name = pa.compress(lines, codec="zstd", asbytes=True), "jsonl.zst"
        data = b"no frame" + data if broken else data
    elif number % 4 == 2:
        data, name = json.dumps(texts).encode(), "json"
        data = data[:-2] if broken else data
    else:
        data, name = lines, "jsonl"
        data = data[:-3] if broken else data
    with files.open_output_stream(f"{root}/f{number:06d}.{name}", compression=None) as out:
        out.write(data)


def write_lines(files, root: str, number: int, docs: pd.DataFrame) -> None:
    with files.open_output_stream(f"{root}/f{number:06d}.jsonl") as out:
        out.write("".join(json.dumps({"text": t}) + "\n" for t in docs["text"]).encode())


def write_folders(files, root: str, number: int, docs: pd.DataFrame) -> None:
    """Text, JSON Lines and files of no known format below train, test and a folder that is not searched."""
    folder = ("train/deep", "test", "elsewhere")[number % 3]
    files.create_dir(f"{root}/{folder}", recursive=True)
    with files.open_output_stream(f"{root}/{folder}/f{number:06d}.{('txt', 'jsonl', 'bin', 'csv')[number % 4]}") as out:
        out.write("".join(docs["text"]).encode())
