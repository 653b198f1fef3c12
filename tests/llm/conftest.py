"""Rows that every operator has to stand: nulls, empty and long texts, ties, copies, clashing names."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, base string, spans string, score string, key string, host string"


def hard_rows():
    prose = "the quick brown fox jumps over the lazy dog while seven grey geese fly north again " * 6
    texts = [
        None, "", " ", "\t\n\x0b\f\r ", "a", "a b", "...", "1 2 3 4 5", prose, prose, prose.upper(),
        "x" * 5000, "word " * 3000, "ünï cödé \U0001f600 ß " * 40, "line one here\nline one here\n\nline two\r\n" * 20,
        "no break space\u0085here", "#*$%&|<> " * 60,
        "Licensed under the Apache License, Version 2.0. cc by MIT License gnu\tgeneral  public license",
        "mail a.b@c.example.com or +1 (301) 555-0346, card 4111 1111 1111 1111, host 10.0.0.255 and 10.0.0.256",
        "token = \"f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda\" end",
    ]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, 1, "x", "y", "z", "0", "k", "h") for i, t in enumerate(texts)]
    rows.append((8, texts[8], "en", "s0", None, None, None, None, None, None, None))  # a repeated row
    rows.append((None, texts[8], None, None, None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The documents of the smallest scale beside the hard rows, with ids of their own."""
    import os

    if not os.path.exists(DATA):
        pytest.skip("driver tables are not here")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    hard = spark.createDataFrame(hard_rows(), SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    return docs.unionByName(hard.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).selectExpr("doc_id + 1000000 AS doc_id", "text", "lang", "source", "n_chars"))
