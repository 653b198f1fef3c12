"""The special-token table of a tokenizer directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_DECODER = (
    "added_tokens_decoder map<string,struct<content:string,lstrip:boolean,normalized:boolean,"
    "rstrip:boolean,single_word:boolean,special:boolean>>,"
    "bos_token string, eos_token string, pad_token string, unk_token string"
)


def _whole(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("c"))


def read_special_tokens(spark: SparkSession, directory: str) -> DataFrame:
    """``(token, id, special, normalized, lstrip, rstrip, single_word)`` of a tokenizer's config.

    Tokens that only ``added_tokens.json`` lists come with their id and special set.
    """
    base = directory.rstrip("/")
    config = _whole(spark, f"{base}/tokenizer_config.json", _DECODER)
    flagged = config.select(F.explode("c.added_tokens_decoder").alias("id", "t")).select(
        F.col("t.content").alias("token"),
        F.col("id").cast("int").alias("id"),
        "t.special",
        "t.normalized",
        "t.lstrip",
        "t.rstrip",
        "t.single_word",
    )
    added = _whole(spark, f"{base}/added_tokens.json", "map<string,int>").select(
        F.explode("c").alias("token", "id")
    )
    no = F.lit(False)
    extra = added.join(flagged.select("token"), "token", "left_anti").select(
        "token",
        "id",
        F.lit(True).alias("special"),
        *[no.alias(c) for c in ("normalized", "lstrip", "rstrip", "single_word")],
    )
    return flagged.unionByName(extra)


def read_token_roles(spark: SparkSession, directory: str) -> DataFrame:
    """One row ``(bos_token, eos_token, pad_token, unk_token)``.

    A role's token may be stored as a string or as an object with ``content``.
    """
    roles = _whole(spark, f"{directory.rstrip('/')}/tokenizer_config.json", _DECODER)
    token = lambda n: F.coalesce(F.get_json_object(F.col(f"c.{n}"), "$.content"), F.col(f"c.{n}")).alias(n)
    return roles.select(*[token(n) for n in ("bos_token", "eos_token", "pad_token", "unk_token")])


def check_special_tokens(table: DataFrame, required: dict[str, str]) -> dict[str, int]:
    """Ids of the required tokens (role to token); fails on one without a single valid id.

    The table is a few dozen rows; only the required ones are fetched.
    """
    rows = table.where(F.col("token").isin(list(required.values()))).select("token", "id").collect()
    ids: dict[str, set[int]] = {}
    for row in rows:
        if row.id is not None and row.id >= 0:
            ids.setdefault(row.token, set()).add(row.id)
    for role, token in required.items():
        if len(ids.get(token, ())) != 1:
            raise ValueError(f"{role} token {token!r} has no single valid id")
    return {role: next(iter(ids[token])) for role, token in required.items()}
