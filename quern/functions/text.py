"""Column expressions and schema look-ups for raw text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Names tried, in this order, for the text of a table or of a JSON record.
TABLE_TEXT_NAMES = ("text", "content", "story", "document", "string")
RECORD_TEXT_KEYS = ("text", "content", "document", "data")
# Directory names that label a subset.
SUBSETS = ("train", "validation", "test")

#: Sort rank of each subset label; anything else comes last.
SUBSET_RANK = {name: i for i, name in enumerate(SUBSETS)}


def resolve_text_column(
    schema: T.StructType, name: str | None = None, candidates: Sequence[str] | None = None
) -> str | None:
    """The column that holds text.

    With ``candidates``, the first one present, else an error. Otherwise ``name`` if
    present, else the first column with "text" in its lower-cased name, else None.
    """
    columns = schema.fieldNames()
    if candidates is not None:
        for candidate in candidates:
            if candidate in columns:
                return candidate
        raise ValueError(f"no text column among {list(candidates)}; columns are {columns}")
    if name in columns:
        return name
    return next((c for c in columns if "text" in c.lower()), None)


def not_blank(text: Column) -> Column:
    """False for NULL, empty and white-space-only text."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def drop_blank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(not_blank(F.col(text)))


def drop_null(df: DataFrame, text: str = "text") -> DataFrame:
    return df.na.drop(subset=[text])


def stripped(text: Column) -> Column:
    """Text without leading and trailing white space, line breaks included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def preview(text: Column, length: int = 1000) -> tuple[Column, Column]:
    """The first ``length`` characters and how many characters follow them."""
    rest = F.greatest(F.length(text) - F.lit(length), F.lit(0))
    return F.substring(text, 1, length).alias("preview"), rest.alias("more_chars")


def subset_of(path: Column) -> Column:
    """The first whole path segment that names a subset, or ''."""
    return F.regexp_extract(path, "/(" + "|".join(SUBSETS) + ")(?:/|$)", 1)


def subset_rank(subset: Column) -> Column:
    rank = F.lit(len(SUBSETS))
    for name, position in SUBSET_RANK.items():
        rank = F.when(subset == name, F.lit(position)).otherwise(rank)
    return rank


def with_subset(df: DataFrame, path: str = "path") -> DataFrame:
    return df.withColumn("subset", subset_of(F.col(path)))


def extension_of(path: Column) -> Column:
    """Lower-cased extension; ``jsonl.zst`` counts as one."""
    return F.regexp_extract(F.lower(path), r"\.(jsonl\.zst|[^./]+)$", 1)


def first_present_key(json: Column, keys: Sequence[str] = RECORD_TEXT_KEYS) -> Column:
    """The first of ``keys`` that the JSON object has, even with a null value; else NULL."""
    present = F.json_object_keys(json)
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.get(F.filter(wanted, lambda k: F.array_contains(present, k)), 0)


def first_present_value(json: Column, keys: Sequence[str] = RECORD_TEXT_KEYS) -> Column:
    """The value of :func:`first_present_key` as text; NULL when there is none."""
    key = first_present_key(json, keys)
    value = F.lit(None).cast("string")
    for name in keys:
        value = F.when(key == name, F.get_json_object(json, f"$.{name}")).otherwise(value)
    return value


def record_text(line: Column, keys: Sequence[str] = RECORD_TEXT_KEYS) -> Column:
    """The text of one JSON line: the line's own string, or the first present key's string.

    NULL for malformed JSON, for other JSON values, and for a value that is no string.
    """
    parsed = F.try_parse_json(line)
    is_text = F.schema_of_variant(parsed) == "STRING"
    out = F.when(is_text, F.variant_get(parsed, "$", "string"))
    key = first_present_key(line, keys)
    for name in keys:
        value = F.variant_get(parsed, f"$.{name}", "variant")
        value_text = F.when(
            F.schema_of_variant(value) == "STRING", F.variant_get(value, "$", "string")
        )
        out = F.when(parsed.isNotNull() & (key == name), value_text).otherwise(out)
    return out


def split_run_url(url: Column) -> Column:
    """``struct(entity, project, run_id, valid)`` of ``https://wandb.ai/<entity>/<project>/runs/<id>``."""
    # Fixed value: the address pattern of a run.
    pattern = r"https://wandb\.ai/([^/]+)/([^/]+)/runs/([^/?]+)"
    part = lambda i: F.nullif(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.struct(
        part(1).alias("entity"),
        part(2).alias("project"),
        part(3).alias("run_id"),
        F.coalesce(url.rlike(pattern), F.lit(False)).alias("valid"),
    )


def parse_run_url(url: Column) -> Column:
    """As :func:`split_run_url`, but fails the job on a malformed address."""
    parsed = split_run_url(url)
    message = F.concat(F.lit("malformed run address: "), F.coalesce(url, F.lit("NULL")))
    return F.when(parsed["valid"], parsed).otherwise(F.raise_error(message).cast(_RUN_TYPE))


_RUN_TYPE = "struct<entity:string,project:string,run_id:string,valid:boolean>"
