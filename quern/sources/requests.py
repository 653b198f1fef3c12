"""Request payloads: one row per submitted text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Both payload shapes in one explicit schema; a payload fills one pair of fields.
PAYLOAD = """
    data array<struct<text:string,format:string,batch_size:int>>,
    params struct<model_name:string>,
    batch_data array<struct<text:string,format:string>>,
    batch_params struct<model_name:string,batch_size:int>
"""


def explode_requests(payloads: DataFrame) -> DataFrame:
    """Rows ``(kind, item_no, text, format, batch_size, model_name)`` of parsed payloads.

    In a batch payload the batch size belongs to the payload, otherwise to each item.
    """
    items = F.coalesce(
        F.transform(
            "data",
            lambda d: F.struct(
                d["text"].alias("text"), d["format"].alias("format"), d["batch_size"].alias("batch_size")
            ),
        ),
        F.transform(
            "batch_data",
            lambda d: F.struct(
                d["text"].alias("text"),
                d["format"].alias("format"),
                F.col("batch_params.batch_size").alias("batch_size"),
            ),
        ),
    )
    others = [c for c in payloads.columns if c not in ("data", "params", "batch_data", "batch_params")]
    kind = F.when(F.col("data").isNotNull(), F.lit("realtime")).otherwise(F.lit("batch"))
    model = F.coalesce("params.model_name", "batch_params.model_name")
    spread = payloads.select(
        *others, kind.alias("kind"), model.alias("model_name"), F.posexplode(items).alias("item_no", "item")
    )
    return spread.select(*others, "kind", "item_no", "item.text", "item.format", "item.batch_size", "model_name")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Payload files (one JSON object each) as rows of :func:`explode_requests`."""
    payloads = spark.read.schema(PAYLOAD).json(path, multiLine=True)
    return explode_requests(payloads.select(F.col("_metadata.file_path").alias("source"), "*"))


def parse_requests(df: DataFrame, payload: str = "payload") -> DataFrame:
    """As :func:`read_requests` for payloads held in a string column."""
    keys = [c for c in df.columns if c != payload]
    return explode_requests(df.select(*keys, F.from_json(payload, PAYLOAD).alias("__p")).select(*keys, "__p.*"))
