"""Exported run telemetry: system history, main history and configuration by run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_telemetry(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """History exported as Parquet or JSON Lines, one row per run and sample."""
    if fmt not in ("parquet", "json"):
        raise ValueError("telemetry is read from parquet or json")
    return spark.read.format(fmt).load(path)


def read_run_config(spark: SparkSession, path: str) -> DataFrame:
    """``(run_id, config map<string,string>)`` from JSON lines ``{"run_id": …, "config": {…}}``."""
    return spark.read.schema("run_id string, config map<string,string>").json(path)
