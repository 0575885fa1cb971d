"""Landed source responses, one row per attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from profilegate import schemas as S


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Batch scan. Every row stays; classification names those that asked for no profiles."""
    return spark.read.schema(S.RESPONSE_SCHEMA).format(fmt).load(path)


def stream_responses(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.RESPONSE_SCHEMA).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
