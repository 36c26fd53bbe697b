"""Event and record scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_events(spark: SparkSession, paths: Sequence[str], schema: T.StructType, columns: Sequence[str], stop: int | None = None, start: int | None = None) -> DataFrame:
    """Projected events with time bounds; both reach the Parquet scan as pruned columns and pushed filters."""
    df = spark.read.schema(schema).parquet(*paths).select(*columns)
    if start is not None:
        df = df.where(F.col("sip_timestamp") >= start)
    return df.where(F.col("sip_timestamp") < stop) if stop is not None else df


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records from JSON lines or Parquet by the path's ending; a malformed line fails the job."""
    if path.rstrip("/").endswith((".jsonl", ".json")):
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema).parquet(path)


def read_members(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """One relation over many member files; partition folders are not columns."""
    return spark.read.schema(schema).parquet(*paths)
