"""Immutable exports, bounded results and query bundles."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from tidegrid.config import ContractError, digest


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file through Spark's own file systems."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def publish(spark: SparkSession, attempt: str, target: str) -> None:
    """Rename a finished attempt into place; an existing target is never replaced."""
    fs, a = _fs(spark, attempt)
    _, t = _fs(spark, target)
    if fs.exists(t) or not fs.rename(a, t):
        raise FileExistsError(target)


def export_parquet(df: DataFrame, target: str, *, query: str = "", scope: Mapping | None = None) -> dict:
    """Write data, query, scope and manifest to an attempt folder, then rename it to ``target``."""
    spark = df.sparkSession
    if exists(spark, target):
        raise FileExistsError(target)
    attempt = f"{target.rstrip('/')}.attempt-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{attempt}/data")
    rows = spark.read.schema(df.schema).parquet(f"{attempt}/data").count()
    manifest = {"rows": rows, "schema": df.schema.jsonValue(), "query_sha256": digest(query), "scope": dict(scope or {})}
    write_text(spark, f"{attempt}/query.sql", query)
    write_text(spark, f"{attempt}/scope.json", json.dumps(dict(scope or {}), sort_keys=True))
    write_text(spark, f"{attempt}/manifest.json", json.dumps(manifest, sort_keys=True))
    publish(spark, attempt, target)
    return manifest


def export_tables(tables: Mapping[str, DataFrame], target: str, receipt: Mapping) -> dict:
    """Several tables and a receipt, published together."""
    spark = next(iter(tables.values())).sparkSession
    if exists(spark, target):
        raise FileExistsError(target)
    attempt = f"{target.rstrip('/')}.attempt-{uuid.uuid4().hex}"
    counts = {}
    for name, df in tables.items():
        df.write.option("compression", "zstd").parquet(f"{attempt}/{name}")
        counts[name] = spark.read.schema(df.schema).parquet(f"{attempt}/{name}").count()
    out = dict(receipt) | {"rows": counts}
    write_text(spark, f"{attempt}/receipt.json", json.dumps(out, sort_keys=True))
    publish(spark, attempt, target)
    return out


def write_pair(df: DataFrame, target: str) -> None:
    """A study table as JSON lines and CSV."""
    df.write.mode("errorifexists").json(f"{target}/json")
    df.write.mode("errorifexists").option("header", True).csv(f"{target}/csv")


def arrow_batches(df: DataFrame, rows: int = 25_000) -> pa.RecordBatchReader:
    """A reader of record batches of at most ``rows`` rows with the frame's own schema, one partition at a time on the driver.

    Batches are made by the executors from Spark's Arrow data and travel as
    Arrow streams, so no row becomes a Python object.  An empty result has the
    schema and no batch.
    """
    schema = to_arrow_schema(df.schema)

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, batch.schema) as stream:
                    stream.write_batch(batch.slice(at, rows))
                yield pa.RecordBatch.from_arrays([pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["batch"])

    def batches() -> Iterator[pa.RecordBatch]:
        for row in df.mapInArrow(pack, "batch binary").toLocalIterator(prefetchPartitions=False):
            with pa.ipc.open_stream(row["batch"]) as stream:
                for batch in stream:
                    yield batch.rename_columns(schema.names).cast(schema)

    return pa.RecordBatchReader.from_batches(schema, batches())


def bounded(df: DataFrame, most: int = 10_000):
    """A pandas frame; more rows than ``most`` are an error, not a truncation."""
    got = df.limit(most + 1).toPandas()
    if len(got) > most:
        raise ValueError(f"the result has more than {most} rows")
    return got


@dataclass(frozen=True)
class Preview:
    """The first rows of a result, its columns, and whether there are more rows."""

    columns: list[str]
    rows: list[dict]
    truncated: bool


def preview(df: DataFrame, rows: int = 100) -> Preview:
    """At most 100 rows; another number of rows is an error."""
    if isinstance(rows, bool) or not isinstance(rows, int) or not 1 <= rows <= 100:
        raise ContractError("a preview has 1 to 100 rows")
    got = [r.asDict() for r in df.limit(rows + 1).collect()]
    return Preview(df.columns, got[:rows], len(got) > rows)
