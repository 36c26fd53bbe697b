"""Acquisition from a paged vendor service: pages by an injected client, normalisation as DataFrames.

Network access stays with the client the caller passes, so everything here
runs offline in tests.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid import schema as S
from tidegrid.config import ContractError
from tidegrid.grid import session_bounds
from tidegrid.operators.validation import order_violations
from tidegrid.sources.sinks import publish

#: A client maps (url, parameters) to the response body's text.
Client = Callable[[str, Mapping[str, str]], str]
MOST_PAGES = 10_000
MOST_BYTES = 64 << 20


def pages(client: Client, url: str, parameters: Mapping[str, str]) -> Iterator[list[dict]]:
    """Results of each page until one has no next URL; a repeated cursor, too many pages or too large a page are errors."""
    seen, at, params = set(), url, dict(parameters)
    for _ in range(MOST_PAGES):
        if at in seen:
            raise ContractError("the service repeats a cursor")
        seen.add(at)
        text = client(at, params)
        if len(text) > MOST_BYTES:
            raise ContractError("a page is too large")
        body = json.loads(text)
        if body.get("status") not in (None, "OK", "DELAYED") or not isinstance(body.get("results", []), list):
            raise ContractError("the service answered with an error")
        yield body.get("results", [])
        at, params = body.get("next_url"), {}
        if not at:
            return
    raise ContractError("the listing does not end")


def acquire(spark: SparkSession, client: Client, url: str, parameters: Mapping[str, str], schema: T.StructType, target: str) -> DataFrame:
    """All pages as a table; each page is appended, so the driver holds one at a time."""
    for n, rows in enumerate(pages(client, url, parameters)):
        part = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)
        part.withColumn("_page", F.lit(n)).write.mode("append").parquet(target)
    return spark.read.schema(schema).parquet(target)


def reference_symbols(rows: DataFrame, day: str) -> DataFrame:
    """(session_date, symbol, kind) of a listing; names that are not plain symbols are refused."""
    out = rows.select(F.lit(day).alias("session_date"), F.col("ticker").alias("symbol"), F.col("type").alias("kind"))
    bad = ~F.coalesce(F.rlike("symbol", F.lit(r"^[A-Z0-9][A-Z0-9._-]{0,31}$")), F.lit(False))
    return out.withColumn("symbol", F.when(bad, F.raise_error(F.lit("invalid symbol")).cast("string")).otherwise(F.col("symbol")))


def normalize_stream(events: DataFrame, schema: T.StructType, day: str, symbol: str) -> DataFrame:
    """A vendor stream in the stored schema, ordered inside its files by time and sequence."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in events.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    out = events.select(F.lit(day).alias("session_date"), F.lit(symbol).alias("symbol"), *cols)
    return out.repartitionByRange("sip_timestamp").sortWithinPartitions("sip_timestamp", "sequence_number")


#: Columns of a minute-bar page, times in milliseconds.
MINUTE_PAGE = T.StructType([T.StructField("t", T.LongType()), T.StructField("n", T.DoubleType()), *[T.StructField(k, T.DoubleType()) for k in "vochl"]])


def minute_bars(rows: DataFrame, symbol: str, start: int, end: int) -> DataFrame:
    """Pages of minute bars as (symbol, window_start, transactions, ..., session bounds); a bar outside the session fails the job."""
    at = F.col("t") * 1_000_000
    outside = ~F.coalesce((at >= start) & (at < end), F.lit(False))
    names = {"n": "transactions", "v": "volume", "o": "open", "c": "close", "h": "high", "l": "low"}
    return rows.select(
        F.lit(symbol).alias("symbol"), F.when(outside, F.raise_error(F.lit("minute outside its session")).cast("bigint")).otherwise(at).alias("window_start"),
        *[F.col(k).alias(v) for k, v in names.items()], F.lit(start).alias("session_start"), F.lit(end).alias("session_end"),
    )


def acquire_pair(spark: SparkSession, streams: Mapping[str, DataFrame], out: str, symbol: str, day: str) -> dict:
    """Both streams of a member normalised, checked and published together below ``out``; the rows of each.

    A stream without events, an event outside the session or a repeated
    (time, sequence) is an error, and then nothing is published.
    """
    if set(streams) != {"trades", "quotes"}:
        raise ContractError("a pair has trades and quotes")
    start, end = session_bounds(day)
    attempt, counts = f"{out.rstrip('/')}.attempt-{uuid.uuid4().hex}", {}
    for name, schema in (("trades", S.VENDOR_TRADES), ("quotes", S.VENDOR_QUOTES)):
        df = normalize_stream(streams[name], schema, day, symbol)
        df.write.option("compression", "zstd").parquet(f"{attempt}/{name}")
        stored = spark.read.schema(df.schema).parquet(f"{attempt}/{name}")
        outside = ~F.coalesce((F.col("sip_timestamp") >= start) & (F.col("sip_timestamp") < end), F.lit(False))
        rows, wrong = stored.agg(F.count("*"), F.count_if(outside)).first()
        repeated = order_violations(stored, ["symbol"]).agg(F.sum(F.col("repeated_keys") + F.col("null_keys"))).first()[0]
        if not rows or wrong or repeated:
            raise ContractError(f"{name} of {day}/{symbol}: {rows} rows, {wrong} outside the session, {repeated or 0} repeated or null keys")
        counts[name] = rows
    publish(spark, attempt, out)
    return counts
