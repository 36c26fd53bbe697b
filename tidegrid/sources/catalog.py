"""Catalogs of members: manifests, file hashes, pair checks and inventories."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid import schema as S
from tidegrid.config import ContractError, FeatureConfig, canonical_json, digest
from tidegrid.operators import validation as V
from tidegrid.operators.features import feature_catalog
from tidegrid.sources.sinks import read_text, write_text

MEMBER_FIELDS = ("session_date", "symbol", "base", "features")


def contained(root: str, relative: str) -> str:
    """A path below ``root``; absolute paths and parents are refused."""
    p = PurePosixPath(relative)
    if p.is_absolute() or ".." in p.parts or not p.parts:
        raise ContractError(f"path outside its root: {relative}")
    return f"{root.rstrip('/')}/{p}"


#: Bytes of a file that a task holds at once while it hashes it.
HASH_BYTES = 8 << 20


def file_hashes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, bytes, sha256) of files, read as streams and hashed by the executors; a file's size is not limited."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select("path", F.col("length").alias("bytes"))

    def run(batches):
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                fs, path = pafs.FileSystem.from_uri(name if "://" in name else name.replace("file:/", "file:///", 1))
                digest_ = hashlib.sha256()
                with fs.open_input_stream(path) as stream:
                    while part := stream.read(HASH_BYTES):
                        digest_.update(part)
                out.append(digest_.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["path", "bytes", "sha256"])

    return files.mapInArrow(run, "path string, bytes long, sha256 string")


def _relative(root: str) -> Column:
    """A hashed file's path below the root."""
    base = root.rstrip("/").removeprefix("file://").removeprefix("file:") + "/"
    return F.substring_index(F.col("path"), base, -1)


def changed_files(spark: SparkSession, root: str, catalog: Mapping) -> DataFrame:
    """(path) of files that are missing, new or different; only these leave the executors."""
    paths = [contained(root, m[k]) for m in catalog["members"] for k in ("base", "features")]
    listed = spark.createDataFrame([(k, int(v[0]), v[1]) for k, v in catalog["files"].items()], "path string, listed_bytes long, listed_sha256 string")
    found = file_hashes(spark, sorted(set(paths))).withColumn("path", _relative(root))
    same = F.col("bytes").eqNullSafe(F.col("listed_bytes")) & F.col("sha256").eqNullSafe(F.col("listed_sha256"))
    return listed.join(found, "path", "full").where(~same).select("path")


def build_catalog(spark: SparkSession, root: str, members: Sequence[Mapping], config: FeatureConfig = FeatureConfig(), hashed: bool = True, checked: bool = True) -> dict:
    """Write ``catalog.json`` below ``root``: members, configuration, file hashes and the catalog's identity.

    Unless told otherwise every queryable field of every member is scanned
    first, and a value or mask that breaks its rules is an error.  The list of
    files is part of the catalog, so it reaches the driver: one line a file.
    """
    keys = [(m["session_date"], m["symbol"]) for m in members]
    if len(set(keys)) != len(keys):
        raise ContractError("a member is listed twice")
    listed = sorted(({k: m[k] for k in m} for m in members), key=lambda m: (m["session_date"], m["symbol"]))
    for m in listed:
        if set(MEMBER_FIELDS) - set(m):
            raise ContractError("a member lacks fields")
    if checked:
        scan_fields(spark, root, listed, config)
    files = {}
    if hashed:
        paths = sorted({contained(root, m[k]) for m in listed for k in ("base", "features")})
        files = {r["path"]: [r["bytes"], r["sha256"]] for r in file_hashes(spark, paths).withColumn("path", _relative(root)).collect()}
    body = {"version": 1, "config": config.to_dict(), "members": listed, "files": dict(sorted(files.items()))}
    catalog = body | {"identity": digest(body)}
    write_text(spark, f"{root.rstrip('/')}/catalog.json", canonical_json(catalog))
    return catalog


def read_catalog(spark: SparkSession, root: str) -> dict:
    catalog = json.loads(read_text(spark, f"{root.rstrip('/')}/catalog.json"))
    body = {k: v for k, v in catalog.items() if k != "identity"}
    if digest(body) != catalog.get("identity"):
        raise ContractError("the catalog was changed")
    return catalog


def scan_fields(spark: SparkSession, root: str, members: Sequence[Mapping], config: FeatureConfig = FeatureConfig()) -> None:
    """Hold all queryable fields against their rules, one pass over the features and one over the base."""
    fields = feature_catalog(config)
    for table, kind, schema in (("features", "features", S.features_schema(config)), ("base", "current_ages", S.BASE)):
        names = [f["name"] for f in fields if f["table"] == kind]
        rows = spark.read.schema(schema).parquet(*sorted({contained(root, m[table]) for m in members}))
        V.require(rows, V.projected_rules(fields, names), f"{kind} of the catalog")


def verify_files(spark: SparkSession, root: str, catalog: Mapping) -> None:
    """Hash every listed file again; any difference is an error."""
    wrong = [r["path"] for r in changed_files(spark, root, catalog).limit(10).collect()]
    if wrong:
        raise ContractError(f"files differ from the catalog: {sorted(wrong)}")


def sha256_text(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def pair_report(quotes: DataFrame, trades: DataFrame, keys: Sequence[str] = ("session_date", "symbol")) -> DataFrame:
    """Per member and stream: rows, time bounds and repeated keys."""
    out = None
    for name, df in (("quotes", quotes), ("trades", trades)):
        uniq = df.groupBy(*keys, "sip_timestamp", "sequence_number").agg(F.count("*").alias("n"))
        part = uniq.groupBy(*keys).agg(F.sum("n").alias("rows"), F.min("sip_timestamp").alias("first_ns"), F.max("sip_timestamp").alias("last_ns"), F.sum(F.col("n") - 1).alias("repeated_keys")).withColumn("stream", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def inventory(planned: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("session_date", "symbol")) -> DataFrame:
    """Planned members with whether both streams are there and clean."""
    streams = pairs.groupBy(*keys).agg(F.countDistinct("stream").alias("streams"), F.sum("rows").alias("event_count"), F.sum("repeated_keys").alias("repeated_keys"))
    joined = planned.select(*keys).distinct().join(streams, list(keys), "left")
    return joined.withColumn("complete", F.coalesce((F.col("streams") == 2) & (F.col("repeated_keys") == 0), F.lit(False)))


def missing_pairs(planned: DataFrame, pairs: DataFrame, keys: Sequence[str] = ("session_date", "symbol")) -> DataFrame:
    return planned.select(*keys).distinct().join(pairs.select(*keys).distinct(), list(keys), "left_anti")
