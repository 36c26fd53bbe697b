"""Shared-folder staging and session helpers of the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch handed to Python; bounds a batch of long texts.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20


def session(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by rows and bytes, and let Python workers find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))
    for key, value in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)),
    ):
        try:
            spark.conf.set(key, value)
        except Exception:  # noqa: BLE001  an unknown or fixed setting is no error
            pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where none is set, as in tests, a local session gets one of its own; on a
    cluster that would be a folder of one machine, so it is an error.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='tidegrid-')}")
        where = sc.getCheckpointDir()
    # A path without a scheme is on the default file system; name it, so that every reader finds the same folder.
    path = sc._jvm.org.apache.hadoop.fs.Path(where)
    full = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def scratch(spark: SparkSession) -> str:
    """This application's folder of written tables in the shared folder."""
    return f"{shared_dir(spark)}/tidegrid-{spark.sparkContext.applicationId}"


def discard(spark: SparkSession) -> None:
    """Delete this application's written tables; results that still read them must be written by then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends here.

    A written table outlives executors, and its rows stay the same when a
    later job has to be run again.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    for held in _PASSING:
        held.append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_PASSING: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, all but the last, which must not read the others."""
    held: list[str] = []
    _PASSING.append(held)
    try:
        yield
    finally:
        _PASSING[:] = [other for other in _PASSING if other is not held]
        for name in held[:-1]:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        release(spark, passes=4)


def skewed_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, most: int = 10_000) -> DataFrame:
    """Inner join of ``left`` with ``right``, whose keys are unique and whose ``weight`` tells a key's rows in ``left``.

    Keys that weigh more than one part in ``most`` of all are fewer than
    ``most``, whatever the tables' sizes, so they meet their rows by broadcast;
    the others have few rows each and meet them by shuffle.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * most > F.lit(total)
    extra = [c for c in right.columns if c not in on]
    held = left.join(F.broadcast(right.where(heavy).withColumn("is_heavy", F.lit(True))), on, "left")
    light = held.where("is_heavy is null").select(*left.columns).join(right.where(~heavy), on)
    return held.where("is_heavy").select(*left.columns, *extra).unionByName(light.select(*left.columns, *extra))


def release(spark: SparkSession, passes: int = 1, pause: float = 1.0) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are no longer referenced.

    An ended query is held by its last events until all listeners have had
    them, so one collection right after it may find nothing to drop.
    """
    for k in range(passes):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if k + 1 < passes:
            time.sleep(pause)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
