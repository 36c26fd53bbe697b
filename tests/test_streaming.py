"""Streaming grid and runs against their batch results."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidegrid.streaming.activity import activity_grid, streaming_runs


def test_activity_grid_and_runs(spark, tmp_path):
    rng = random.Random(1)
    t0 = dt.datetime(2026, 1, 1)
    rows = sorted((t0 + dt.timedelta(seconds=s, milliseconds=rng.randrange(1000)), "m", 1.0) for s in range(60) if s % 10 not in (3, 4) for _ in range(2))
    for k in range(3):
        spark.createDataFrame(rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3], "ts timestamp, member string, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, member string, value double").parquet(f"{tmp_path}/in")
    q = activity_grid(stream, ["member"], "ts", delay="2 seconds", value="value").writeStream.outputMode("append").format("memory").queryName("grid_out").option("checkpointLocation", f"{tmp_path}/c1").start()
    q.processAllAvailable()
    q.stop()
    got = {r.step_end: r.n for r in spark.table("grid_out").collect()}
    assert got and all(n == 2 for n in got.values()) and len(got) >= 40

    spark.table("grid_out").coalesce(1).write.parquet(f"{tmp_path}/grid")
    steps = spark.readStream.schema("member string, step_end timestamp, n long, total double").parquet(f"{tmp_path}/grid")
    runs = streaming_runs(steps, F.col("member"), "step_end", F.col("n") >= 2, 1.0)
    q = runs.writeStream.outputMode("append").format("memory").queryName("runs_out").option("checkpointLocation", f"{tmp_path}/c2").start()
    q.processAllAvailable()
    q.stop()
    found = [r.steps for r in spark.table("runs_out").collect()]
    assert found and set(found) <= {3, 8} and found.count(8) >= 3
