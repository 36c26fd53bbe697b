"""Streaming activity grid and runs.

Events within the watermark's delay are counted in their step, later ones are
dropped by Spark.  Runs of matching steps are kept in state per member.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUN_SCHEMA = "member string, first_end timestamp, last_end timestamp, steps long"


def activity_grid(events: DataFrame, keys: Sequence[str], time: str, *, step: str = "1 second", delay: str = "10 seconds", value: str | None = None) -> DataFrame:
    """Counts (and sums of ``value``) per member and step; a step is emitted once the watermark has passed it."""
    sums = [F.sum(value).alias("total")] if value else []
    grouped = events.withWatermark(time, delay).groupBy(*keys, F.window(time, step).alias("w")).agg(F.count("*").alias("n"), *sums)
    return grouped.select(*keys, F.col("w.end").alias("step_end"), "n", *(["total"] if value else []))


def streaming_runs(rows: DataFrame, member: Column, time: str, matching: Column, step_seconds: float) -> DataFrame:
    """Maximal runs of matching steps of each member, emitted when a later row ends them.

    ``rows`` come in order within a member, as an append-mode grid gives them.
    """

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, n = state.get if state.exists else (None, None, 0)
        out = []
        for pdf in batches:
            for t, ok in pdf.sort_values("t")[["t", "ok"]].itertuples(index=False):
                joined = last is not None and (t - pd.Timestamp(last)).total_seconds() <= step_seconds
                if n and not (ok and joined):
                    out.append((key[0], first, last, n))
                    first, last, n = None, None, 0
                if ok:
                    first, last, n = (first if n else t), t, n + 1
        state.update((first, last, n))
        yield pd.DataFrame(out, columns=["member", "first_end", "last_end", "steps"])

    long = rows.select(member.cast("string").alias("member"), F.col(time).cast("timestamp").alias("t"), F.coalesce(matching, F.lit(False)).alias("ok"))
    return long.groupBy("member").applyInPandasWithState(step, RUN_SCHEMA, "first timestamp, last timestamp, n long", "append", GroupStateTimeout.NoTimeout)
