"""Interval algebra on tables: unions, intersections, lengths, semi-joins and as-of values.

Operators that look along time take a bucket ``width`` in the unit of time.
With it a key's rows are windowed bucket by bucket, and what earlier buckets
hand on is one row a bucket, so a key that holds a large share of all rows is
many tasks' work.  Without it each key is one window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(time: Column, width: int | None) -> Column:
    return F.floor(time / F.lit(width)).cast("long") if width else F.lit(0).cast("long")


def _carried(df: DataFrame, keys: Sequence[str], summary: Column, combine, name: str) -> DataFrame:
    """(keys, _bucket, name): ``combine`` of the summaries of all earlier buckets of the key."""
    per = df.groupBy(*keys, "_bucket").agg(summary.alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*keys, "_bucket", combine(F.col("_s")).over(earlier).alias(name))


def _with(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join by null-safe keys and bucket."""
    renamed = other.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate([*keys, "_bucket"])], *[c for c in other.columns if c not in (*keys, "_bucket")])
    on = F.lit(True)
    for i, k in enumerate([*keys, "_bucket"]):
        on = on & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return df.join(renamed, on).drop(*[f"_r{i}" for i in range(len(keys) + 1)])


def union_intervals(df: DataFrame, keys: Sequence[str], start: str = "start", stop: str = "stop", width: int | None = None) -> DataFrame:
    """Merge overlapping and touching intervals of each key."""
    if width is None:
        order = Window.partitionBy(*keys).orderBy(start, stop)
        reach = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.when(F.coalesce(F.col(start) > reach, F.lit(True)), F.col(start))
        island = F.max("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
        return df.withColumn("_opens", opens).withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(stop).alias(stop)).drop("_island")
    df = df.withColumn("_bucket", _bucket(F.col(start), width))
    part = [*keys, "_bucket"]
    order = Window.partitionBy(*part).orderBy(start, stop)
    reach = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
    carried = _carried(df, keys, F.max(stop), F.max, "_reach")
    marked = _with(df.withColumn("_before", reach), carried, keys)
    # An interval that begins beyond all earlier ones opens an island; the island's start tells it from others.
    new = F.coalesce(F.col(start) > F.greatest("_before", "_reach"), F.lit(True))
    marked = marked.withColumn("_opens", F.when(new, F.col(start)))
    opened = _carried(marked, keys, F.max("_opens"), F.max, "_open")
    here = F.max("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    islands = _with(marked.withColumn("_here", here), opened, keys).withColumn("_island", F.coalesce("_here", "_open"))
    return islands.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(stop).alias(stop)).drop("_island")


def next_value(df: DataFrame, keys: Sequence[str], time: str, tie: str, width: int | None = None) -> DataFrame:
    """``df`` with ``until``: the time of the key's next row, null at its last."""
    df = df.withColumn("_bucket", _bucket(F.col(time), width))
    inside = F.lead(time).over(Window.partitionBy(*keys, "_bucket").orderBy(time, tie))
    per = df.groupBy(*keys, "_bucket").agg(F.min(time).alias("_s"))
    later = per.select(*keys, "_bucket", F.lead("_s").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_later"))
    return _with(df.withColumn("_next", inside), later, keys).withColumn("until", F.coalesce("_next", "_later")).drop("_next", "_later", "_bucket")


def bucketed_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int, start: str = "start", stop: str = "stop") -> DataFrame:
    """Pairs of overlapping intervals of equal keys: ``(keys, l_start, l_stop, r_start, r_stop)``.

    Intervals are listed in the time buckets they touch, so the join is an
    equality on (keys, bucket); a pair is kept in the bucket where its overlap
    begins, hence once.
    """

    def spread(df: DataFrame, side: str) -> DataFrame:
        a, b = F.col(start), F.col(stop)
        bucket = F.explode(F.sequence(F.floor(a / width), F.floor((b - 1) / width)))
        return df.where(b > a).select(*keys, a.alias(f"{side}_start"), b.alias(f"{side}_stop"), bucket.alias("_bucket"))

    joined = spread(left, "l").join(spread(right, "r"), [*keys, "_bucket"])
    low = F.greatest("l_start", "r_start")
    return joined.where((F.least("l_stop", "r_stop") > low) & (F.floor(low / width) == F.col("_bucket"))).drop("_bucket")


def overlap_lengths(left: DataFrame, right: DataFrame, members: DataFrame, keys: Sequence[str], *, step: int, width: int, names: tuple[str, str] = ("fast", "slow")) -> DataFrame:
    """Lengths in steps of two interval sets per member, of their intersection, differences and union."""
    length = F.call_function("div", F.col("stop") - F.col("start"), F.lit(step))
    a, b = union_intervals(left, keys), union_intervals(right, keys)
    shared = bucketed_overlap(a, b, keys, width).groupBy(*keys).agg(F.sum(F.call_function("div", F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start"), F.lit(step))).alias("shared_steps"))
    x, y = names
    out = members.select(*keys).distinct()
    for df in (a.groupBy(*keys).agg(F.sum(length).alias(f"{x}_steps")), b.groupBy(*keys).agg(F.sum(length).alias(f"{y}_steps")), shared):
        out = out.join(df, list(keys), "left")
    out = out.fillna(0, [f"{x}_steps", f"{y}_steps", "shared_steps"])
    return out.withColumns({
        f"{x}_only_steps": F.col(f"{x}_steps") - F.col("shared_steps"), f"{y}_only_steps": F.col(f"{y}_steps") - F.col("shared_steps"),
        "union_steps": F.col(f"{x}_steps") + F.col(f"{y}_steps") - F.col("shared_steps"),
    })


def inside_intervals(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, start: str = "episode_start", stop: str = "episode_end", width: int | None = None) -> DataFrame:
    """Rows with ``start < time <= stop`` for some interval of their key: EXISTS as a left semi join on the keys and the range.

    With ``width`` intervals are listed in the time buckets they touch, so a
    row meets only those of its key and bucket.
    """
    a, b = F.col(start), F.col(stop)
    buckets = F.explode(F.sequence(_bucket(a + 1, width), _bucket(b, width))) if width else F.lit(0).cast("long")
    other = intervals.where(b > a).select(*[F.col(k).alias(f"_{k}") for k in keys], a.alias("_start"), b.alias("_stop"), buckets.alias("_at"))
    on: Column = (F.col("_bucket") == F.col("_at")) & (F.col(time) > F.col("_start")) & (F.col(time) <= F.col("_stop"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return rows.withColumn("_bucket", _bucket(F.col(time), width)).join(other, on, "left_semi").drop("_bucket")


def as_of(
    points: DataFrame, events: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], *, strict: bool = True, tie: str | None = None, width: int | None = None
) -> DataFrame:
    """The last event's values before each point (``strict``) or not after it: one union and one window, no join of points with events."""
    struct = F.struct(*values)
    extra = {"_tie": F.col(tie) if tie else F.lit(0)}
    a = points.select(*keys, time, F.lit(0 if strict else 1).alias("_rank"), F.lit(None).cast(events.select(struct.alias("s")).schema["s"].dataType).alias("_v"), F.lit(None).cast("long").alias("_tie"), F.lit(True).alias("_point"))
    b = events.withColumns(extra).select(*keys, time, F.lit(1 if strict else 0).alias("_rank"), struct.alias("_v"), F.col("_tie").cast("long"), F.lit(False).alias("_point"))
    order = [time, "_rank"] + (["_tie"] if tie else [])
    every = a.union(b)
    if width is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return every.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_point").select(*keys, time, "_v.*")
    every = every.withColumn("_bucket", _bucket(F.col(time), width))
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # A bucket's last event by (time, tie); points have no value and are none.
    last = F.max_by("_v", F.when(~F.col("_point"), F.struct(time, F.coalesce("_tie", F.lit(-(1 << 63))))))
    carried = _carried(every, keys, last, lambda s: F.last(s, ignorenulls=True), "_carry")
    found = _with(every.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_point"), carried, keys)
    return found.withColumn("_v", F.coalesce("_v", "_carry")).select(*keys, time, "_v.*")
