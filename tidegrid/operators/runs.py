"""Strict runs of matching rows and directional stretches, as gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.grid import Grid


def strict_runs(
    rows: DataFrame, grid: Grid, identity: str, *, segment: str = "selection_segment_id", halt: str | None = "halt_active", sources: Sequence[str] = (),
    before: str | None = None, after: str | None = None,
) -> DataFrame:
    """Maximal runs of matching rows, with the reasons that bound them.

    A run ends at a nonmatching or unavailable row, at a halt, where the member
    or segment changes, where a required source's continuity id changes or its
    break flag is set, and at explicit boundaries: reasons in the columns
    ``before`` and ``after`` (null: none) act before and after their row.  A
    matching row at a break starts a new run.  Reasons at segment ends and the
    selection's ends are censored.
    """
    order = grid.window()
    matches = F.col("status") == "matching"
    m = matches & ~F.col(halt) if halt else matches
    own = F.when(F.col(halt), "halt").when(~matches, F.col("status")) if halt else F.when(~matches, F.col("status"))
    changed = F.lag(segment).over(order) != F.col(segment)
    broken = F.lit(False)
    for s in sorted(set(sources)):
        broken = broken | F.col(f"{s}_continuity_break_in_second") | (F.lag(f"{s}_continuity_id").over(order) != F.col(f"{s}_continuity_id"))
    first = F.lag(grid.time).over(order).isNull()
    # What closes a run before this row; the strongest reason names it, an explicit one being the latest to act.
    closing = F.when(changed, "selection_boundary").when(~first & broken, "source_continuity")
    explicit = F.col(before) if before else F.lit(None).cast("string")
    trailing = F.col(after) if after else F.lit(None).cast("string")
    marked = rows.withColumns({"_m": m, "_own": own, "_closing": closing, "_explicit": explicit, "_trailing": trailing, "_first": first})
    entry = F.coalesce("_explicit", "_closing", F.when(F.col("_first"), F.lit("member_boundary")))
    last_own = F.coalesce(F.lag("_trailing").over(order), F.lag("_own").over(order))
    next_entry = F.lead(F.coalesce("_closing", "_explicit")).over(order)
    marked = marked.withColumns({
        "_start": F.col("_m") & (F.col("_first") | F.col("_closing").isNotNull() | F.col("_explicit").isNotNull() | ~F.coalesce(F.lag("_m").over(order), F.lit(False)) | F.lag("_trailing").over(order).isNotNull()),
        "_pre": F.coalesce(entry, last_own),
        "_post": F.coalesce("_trailing", next_entry, F.lead("_own").over(order), F.when(F.lead(grid.time).over(order).isNull(), F.lit("member_end"))),
    })
    numbered = marked.where("_m").withColumn("_run", F.sum(F.col("_start").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ids = [F.min_by(f"{s}_continuity_id", grid.time).alias(s) for s in sorted(set(sources))]
    runs = numbered.groupBy(*grid.keys, "_run").agg(
        F.min_by(segment, grid.time).alias("selection_segment_id"), F.min(grid.time).alias("first_endpoint"), F.max(grid.time).alias("last_endpoint"),
        F.count("*").alias("match_count"), F.min_by("_pre", grid.time).alias("preceding_reason"), F.max_by("_post", grid.time).alias("closure_reason"), *ids,
    )
    # Ordinals count all runs in member order: each member's own number plus the runs of earlier members.
    own = F.row_number().over(Window.partitionBy(*grid.keys).orderBy("first_endpoint")) - 1
    counts = runs.groupBy(*grid.keys).agg(F.count("*").alias("_n"))
    before_member = F.coalesce(F.sum("_n").over(Window.orderBy(*grid.keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(*grid.keys, before_member.alias("_offset"))
    last = rows.agg(F.max(F.struct(*grid.keys)).alias("_last"))
    runs = runs.withColumn("_own", own).join(offsets, list(grid.keys)).join(F.broadcast(last)).withColumn("run_ordinal", F.col("_own") + F.col("_offset"))
    key = F.concat_ws("|", F.lit(identity), *[F.col(k).cast("string") for k in grid.keys], "selection_segment_id", F.col("first_endpoint").cast("string"), F.col("run_ordinal").cast("string"))
    continuity = F.to_json(F.struct(*sorted(set(sources)))) if sources else F.lit("{}")
    # The next member's first row closes a run; the selection's end closes the last member's.
    at_end = F.when(F.struct(*grid.keys) == F.col("_last"), "selection_boundary").otherwise("member_boundary")
    end = F.when(F.col("closure_reason") == "member_end", at_end).otherwise(F.col("closure_reason"))
    return runs.select(
        F.sha2(key, 256).alias("run_id"), "run_ordinal", *grid.keys, "selection_segment_id", "first_endpoint", "last_endpoint", "match_count",
        (F.col("first_endpoint") - grid.step).alias("represented_start"), F.col("last_endpoint").alias("represented_end"),
        F.col("match_count").alias("represented_steps"), F.call_function("div", F.col("last_endpoint") - F.col("first_endpoint"), F.lit(grid.step)).alias("elapsed_steps"),
        "preceding_reason", end.alias("closure_reason"), (F.col("preceding_reason") == "selection_boundary").alias("left_censored"),
        (end == "selection_boundary").alias("right_censored"), continuity.alias("source_continuity_json"),
    )


def stretches(rows: DataFrame, grid: Grid, flag: Column, sums: dict[str, Column] | None = None, more: Sequence[str] = (), top: int | None = None) -> DataFrame:
    """Contiguous rows where ``flag`` holds; a gap in the grid splits.  ``top`` keeps the longest."""
    part = [*grid.keys, *more]
    order = Window.partitionBy(*part).orderBy(grid.time)
    marked = rows.withColumn("_on", F.coalesce(flag, F.lit(False)))
    apart = F.coalesce(F.col(grid.time) - F.lag(grid.time).over(order) != grid.step, F.lit(True))
    marked = marked.withColumn("_new", (F.col("_on") & (apart | ~F.coalesce(F.lag("_on").over(order), F.lit(False)))).cast("int"))
    marked = marked.withColumn("_id", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.where("_on").groupBy(*part, "_id").agg(
        (F.min(grid.time) - grid.step).alias("stretch_start"), F.max(grid.time).alias("stretch_end"), F.count("*").alias("steps"),
        *[F.sum(c.cast("int")).alias(k) for k, c in (sums or {}).items()],
    ).drop("_id")
    return out.orderBy(F.desc("steps"), *grid.keys, "stretch_start").limit(top) if top else out
