"""Gap-tolerant periods, their shared-plan variants, and best full windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.grid import Grid


def _at_least(count: str, total: str, share: float) -> Column:
    """count / total >= share, in whole numbers."""
    s = Fraction(str(share))
    return F.col(count) * s.denominator >= F.col(total) * s.numerator


def _flag(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(False))


def _segment(eligible: str, part: Sequence[str], grid: Grid) -> Column:
    """Number of the unbroken eligible stretch of each row: ineligible rows and holes in the grid start a new one."""
    order = Window.partitionBy(*part).orderBy(grid.time)
    hole = F.coalesce(F.col(grid.time) - F.col("_before") != grid.step, F.lit(False))
    return F.sum((~F.col(eligible) | hole).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))


def _episodes(matches: DataFrame, part: Sequence[str], grid: Grid, off_delay: int, least_elapsed: int, occupancy: float) -> DataFrame:
    """Periods of matching rows with their ``segment``; only matches are sorted here."""
    step = grid.step
    inside = Window.partitionBy(*part, "segment").orderBy(grid.time)
    gap = F.col(grid.time) - F.lag(grid.time).over(inside)
    new = F.coalesce(gap > off_delay * step, F.lit(True))
    marked = matches.withColumns({"_new": new.cast("int"), "_missed": F.when(new, 0).otherwise(F.call_function("div", gap, F.lit(step)) - 1)})
    marked = marked.withColumn("_episode", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    found = marked.groupBy(*part, "segment", "_episode").agg(
        F.min(grid.time).alias("_first"), F.max(grid.time).alias("episode_end"), F.count("*").alias("matching_steps"), F.max("_missed").alias("longest_gap_steps")
    )
    found = found.withColumn("elapsed_steps", F.call_function("div", F.col("episode_end") - F.col("_first"), F.lit(step)) + 1)
    found = found.where((F.col("elapsed_steps") >= least_elapsed) & _at_least("matching_steps", "elapsed_steps", occupancy)).withColumn("episode_start", F.col("_first") - step)
    number = F.row_number().over(Window.partitionBy(*part).orderBy("episode_start")).cast("long")
    return found.select(
        *part, number.alias("episode_id"), "episode_start", "episode_end", "elapsed_steps", "matching_steps", (F.col("elapsed_steps") - F.col("matching_steps")).alias("nonmatching_steps"),
        (F.col("matching_steps") / F.col("elapsed_steps")).alias("occupancy"), "longest_gap_steps",
    )


def gap_periods(
    rows: DataFrame, grid: Grid, *, eligible: Column | str = "eligible", matching: Column | str = "matching", off_delay: int = 30, least_elapsed: int = 300,
    occupancy: float = 0.8, more: Sequence[str] = ("session",),
) -> DataFrame:
    """Episodes of matching rows at most ``off_delay`` steps apart, inside unbroken eligible stretches.

    Ineligible rows and holes in the grid end a stretch.  Episodes are trimmed
    to their first and last match and kept if they last ``least_elapsed`` steps
    with a matching share of ``occupancy``.  Input invariant: matching rows are
    eligible.  One shuffle by member and two sorts serve the whole plan.
    """
    part = [*grid.keys, *more]
    before = F.lag(grid.time).over(Window.partitionBy(*part).orderBy(grid.time))
    base = rows.select(*part, grid.time, _flag(eligible).alias("_e"), _flag(matching).alias("_m")).withColumn("_before", before)
    matches = base.withColumn("segment", _segment("_e", part, grid)).where("_m").select(*part, grid.time, "segment")
    return _episodes(matches, part, grid, off_delay, least_elapsed, occupancy)


def period_variants(
    rows: DataFrame, grid: Grid, variants: Mapping[str, tuple[Column, Column]], *, more: Sequence[str] = ("session",), off_delay: int = 30, least_elapsed: int = 300, occupancy: float = 0.8
) -> DataFrame:
    """Many (eligible, matching) definitions in one plan.

    Stretches are numbered once for each distinct eligibility; then matching
    rows alone are unnested into the variants they match, so what is sorted a
    second time grows with matches, not with rows times variants.
    """
    part = [*grid.keys, *more]
    distinct = {str(e): e for e, _ in variants.values()}
    at = {k: i for i, k in enumerate(distinct)}
    before = F.lag(grid.time).over(Window.partitionBy(*part).orderBy(grid.time))
    base = rows.select(
        *part, grid.time, *[_flag(e).alias(f"_e{i}") for i, e in enumerate(distinct.values())], *[_flag(m).alias(f"_m{j}") for j, (_, m) in enumerate(variants.values())]
    ).withColumn("_before", before)
    base = base.withColumns({f"_s{i}": _segment(f"_e{i}", part, grid) for i in range(len(distinct))})
    hits = [F.when(F.col(f"_m{j}"), F.struct(F.lit(name).alias("variant"), F.col(f"_s{at[str(e)]}").alias("segment"))) for j, (name, (e, _)) in enumerate(variants.items())]
    matches = base.select(*part, grid.time, F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("v")).select(*part, "v.variant", grid.time, "v.segment")
    return _episodes(matches, [*part, "variant"], grid, off_delay, least_elapsed, occupancy)


def omit_one(conditions: Mapping[str, Column], omit: str | None = None) -> Column:
    """All conditions but one."""
    out = F.lit(True)
    for k, c in conditions.items():
        if k != omit:
            out = out & c
    return out


def best_window(rows: DataFrame, grid: Grid, *, steps: int = 300, occupancy: float = 0.8, eligible: str = "eligible", matching: str = "matching", session: str = "session") -> DataFrame:
    """Each member's full window of ``steps`` eligible rows with the most matches; the earliest of equals."""
    roll = Window.partitionBy(*grid.keys, session).orderBy(grid.time).rowsBetween(1 - steps, 0)
    rolled = rows.select(
        *grid.keys, session, F.col(grid.time).alias("window_end"), F.min(grid.time).over(roll).alias("_first"), F.count("*").over(roll).alias("represented_steps"),
        F.sum(F.col(eligible).cast("int")).over(roll).alias("eligible_steps"), F.sum(F.col(matching).cast("int")).over(roll).alias("matching_steps"),
    )
    full = rolled.where(
        (F.col("represented_steps") == steps) & (F.col("eligible_steps") == steps) & (F.col("window_end") - F.col("_first") == (steps - 1) * grid.step)
        & _at_least("matching_steps", "represented_steps", occupancy)
    )
    # The best row is an aggregate, so no member is sorted again.
    rank = F.struct((-F.col("matching_steps")).alias("a"), F.col("window_end").alias("b"), F.col(session).alias("c"))
    best = full.groupBy(*grid.keys).agg(F.min_by(F.struct(session, "window_end", "represented_steps", "eligible_steps", "matching_steps"), rank).alias("w"))
    return best.select(*grid.keys, "w.*").select(
        *grid.keys, session, (F.col("window_end") - steps * grid.step).alias("window_start"), "window_end", "represented_steps", "eligible_steps", "matching_steps",
        (F.col("matching_steps") / F.col("represented_steps")).alias("occupancy"),
    )


def fixed_window(rows: DataFrame, grid: Grid, ends: DataFrame, steps: int, values: Sequence[str]) -> DataFrame:
    """The last ``steps`` rows up to each member's ``stop``, values rebased to the first valid one, in basis points.

    ``ends`` has a member's keys and ``stop``, one row each; the range reaches
    the scan as a filter where the ends are literals.
    """
    cut = rows.join(ends, list(grid.keys)).where((F.col(grid.time) > F.col("stop") - steps * grid.step) & (F.col(grid.time) <= F.col("stop")))
    whole = grid.window().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return cut.select(*grid.columns, *[(10_000 * (F.col(v) / F.first(v, ignorenulls=True).over(whole) - 1)).alias(f"{v}_bps") for v in values])


def period_summary(periods: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts, mean and median duration and weighted occupancy of periods."""
    return periods.groupBy(*by).agg(
        F.count("*").alias("periods"), F.sum("elapsed_steps").alias("covered_steps"), F.sum("matching_steps").alias("matching_steps"),
        F.avg("elapsed_steps").alias("mean_steps"), F.percentile("elapsed_steps", 0.5).alias("median_steps"),
        (F.sum("matching_steps") / F.sum("elapsed_steps")).alias("weighted_occupancy"),
    )


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, duplicates counted; none if the two reproduce each other."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))
