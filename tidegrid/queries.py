"""Registered queries: every operator on the TPC-like tables, through an adapter from events to a grid.

A member is an event type, the grid step is one hour, and an hour without
events is unavailable.  The same operators run on one-second symbol-day grids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid import engine_queries, replay_queries
from tidegrid.functions import bins as B
from tidegrid.functions import masks as M
from tidegrid.functions.numbers import exact_shares, return_bps, sorted_quantile
from tidegrid.grid import Grid
from tidegrid.operators import accounting as A
from tidegrid.operators import distributions as D
from tidegrid.operators import features as Fe
from tidegrid.operators import intervals as I
from tidegrid.operators import periods as P
from tidegrid.operators import population as Po
from tidegrid.operators import sampling as Sa
from tidegrid.operators import screen as Sc
from tidegrid.operators import validation as V
from tidegrid.operators.ew import ew_sums
from tidegrid.operators.predicates import Field, compile_predicates
from tidegrid.operators.runs import stretches, strict_runs
from tidegrid.plans.study import Condition, Study

HOUR = 3600
GRID = Grid(("event_type",), "end_s", HOUR)
KEYS = ["event_type"]
FAST, SLOW = 3, 12
STUDY = Study(
    views=(("fast", FAST), ("slow", SLOW)),
    conditions=(Condition("rate", "rate_hl{h}s", ">=", 2.5), Condition("dollars", "dollars_hl{h}s", ">", 60.005), Condition("freshness", "age_hours", "<=", 1)),
    grid=GRID, off_delay=3, least_elapsed=5, occupancy=0.6,
)


def rounded(*names: str) -> dict[str, Column]:
    return {n: F.round(F.col(n).cast("double"), 6) for n in names}


def events(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/events.parquet").select("event_type", "event_id", "user_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """(event_type, end_s, session, n, dollars, price, eligible, matching): one row per type and hour."""
    us = F.col("us")
    hour = events(spark, sf).withColumn("end_s", (F.call_function("div", us, F.lit(HOUR * 1_000_000)) + 1) * HOUR)
    measured = hour.groupBy("event_type", "end_s").agg(F.count("*").alias("n"), F.sum("value").alias("dollars"), F.max_by("value", F.struct("us", "event_id")).alias("price"))
    span = measured.agg((F.min("end_s") - HOUR).alias("start"), F.max("end_s").alias("stop"))
    members = measured.select("event_type").distinct().join(F.broadcast(span))
    full = GRID.filled(members, measured).fillna(0, ["n"]).fillna(0.0, ["dollars"])
    midday = F.pmod(F.col("end_s") - HOUR, F.lit(86_400)) < 43_200
    return full.withColumns({
        "session": F.when(midday, "am").otherwise("pm"), "eligible": F.col("n") > 0, "matching": (F.col("n") > 0) & (F.col("dollars") > 30.005),
        "day": F.call_function("div", F.col("end_s") - HOUR, F.lit(86_400)),
    })


def studied(spark: SparkSession, sf: str) -> DataFrame:
    """The hourly grid with trailing rates of two views, evaluated under the study's conditions."""
    df = hourly(spark, sf)
    order = GRID.window()
    last = F.last(F.when(F.col("n") > 0, F.col("end_s")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    new: dict[str, Column] = {"age_hours": F.call_function("div", F.col("end_s") - last, F.lit(HOUR))}
    for h in (FAST, SLOW):
        trail = order.rowsBetween(1 - h, 0)
        full = F.count("*").over(trail) == h
        new |= {f"rate_hl{h}s": F.when(full, F.sum("n").over(trail) / h), f"dollars_hl{h}s": F.when(full, F.sum("dollars").over(trail) / h * 4)}
    return STUDY.evaluate(df.withColumns(new))


FIELDS = [Field("n"), Field("value_mean"), Field("price")]
PREDICATES = [{"field": "n", "operator": ">=", "value": 2}, {"field": "price", "operator": "<", "value": 40}, {"field": "price", "operator": ">", "value": 5}]


def with_status(spark: SparkSession, sf: str) -> DataFrame:
    df = hourly(spark, sf).withColumn("value_mean", F.when(F.col("n") > 0, F.col("dollars") / F.col("n")))
    return compile_predicates(PREDICATES, FIELDS).evaluate(df)


# --- scope, predicates, accounting -----------------------------------------


def endpoint_screen(spark, sf):
    """SQL over registered views: a threshold screen joined with members."""
    hourly(spark, sf).createOrReplaceTempView("tg_features")
    spark.table("tg_features").groupBy("event_type").agg(F.min("end_s").alias("opened_s")).createOrReplaceTempView("tg_members")
    return spark.sql("""
        SELECT f.event_type, f.end_s, f.session, f.n, round(f.dollars, 6) AS dollars, (f.end_s - m.opened_s) div 3600 AS hours_open
        FROM tg_features f JOIN tg_members m USING (event_type)
        WHERE f.n >= 3 AND f.dollars > 100.005 AND f.price <= 90
    """)


def prepared_sql(spark, sf):
    hourly(spark, sf).createOrReplaceTempView("tg_features")
    return spark.sql("SELECT event_type, count(*) AS hours, sum(n) AS events FROM tg_features WHERE n >= :least AND session = :name GROUP BY event_type", args={"least": 2, "name": "am"})


def three_state_predicates(spark, sf):
    return with_status(spark, sf).select("event_type", "end_s", "status", F.concat_ws(",", "failing_fields").alias("failing"), F.concat_ws(",", "unavailable_fields").alias("missing"))


def activity_bands(spark, sf):
    df = hourly(spark, sf).withColumn("dollars", F.when(F.col("n") > 0, F.col("dollars")))
    return df.groupBy("event_type", B.bands(F.col("dollars")).alias("band")).agg(F.count("*").alias("hours"))


def gate_accounting(spark, sf):
    df = hourly(spark, sf)
    return A.gate_accounting(df, F.col("n") > 0, (F.col("dollars") >= 30.005) & (F.col("n") >= 2), {"pooled": (), "session": ["session"], "member": ["event_type", "session"]}).select(
        "scope", "event_type", "session", "represented", "valid", "pass", "fail", "unavailable"
    )


def member_accounting(spark, sf):
    return A.member_accounting(with_status(spark, sf), KEYS).withColumns(rounded("match_fraction"))


def contributions(spark, sf):
    return A.contributions(A.member_accounting(with_status(spark, sf), KEYS), KEYS).withColumns(rounded("share"))


def reason_tallies(spark, sf):
    mask = M.any_of(M.bit(F.col("n") == 0, M.NO_SUPPORTED_DATA), M.bit(F.col("session") == "pm", M.HALT), M.bit(F.col("dollars") < 10.005, M.LOW_COVERAGE))
    return A.reason_tallies(hourly(spark, sf).withColumn("mask", mask), "mask", {M.NO_SUPPORTED_DATA: "none", M.HALT: "closed", M.LOW_COVERAGE: "low"})


def concentration(spark, sf):
    return A.concentration(events(spark, sf), ["user_id"]).withColumns(rounded("largest_share", "herfindahl"))


def daily_population(spark, sf):
    df = hourly(spark, sf).groupBy("day").agg(A.count_if(F.col("n") > 0).alias("active_hours"), F.sum("n").alias("events"), F.countDistinct(F.when(F.col("matching"), F.col("event_type"))).alias("matching_types"))
    return df


def selection_segments(spark, sf):
    """A range join of grid rows with two segments of each member."""
    df = hourly(spark, sf)
    span = df.groupBy("event_type").agg(F.min("end_s").alias("a"), F.max("end_s").alias("b"))
    half = F.call_function("div", F.col("b") - F.col("a"), F.lit(4 * HOUR)) * HOUR
    segs = span.select("event_type", F.explode(F.array(F.struct(F.lit(0).alias("seg"), F.col("a").alias("first_s"), (F.col("a") + half).alias("last_s")), F.struct(F.lit(1).alias("seg"), (F.col("b") - half).alias("first_s"), F.col("b").alias("last_s")))).alias("s")).select("event_type", "s.*")
    joined = df.join(segs, "event_type").where((F.col("end_s") >= F.col("first_s")) & (F.col("end_s") <= F.col("last_s")))
    return joined.groupBy("event_type", "seg").agg(F.count("*").alias("hours"), F.sum("n").alias("events"), A.count_if(F.col("end_s") == F.col("first_s")).alias("starts"), A.count_if(F.col("end_s") == F.col("last_s")).alias("ends"))


def window_slice(spark, sf):
    """The last 48 hours of each member, rebased to their first price, in basis points."""
    df = hourly(spark, sf)
    last = df.groupBy("event_type").agg(F.max("end_s").alias("stop"))
    return P.fixed_window(df, GRID, last, 48, ["price"]).select("event_type", "end_s", F.round("price_bps", 6).alias("rebased_bps"))


# --- runs, periods, intervals ------------------------------------------------


def _runs(spark, sf):
    df = with_status(spark, sf).withColumns({"selection_segment_id": F.concat("event_type", F.lit(":"), F.col("session")), "halt_active": F.pmod(F.col("end_s"), F.lit(29 * HOUR)) == 0})
    return strict_runs(df, GRID, "demo")


def strict_runs_query(spark, sf):
    return _runs(spark, sf).select("run_id", "run_ordinal", "event_type", "selection_segment_id", "first_endpoint", "last_endpoint", "match_count", "elapsed_steps", "preceding_reason", "closure_reason", "left_censored", "right_censored")


def _periods(spark, sf, more=()):
    return P.gap_periods(hourly(spark, sf), GRID, off_delay=3, least_elapsed=5, occupancy=0.6, more=more)


def gap_periods(spark, sf):
    return _periods(spark, sf).withColumns(rounded("occupancy"))


def period_summary(spark, sf):
    return P.period_summary(_periods(spark, sf), KEYS).withColumns(rounded("mean_steps", "median_steps", "weighted_occupancy"))


def period_variants(spark, sf):
    return STUDY.all_periods(studied(spark, sf)).select("event_type", "session", "variant", "episode_id", "episode_start", "episode_end", "elapsed_steps", "matching_steps", "longest_gap_steps")


def best_window(spark, sf):
    return P.best_window(hourly(spark, sf), GRID, steps=6, occupancy=0.5).withColumns(rounded("occupancy"))


def directional_stretches(spark, sf):
    df = studied(spark, sf)
    return stretches(df, GRID, F.col("fast_match") & ~F.col("slow_match"), {"failed_rate": ~F.col("slow_pass_rate")}, ("session",))


def top_stretches(spark, sf):
    return STUDY.stretches(studied(spark, sf), 3).select("direction", "event_type", "session", "stretch_start", "stretch_end", "steps", "failed_rate_steps")


def inside_period_semi(spark, sf):
    inside = I.inside_intervals(hourly(spark, sf), _periods(spark, sf), KEYS, "end_s", width=24 * HOUR)
    return inside.groupBy("event_type", "session").agg(F.count("*").alias("hours"), F.sum("n").alias("events"))


def period_overlap(spark, sf):
    df = studied(spark, sf)
    out = STUDY.period_overlap(STUDY.all_periods(df), df.select("event_type").distinct(), 24 * HOUR)
    return out.withColumns(rounded("shared_over_union", "shared_over_fast", "shared_over_slow"))


def interval_union(spark, sf):
    ivals = events(spark, sf).select("event_type", F.col("us").alias("start"), (F.col("us") + (F.col("value") * 60_000_000).cast("long")).alias("stop"))
    return I.union_intervals(ivals, KEYS, width=6 * HOUR * 1_000_000)


def dollar_periods(spark, sf):
    return STUDY.dollar_constrained(studied(spark, sf), floor=80.005, column="dollars_hl{h}s").select("view", "event_type", "session", "episode_start", "episode_end", "elapsed_steps", "matching_steps")


def period_reproduction(spark, sf):
    """The variants' baseline against its own plan: no row differs."""
    df = studied(spark, sf)
    cols = ["event_type", "session", "episode_start", "episode_end", "matching_steps"]
    alone = P.gap_periods(df, GRID, eligible="common_eligible", matching="fast_match", more=["session"], **STUDY.periods).select(*cols)
    return P.differences(STUDY.all_periods(df).where("variant = 'fast'").select(*cols), alone).agg(F.count("*").alias("differing_rows"))


# --- study aggregates ----------------------------------------------------------


def availability_scopes(spark, sf):
    return A.scoped(studied(spark, sf), {"member": ["event_type", "session"], "type": ["event_type"], "overall": ()}, A.availability(F.col("fast_available"), F.col("slow_available")))


def overlap_by_scope(spark, sf):
    out = A.overlap_ratios(A.scoped(studied(spark, sf), {"member": ["event_type", "session"], "type": ["event_type"], "overall": ()}, A.overlap_counts(F.col("fast_match"), F.col("slow_match"))))
    return out.withColumns(rounded("shared_over_union", "shared_over_fast", "shared_over_slow"))


def disagreements(spark, sf):
    return STUDY.disagreements(studied(spark, sf)).withColumns(rounded("share_of_direction"))


def filter_contribution(spark, sf):
    df = studied(spark, sf)
    return STUDY.contribution(df, STUDY.all_periods(df)).withColumns(rounded("standalone_rate"))


def membership(spark, sf):
    df = studied(spark, sf)
    return STUDY.membership(df, STUDY.all_periods(df))


def membership_change(spark, sf):
    periods = STUDY.all_periods(studied(spark, sf))
    one = lambda v: periods.where(F.col("variant") == v)
    return A.membership_change(one("fast"), one("fast_without_rate"), ["event_type", "session"])


def threshold_crossings(spark, sf):
    return A.threshold_crossings(hourly(spark, sf), KEYS, "end_s", F.col("matching"))


def set_algebra(spark, sf):
    df = hourly(spark, sf)
    a, b = df.where("matching").select("event_type", "day").distinct(), df.where("n >= 4").select("event_type", "day").distinct()
    tag = lambda x, n: x.withColumn("part", F.lit(n))
    return tag(a.subtract(b), "gained").unionByName(tag(b.subtract(a), "lost")).unionByName(tag(a.intersect(b), "kept"))


# --- features --------------------------------------------------------------------


def _positioned(spark, sf):
    return hourly(spark, sf).withColumn("o", F.row_number().over(GRID.window()) - 1)


def ew_rates(spark, sf):
    df = ew_sums(_positioned(spark, sf), KEYS, "end_s", "o", {"s_n": (F.col("n"), 6), "s_d": (F.col("dollars"), 6), "s_w": (F.when(F.col("n") > 0, 1.0), 6), "s_1": (F.lit(1.0), 6)})
    w = F.when(F.col("s_w") > 0, F.col("s_w"))
    return df.select("event_type", "end_s", F.round(F.col("s_n") / F.col("s_1"), 6).alias("rate"), F.round(F.col("s_d") / w, 6).alias("mean_dollars"), F.round(F.col("s_w") / F.col("s_1"), 6).alias("coverage"))


def ew_rms_participation(spark, sf):
    df = _positioned(spark, sf)
    r = return_bps(F.lag("price", 5).over(GRID.window()), F.col("price"))
    df = df.withColumn("r", r)
    df = ew_sums(df, KEYS, "end_s", "o", {"u1": (F.abs("r"), 24), "u2": (F.col("r") * F.col("r"), 24), "w": (F.when(F.col("r").isNotNull(), 1.0), 24)})
    has = F.max(F.col("r").isNotNull()).over(GRID.window().rowsBetween(Window.unboundedPreceding, 0))
    ok = F.coalesce(has, F.lit(False))
    return df.select("event_type", "end_s", F.when(ok, F.round(F.sqrt(F.col("u2") / F.col("w")), 4)).alias("rms_bps"), F.when(ok & (F.col("u2") > 0), F.round(F.least(F.lit(1.0), F.col("u1") * F.col("u1") / F.col("w") / F.col("u2")), 6)).alias("participation"))


def age_p90(spark, sf):
    """Trailing linear p90 of the current age over 24 slots; hours without a price fill slots without a value."""
    df = studied(spark, sf).withColumn("slot", F.row_number().over(GRID.window()))
    frame = Window.partitionBy(*KEYS).orderBy("slot").rangeBetween(-23, 0)
    df = df.withColumn("v", F.sort_array(F.collect_list(F.when(F.col("age_hours") > 0, F.col("age_hours").cast("double"))).over(frame)))
    return df.select("event_type", "end_s", F.round(sorted_quantile(F.col("v"), 0.9), 6).alias("p90"), F.size("v").alias("samples"), F.least("slot", F.lit(24)).alias("slots"))


def current_ages(spark, sf):
    """Seconds since the last event before each hour's end."""
    df = hourly(spark, sf).select("event_type", F.col("end_s").alias("end_s"), (F.col("end_s") * 1_000_000).alias("us"))
    got = I.as_of(df, events(spark, sf).withColumn("seen_us", F.col("us")), KEYS, "us", ["seen_us", "event_id"], tie="event_id", width=6 * HOUR * 1_000_000)
    return got.select("event_type", F.call_function("div", F.col("us"), F.lit(1_000_000)).alias("end_s"), "event_id", F.round((F.col("us") - F.col("seen_us")) / 1_000_000, 6).alias("age_s"))


def asof_prevailing(spark, sf):
    """For each purchase the last view of the same user before it."""
    ev = events(spark, sf)
    got = I.as_of(ev.where("event_type = 'purchase'").select("user_id", "us"), ev.where("event_type = 'view'"), ["user_id"], "us", ["event_id", "value"], tie="event_id")
    return got.select("user_id", "us", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))


def interval_integral(spark, sf):
    """Each event's value holds until the next one of its type: time integral and average per hour."""
    ev = events(spark, sf)
    size = HOUR * 1_000_000
    held = I.next_value(ev, ["event_type"], "us", "event_id", width=6 * size)
    states = held.select("event_type", "value", F.col("us").alias("a"), F.col("until").alias("b")).where("b > a")
    hours = F.sequence(F.call_function("div", F.col("a"), F.lit(size)), F.call_function("div", F.col("b") - 1, F.lit(size)))
    pieces = states.withColumn("h", F.explode(hours)).withColumn("us", F.least(F.col("b"), (F.col("h") + 1) * size) - F.greatest(F.col("a"), F.col("h") * size))
    out = pieces.groupBy("event_type", ((F.col("h") + 1) * HOUR).alias("end_s")).agg(F.sum(F.col("value") * F.col("us") / 1_000_000).alias("integral"), F.sum("us").alias("valid_us"))
    return out.select("event_type", "end_s", "valid_us", F.round("integral", 4).alias("integral"), F.round(F.col("integral") / (F.col("valid_us") / 1_000_000), 6).alias("average"))


# --- screening, distributions, sampling ----------------------------------------------


def _bars(spark, sf):
    w = F.struct("us", "event_id")
    day = (F.call_function("div", F.col("us"), F.lit(6 * HOUR * 1_000_000)) * (6 * HOUR)).alias("window_start")
    bars = events(spark, sf).groupBy(F.col("event_type").alias("symbol"), day).agg(
        F.count("*").cast("double").alias("transactions"), F.sum("value").alias("volume"), F.min_by("value", w).alias("open"), F.max_by("value", w).alias("close"), F.max("value").alias("high"), F.min("value").alias("low")
    )
    span = bars.agg(F.min("window_start").alias("session_start"), (F.max("window_start") + 1).alias("session_end"))
    return bars.join(F.broadcast(span))


_SCREEN = Sc.Screen(range_bps=30_000, pair_transactions=24, bar_transactions=8, kinds=("CS", "ADRC"), step=6 * HOUR)


def _reference(spark, sf):
    kind = F.when(F.col("symbol").isin("click", "purchase", "error"), "CS").when(F.col("symbol") == "view", "ADRC").otherwise("ETF")
    return events(spark, sf).select(F.col("event_type").alias("symbol")).distinct().withColumn("kind", kind)


def screen_two_bars(spark, sf):
    got = Sc.first_hits(Sc.screened_bars(_bars(spark, sf), _reference(spark, sf), _SCREEN), _SCREEN)
    return got.withColumns(rounded("range_bps"))


def screen_denominators(spark, sf):
    return Sc.denominators(_bars(spark, sf), _reference(spark, sf), _SCREEN)


def exact_ecdf(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag", "l_quantity")
    return D.exact_marginal(df, ["l_returnflag"], "l_quantity").withColumns(rounded("pooled_share", "equal_mass", "equal_share"))


def ecdf_quantiles(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_returnflag", "l_quantity")
    return D.marginal_quantiles(D.exact_marginal(df, ["l_returnflag"], "l_quantity")).select("q", "pooled")


_X, _Y = B.FixedAxis((5.0, 10.0, 20.0, 40.0)), B.FixedAxis((0.02, 0.04, 0.08))


def joint_histogram(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_linestatus", "l_returnflag", "l_quantity", "l_discount")
    return D.joint_histogram(df, ["l_returnflag"], "l_quantity", "l_discount", _X, _Y, ["l_linestatus"]).withColumns(rounded("equal_probability"))


def dense_histogram(spark, sf):
    """The joint histogram of every panel with its empty bins."""
    return D.dense_bins(joint_histogram(spark, sf).select("l_linestatus", "x_bin", "y_bin", "n"), ["l_linestatus"], 6, 5)


def joint_coverage(spark, sf):
    df = hourly(spark, sf).withColumn("mean", F.when(F.col("n") > 2, F.col("dollars") / F.col("n")))
    return D.joint_coverage(df, "price", "mean", F.col("price") < 50, F.col("mean") < 40, KEYS)


def expanded_joint(spark, sf):
    df = hourly(spark, sf).withColumn("dollars", F.when(F.col("n") > 0, F.col("dollars")))
    long = D.memberships(df, "session", B.bands(F.col("dollars")), F.col("n") >= 2)
    axis = B.Axis.spaced(0, 200, 20, log=False)
    return long.groupBy("scope", "band", "gate", axis.status(F.col("dollars")).alias("status"), axis.bin(F.col("dollars")).alias("bin")).agg(F.count("*").alias("hours"))


def binned_ecdf(spark, sf):
    df = hourly(spark, sf).withColumn("mean", F.when(F.col("n") > 0, F.col("dollars") / F.col("n")))
    return D.binned_ecdf(df, {"dollars": B.linear_bin(F.col("dollars") + 0.00123, 5.0), "mean": B.log1p_bin(F.col("mean"), 0.25)}, ["session"], F.col("n") > 0).withColumns(rounded("share"))


def ecdf_curve(spark, sf):
    """The points of a binned distribution's curve, closed at the largest value."""
    df = hourly(spark, sf).withColumn("mean", F.when(F.col("n") > 0, F.col("dollars") / F.col("n")))
    got = D.curve(D.binned_ecdf(df, {"mean": B.log1p_bin(F.col("mean"), 0.25)}, ["session"], F.col("n") > 0), 0.25, F.lit(60.0))
    return got.select("session", "bin", "n", F.round("share", 6).alias("share"), F.round("x", 6).alias("x"))


def activity_ecdf(spark, sf):
    df = hourly(spark, sf)
    x = F.when(F.col("n") > 0, F.col("dollars"))
    return D.activity_ecdf(df, x, B.log1p_bin(x, 0.05), "session", x >= 30.005).withColumns(rounded("low", "high", "share"))


def panel_summary(spark, sf):
    df = hourly(spark, sf).withColumn("mean", F.when(F.col("n") > 2, F.col("dollars") / F.col("n")))
    got = D.panel_summary(df, KEYS, "price", "mean", B.Axis.spaced(0.1, 200, 20, log=True), B.Axis.spaced(0, 100, 20, log=False))
    return got.withColumns(rounded("largest_share"))


def active_hours(spark, sf):
    df = hourly(spark, sf)
    return Po.active_hours(df, ["day"], F.col("n") > 0, (F.col("n") >= 3) & (F.col("dollars") >= 60.005), 1.0)


def daily_members(spark, sf):
    return Po.daily_members(hourly(spark, sf).where("n > 0").select("day", "event_type").distinct(), "day", 24.0)


def view_crossings(spark, sf):
    df = studied(spark, sf)
    return A.view_crossings(df, F.col("common_eligible"), F.col(f"dollars_hl{FAST}s"), F.col(f"dollars_hl{SLOW}s"), 80.005, F.col("fast_match"), F.col("slow_match"))


def dimension_totals(spark, sf):
    """Study totals by member, session and overall from one aggregation."""
    df = studied(spark, sf)
    low = F.col("fast_match") & F.coalesce(F.col(f"dollars_hl{FAST}s") < 80.005, F.lit(False))
    measures = [F.count("*").alias("represented"), A.count_if(F.col("common_eligible")).alias("common_eligible"), A.count_if(F.col("fast_match")).alias("matching"), A.count_if(low).alias("below_floor"), A.count_if(F.col("fast_own_match")).alias("own_matching")]
    return A.scoped(df, {"member": ["event_type", "day"], "day": ["day"], "type": ["event_type"], "overall": ()}, measures)


def feature_catalog(spark, sf):
    """The 27 queryable fields of the default configuration."""
    rows = [tuple(f.values()) for f in Fe.feature_catalog()]
    return spark.createDataFrame(rows, ", ".join(f"`{k}` string" for k in Fe.feature_catalog()[0])).groupBy("table", "family", "source").agg(F.count("*").alias("fields"))


def quantile_grid(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    return D.discrete_quantiles(df, "o_totalprice", [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0], ["o_orderpriority"])


def dollar_profile(spark, sf):
    df = studied(spark, sf)
    got = D.profile(df, {"fast": F.col(f"dollars_hl{FAST}s"), "slow": F.col(f"dollars_hl{SLOW}s")}, {"common": F.col("common_eligible"), "matching": F.col("fast_match")}, 80.005)
    return got.withColumns(rounded("minimum", "p1", "p5", "p10", "p25", "p50", "share_below"))


def running_shares(spark, sf):
    df = spark.read.parquet(f"{sf}/part.parquet").groupBy("p_size").agg(F.count("*").alias("n"), F.sum("p_retailprice").alias("price"))
    return D.running_total(df, "p_size", ["n", "price"]).withColumns(rounded("price", "cum_price"))


def _members(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("session_date"), F.col("o_orderpriority").alias("symbol")).agg(F.count("*").alias("event_count")).withColumn("month", F.substring("session_date", 1, 7))


def stratified_sample(spark, sf):
    return Sa.ranked_candidates(_members(spark, sf), "seed-1", 2).select("month", "stratum", "cell_rank", "session_date", "symbol", "event_count", "monthly_rank", "monthly_members", "selection_hash")


def validation_report(spark, sf):
    df = hourly(spark, sf)
    return V.breaches(df, {"counts": F.col("n") >= 0, "some events": F.col("n") > 0, "price where events": F.col("price").isNotNull() == (F.col("n") > 0), "cheap": F.col("price") < 50})


def grid_check(spark, sf):
    return V.grid_breaches(hourly(spark, sf).where("n > 0"), GRID)


def order_violations(spark, sf):
    return V.order_violations(events(spark, sf).withColumn("ms", F.call_function("div", F.col("us"), F.lit(60_000_000))), KEYS, "ms", "user_id")


def key_alignment(spark, sf):
    df = hourly(spark, sf)
    got = V.key_alignment({"a": df.where("n > 0"), "b": df.where("n < 3"), "c": df}, GRID)
    return got.select("event_type", "end_s", *[F.col(c).cast("long").alias(c) for c in "abc"])


def exact_share_parse(spark, sf):
    text = F.concat(F.col("l_extendedprice").cast("decimal(20,3)").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("0000001")).otherwise(F.lit("000")))
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", text.alias("t")).withColumn("shares", exact_shares(F.col("t")))
    return df.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count("shares").alias("admitted"), F.sum("shares").cast("decimal(38,9)").cast("string").alias("total"))


def multi_join_star(spark, sf):
    """Broadcastable dimensions around a large fact table; filters and columns reach the scans."""
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    df = t("lineitem").where("l_quantity < 24").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    df = df.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.groupBy("r_name", "c_mktsegment").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("lines"), F.countDistinct(F.struct("o_orderkey", "c_custkey")).alias("orders"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        endpoint_screen, prepared_sql, three_state_predicates, activity_bands, gate_accounting, member_accounting, contributions, reason_tallies, concentration, daily_population,
        selection_segments, window_slice, gap_periods, period_summary, period_variants, best_window, directional_stretches, top_stretches, inside_period_semi, period_overlap,
        interval_union, dollar_periods, period_reproduction, availability_scopes, overlap_by_scope, disagreements, filter_contribution, membership, membership_change, threshold_crossings, set_algebra,
        ew_rates, ew_rms_participation, age_p90, current_ages, asof_prevailing, interval_integral, screen_two_bars, screen_denominators, exact_ecdf, ecdf_quantiles, joint_histogram, dense_histogram, joint_coverage,
        expanded_joint, binned_ecdf, ecdf_curve, activity_ecdf, panel_summary, active_hours, daily_members, view_crossings, dimension_totals, feature_catalog, quantile_grid, dollar_profile, running_shares, stratified_sample, validation_report, grid_check, order_violations, key_alignment, exact_share_parse, multi_join_star,
    )
    return {f.__name__: f for f in own} | {"strict_runs": strict_runs_query} | replay_queries.queries() | engine_queries.queries()
