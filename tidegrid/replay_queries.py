"""Registered queries of replay, features, validation and selection, on quotes and trades made from the events table.

A member is an event type with a session of 900 one-second steps.  Events whose
id is a multiple of three are trades, the others quotes; prices, sizes, codes
and clocks follow from ids and values.  Every member has a gap, breaks and two
halts at fixed places, so every rule of replay and features is met.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import NS, FeatureConfig, View
from tidegrid.functions import masks as M
from tidegrid.grid import Grid, session_bounds
from tidegrid.operators import admission
from tidegrid.operators import features as Fe
from tidegrid.operators import periods as P
from tidegrid.operators import replay as R
from tidegrid.operators import validation as V
from tidegrid.operators.runs import strict_runs
from tidegrid.operators.selection import Selection, annotate

DAY = "2026-09-02"
START = session_bounds(DAY)[0]
STEPS = 900
MICRO = 1000
GRID = Grid()
CONFIG = FeatureConfig(views=(View(4, 10), View(16, 40)), age_windows=(20, 60))

# Places in the session, in microseconds.
QUOTE_GAP, TRADE_GAP = (300_300_000, 302_700_000), (500_000_000, 503_000_001)
QUOTE_BREAKS, TRADE_BREAKS = (100_000_000, 250_000_123), (170_000_077,)
HALTS = ((700_200_000, 703_250_000, "h1"), (703_260_000, 704_000_000, "h2"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit(DAY).alias("session_date"), F.upper("event_type").alias("symbol"), "event_id", "user_id", "value",
        (F.lit(START) + F.pmod(us, F.lit(STEPS * 1_000_000)) * MICRO).alias("sip_timestamp"), F.col("event_id").alias("sequence_number"),
    )


def _list(value: Column) -> Column:
    return F.when(value.isNull(), F.array().cast("array<bigint>")).otherwise(F.array(value.cast("bigint")))


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    i, u = F.col("event_id"), F.col("user_id")
    bid = 100 + F.pmod(F.floor("value"), F.lit(40)) / 8
    return _events(spark, sf).where(i % 3 != 0).select(
        "session_date", "symbol", "sip_timestamp", "sequence_number", bid.alias("bid_price"), (bid + (i % 5 - 1) / 8).alias("ask_price"),
        ((i % 4) * 10).cast("double").alias("bid_size"), F.when(u % 7 != 0, ((u % 5) * 10).cast("double")).alias("ask_size"),
        _list(F.when(i % 23 == 0, 2).when(i % 29 == 0, 85)).alias("conditions"), F.array().cast("array<bigint>").alias("indicators"),
    )


def trades(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    return _events(spark, sf).where(i % 3 == 0).select(
        "session_date", "symbol", "sip_timestamp", "sequence_number", (F.col("sip_timestamp") - (i % 4) * 400_000_000).alias("participant_timestamp"),
        (100 + F.pmod(F.floor("value"), F.lit(16)) / 16).alias("price"), F.when(i % 19 == 0, "0").otherwise(F.concat((i % 9).cast("string"), F.lit(".5"))).alias("decimal_size"),
        F.lit(None).cast("double").alias("size"), _list(F.when(i % 17 == 0, 31).when(i % 11 == 0, 2)).alias("conditions"), F.when(i % 13 == 0, 1).cast("bigint").alias("correction"),
    )


def contexts(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda us: F.lit(START + us * MICRO)
    span = lambda a, b: F.struct(at(a).alias("start_ns"), at(b).alias("end_ns"))
    whole = F.array(span(0, STEPS * 1_000_000))
    columns = {
        "session_start_ns": at(0), "session_end_ns": at(STEPS * 1_000_000), "lot_multiplier": F.lit(100.0), "seed_verified": F.lit(False),
        "quote_observed": whole, "quote_gaps": F.array(span(*QUOTE_GAP)), "trade_observed": whole, "trade_gaps": F.array(span(*TRADE_GAP)),
        "quote_breaks": F.array(*[at(x) for x in QUOTE_BREAKS]), "trade_breaks": F.array(*[at(x) for x in TRADE_BREAKS]),
        "halts": F.array(*[F.struct(at(a).alias("start_ns"), at(b).alias("end_ns"), F.lit(n).alias("id")) for a, b, n in HALTS]),
    }
    return _events(spark, sf).select("session_date", "symbol").distinct().select("session_date", "symbol", *[columns[k].cast(t).alias(k) for k, t in R.CONTEXT.items()])


def base(spark: SparkSession, sf: str) -> DataFrame:
    return R.replay(quotes(spark, sf), trades(spark, sf), contexts(spark, sf), CONFIG, GRID)


def _second() -> Column:
    return F.call_function("div", F.col("interval_end_ns") - F.lit(START), F.lit(NS)).alias("second")


def _shown(df: DataFrame, *names: str, places: int = 9) -> DataFrame:
    """Keys and columns; doubles rounded."""
    kinds = dict(df.dtypes)
    one = lambda n: F.round(n, places).alias(n) if kinds[n] == "double" else F.col(n).cast("bigint").alias(n) if kinds[n] in ("smallint", "int") else F.col(n)
    return df.select("symbol", _second(), *[one(n) for n in names])


# --- replay -------------------------------------------------------------------


def replay_quotes(spark, sf):
    """Time-weighted quotes, spread and sizes, and the state at each second's end."""
    df = base(spark, sf).withColumn("spread_integral_bps_seconds", F.round("spread_integral_bps_seconds", 6))
    return _shown(
        df, "bid_twap_usd", "ask_twap_usd", "midpoint_twap_usd", "price_valid_duration_ns", "price_twap_reason_mask", "bid_end_usd", "ask_end_usd", "price_end_reason_mask", "spread_integral_bps_seconds",
        "spread_valid_duration_ns", "spread_integral_reason_mask", "bid_size_integral_shares_seconds", "bid_size_valid_duration_ns", "bid_size_integral_reason_mask",
        "ask_size_integral_shares_seconds", "ask_size_valid_duration_ns", "ask_size_integral_reason_mask", "bid_size_end_shares", "ask_size_end_shares", "bid_size_end_reason_mask", "ask_size_end_reason_mask", places=10,
    )


def replay_trades(spark, sf):
    """Trades, exact shares and dollars of each second, with their exposure and mask."""
    df = base(spark, sf).withColumn("shares", F.col("share_volume_1s").cast("string"))
    return _shown(df, "trade_count_1s", "shares", "dollar_volume_1s_usd", "activity_valid_duration_ns", "activity_reason_mask")


def replay_ages(spark, sf):
    """Current ages at each second's end, with the state of the midpoint's age."""
    df = base(spark, sf).withColumn("origin_ns", F.col("midpoint_observation_start_ns") - F.lit(START))
    return _shown(
        df, "trade_age_seconds", "trade_age_reason_mask", "quote_age_seconds", "quote_age_reason_mask", "midpoint_change_age_seconds", "midpoint_change_age_reason_mask", "midpoint_age_status", "origin_ns",
        "midpoint_age_lower_bound_seconds",
    )


def replay_continuity(spark, sf):
    """Source status, observation, continuity and halts of each second."""
    return _shown(
        base(spark, sf), "quote_source_status", "trade_source_status", "quote_observed_duration_ns", "trade_observed_duration_ns", "quote_continuity_id", "trade_continuity_id",
        "quote_continuity_break_in_second", "trade_continuity_break_in_second", "halt_active", "halt_id", "quote_interior_break", "trade_interior_break",
    )


def quote_classes(spark, sf):
    got = R.classify_quotes(quotes(spark, sf))
    return got.select("symbol", "sequence_number", "valid", "spread_ok", "bid_ok", "ask_ok")


def trade_classes(spark, sf):
    df = trades(spark, sf).withColumn("session_start_ns", F.lit(START))
    return R.classify_trades(df, CONFIG).select("symbol", "sequence_number", "kind", F.col("shares").cast("string").alias("shares"))


def member_admission(spark, sf):
    """Contexts with planted faults, and the rules that they break."""
    c = contexts(spark, sf)
    first = lambda name: F.col("symbol") == name
    bad = c.withColumns({
        "quote_gaps": F.when(first("CLICK"), F.concat("quote_gaps", F.array(F.struct((F.lit(START) + 1).alias("start_ns"), (F.lit(START) + 2).alias("end_ns"))))).otherwise(F.col("quote_gaps")),
        "trade_breaks": F.when(first("ERROR"), F.array(F.lit(START - 1))).otherwise(F.col("trade_breaks")),
        "session_end_ns": F.when(first("VIEW"), F.col("session_end_ns") + 5).otherwise(F.col("session_end_ns")),
        "halts": F.when(first("SIGNUP"), F.slice("halts", 1, 1)).otherwise(F.col("halts")),
    })
    repeated = bad.unionByName(bad.where(first("PURCHASE")))
    return admission.admit(repeated).select("symbol", "state", F.concat_ws(",", F.sort_array("reasons")).alias("reasons"))


# --- features -----------------------------------------------------------------


def ew_values(spark, sf):
    """Every exponentially weighted value and its mask, for two views."""
    df = Fe.ew_features(base(spark, sf), GRID, CONFIG)
    names = [f"{s}_hl{v.half_life}s" for v in CONFIG.views for s, _, _ in Fe.STEMS]
    return _shown(df, *names, *[f"{n}_reason_mask" for n in names], places=6)


def ew_support(spark, sf):
    """Usable and possible weights of every family, and the startup clocks."""
    df = Fe.ew_features(base(spark, sf), GRID, CONFIG)
    names = [f"{f}_{k}_hl{v.half_life}s" for v in CONFIG.views for f, k in _SUPPORT]
    return _shown(df, *names, "quote_ew_startup_elapsed_seconds", "trade_ew_startup_elapsed_seconds", places=6)


_SUPPORT = [("return_usable", "weight"), ("return_possible", "weight")] + [(f"{f}_{k}", "exposure_seconds") for f in ("spread", "activity", "bid_size", "ask_size") for k in ("usable", "possible")]


def age_quantiles(spark, sf):
    """Trailing p90 of the three ages over two windows, with masks, sample counts and slots."""
    df = Fe.age_features(base(spark, sf), GRID, CONFIG)
    names = [x for w in CONFIG.age_windows for a in Fe.AGES for x in (f"{a}_age_p90_seconds_window{w}s", f"{a}_age_p90_seconds_window{w}s_reason_mask", f"{a}_age_sample_count_window{w}s", f"{a}_age_elapsed_slots_window{w}s")]
    return _shown(df, *names, places=8)


# --- validation -----------------------------------------------------------------


def _spoiled(df: DataFrame, changes: dict[str, tuple[int, object]]) -> DataFrame:
    """Each named column set to a wrong value in the seconds that a number divides."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(_second() % n == 0, F.lit(x).cast(kinds[c])).otherwise(F.col(c)) for c, (n, x) in changes.items()})


SPOILED_BASE = {"bid_end_usd": (97, -1.0), "activity_valid_duration_ns": (89, NS + 1), "quote_age_seconds": (83, float("nan")), "trade_source_status": (79, 2), "halt_id": (73, "h")}


def base_validation(spark, sf):
    return V.breaches(_spoiled(base(spark, sf), SPOILED_BASE), V.base_rules())


def feature_validation(spark, sf):
    df = Fe.features(base(spark, sf), GRID, CONFIG)
    spoiled = _spoiled(df, {"movement_participation_hl4s": (97, 1.5), "midpoint_rms_5s_to_spread_hl16s": (89, 7.0), "quoted_spread_bps_hl4s_reason_mask": (83, M.STARTUP)})
    return V.breaches(spoiled, V.feature_rules(CONFIG))


def support_validation(spark, sf):
    df = Fe.features(base(spark, sf), GRID, CONFIG)
    spoiled = _spoiled(df, {"spread_usable_exposure_seconds_hl4s": (97, -1.0), "quote_age_sample_count_window20s": (89, 21), "trade_ew_startup_elapsed_seconds": (83, 60_000)})
    return V.breaches(spoiled, V.support_rules(CONFIG))


def projected_validation(spark, sf):
    df = Fe.features(base(spark, sf), GRID, CONFIG)
    spoiled = _spoiled(df, {"trade_rate_per_second_hl4s": (97, -1.0), "trade_age_seconds": (89, None)})
    return V.breaches(spoiled, V.projected_rules(Fe.feature_catalog(CONFIG), ["trade_rate_per_second_hl4s", "movement_participation_hl16s", "trade_age_seconds", "midpoint_change_age_seconds"]))


# --- selection and runs -----------------------------------------------------------


SELECTION = Selection(sessions=("premarket", "rth"), bounds=(START + 50 * NS + 1, START + 850 * NS), timing="nominal_post_discovery")


def _members(spark, sf) -> list[dict]:
    """Members with discovery times, one narrow row each."""
    rows = contexts(spark, sf).select("session_date", "symbol").orderBy("symbol").collect()
    return [{"session_date": r.session_date, "symbol": r.symbol, "discovery_ns": START + len(r.symbol) * 20 * NS + 5} for r in rows]


def _selected(spark, sf) -> DataFrame:
    return annotate(base(spark, sf), SELECTION.ranges(_members(spark, sf)), GRID)


def selection_ranges(spark, sf):
    rows = [(r["symbol"], r["segment_index"], r["session"], (r["first_ns"] - START) // NS, (r["last_ns"] - START) // NS) for r in SELECTION.ranges(_members(spark, sf))]
    return spark.createDataFrame(rows, "symbol string, segment_index int, session string, first_second bigint, last_second bigint")


def selection_annotated(spark, sf):
    return _shown(_selected(spark, sf), "selected", "selection_segment_id", "selection_segment_start", "selection_segment_end")


def strict_runs_sources(spark, sf):
    """Runs over replayed seconds that end at halts, source continuity and explicit boundaries."""
    s = _second()
    status = F.when(F.col("price_end_reason_mask") != 0, "unavailable").when(F.col("bid_end_usd") >= 101, "matching").otherwise("nonmatching")
    df = _selected(spark, sf).withColumns({"status": status, "before": F.when(s % 211 == 0, "explicit_before"), "after": F.when(s % 223 == 0, "explicit_after")})
    runs = strict_runs(df, GRID, "demo", sources=("quote", "trade"), before="before", after="after")
    return runs.select(
        "symbol", ((F.col("first_endpoint") - START) / NS).cast("bigint").alias("first_second"), ((F.col("last_endpoint") - START) / NS).cast("bigint").alias("last_second"), "match_count", "run_ordinal",
        "preceding_reason", "closure_reason", "left_censored", "right_censored",
    )


def best_quoted_window(spark, sf):
    """Each member's 30 seconds with the most wide quotes, among windows without an unavailable second."""
    df = base(spark, sf).withColumns({"session": F.when(_second() <= 450, "early").otherwise("late"), "eligible": F.col("price_end_reason_mask") == 0, "matching": F.coalesce(F.col("ask_end_usd") - F.col("bid_end_usd") >= 0.25, F.lit(False))})
    got = P.best_window(df, GRID, steps=30, occupancy=0.3)
    rel = lambda c: ((F.col(c) - START) / NS).cast("bigint").alias(c)
    return got.select("symbol", "session", rel("window_start"), rel("window_end"), "represented_steps", "eligible_steps", "matching_steps", F.round("occupancy", 6).alias("occupancy"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        replay_quotes, replay_trades, replay_ages, replay_continuity, quote_classes, trade_classes, member_admission, ew_values, ew_support, age_quantiles, base_validation, feature_validation, support_validation,
        projected_validation, selection_ranges, selection_annotated, strict_runs_sources, best_quoted_window,
    )
    return {f.__name__: f for f in own}
