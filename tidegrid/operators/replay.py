"""Raw quotes and trades to the one-second base grid, by change events and windows instead of a row loop.

A member's context has its session bounds, observation intervals, gaps, breaks,
halts, seed basis and quote lot size (``CONTEXT`` names the columns).  Resets
(breaks, gap onsets, halt entries) are rows of the event stream that come
before events of the same time; running counts of them give epochs, and states
are windows inside epochs.  State intervals are split at second ends and
summed.  Bad admissions (unknown correction, malformed codes or quantities)
fail the job, as data that cannot be trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import NS, FeatureConfig
from tidegrid.functions import masks as M
from tidegrid.functions.numbers import exact_shares, finite, midpoint, positive
from tidegrid.grid import Grid, whole_div
from tidegrid.operators.intervals import as_of

#: Columns of a member's context besides its keys.
CONTEXT = {
    "session_start_ns": "bigint", "session_end_ns": "bigint", "lot_multiplier": "double", "seed_verified": "boolean",
    **{f"{s}_{k}": "array<struct<start_ns:bigint,end_ns:bigint>>" for s in ("quote", "trade") for k in ("observed", "gaps")},
    "quote_breaks": "array<bigint>", "trade_breaks": "array<bigint>",
    "halts": "array<struct<start_ns:bigint,end_ns:bigint,id:string>>",
}
SEED_NS = 300 * NS

# Accepted vendor codes and their meanings.
RTH_TRADE_CONDITIONS = (0, 3, 14, 36, 37, 41, 60)
EXTENDED_TRADE_CONDITIONS = (0, 3, 12, 14, 36, 37, 41, 60)
CAUSAL_CORRECTIONS = (0, 7, 8)
KNOWN_CORRECTIONS = (0, 1, 7, 8, 10, 11, 12)
KNOWN_TRADE_CONDITIONS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 32, 33, 34, 35, 36, 37, 38, 39, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 50, 51, 52, 53, 54, 55, 56, 59, 60)
KNOWN_QUOTE_CONDITIONS = (-1, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 25, 26, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 37, 38, 39, 40, 41, 42, 43, 71, 80, 81, 82, 83, 84, 85, 86, 87, 88, 89, 90, 91, 92, 94)
KNOWN_QUOTE_INDICATORS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 304, 501, 502, 503, 504, 505, 506, 507, 508, 509, 601, 602, 603, 604, 605, 901, 902, 903, 904, 905, 906, 907, 908)
ONE_SIDED_QUOTE_CODES = (2, 34)
NONFIRM_QUOTE_CODES = (20,)
CLOSED_QUOTE_CODES = (15, 19, 32)
INVALID_VALUE_QUOTE_CODES = (-1, 80, 83)
CROSSED_QUOTE_CODES = (84,)
LOCKED_QUOTE_CODE = 85
INVALID_QUOTE_CODES = (*ONE_SIDED_QUOTE_CODES, *NONFIRM_QUOTE_CODES, *CLOSED_QUOTE_CODES, *INVALID_VALUE_QUOTE_CODES, *CROSSED_QUOTE_CODES)
MOST_CODES = 64


def _codes(values: tuple[int, ...]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _checked(codes: Column, what: str) -> Column:
    """A code list; null is empty, too long a list is an error."""
    listed = F.coalesce(codes.cast("array<bigint>"), F.array().cast("array<bigint>"))
    return F.when((F.size(listed) > MOST_CODES) | F.exists(listed, lambda c: c.isNull()), F.raise_error(F.lit(f"malformed {what} codes")).cast("array<bigint>")).otherwise(listed)


def _unknown(codes: Column, known: tuple[int, ...]) -> Column:
    return F.size(F.array_except(codes, _codes(known))) > 0


def covered(intervals: Column, a: Column, b: Column) -> Column:
    """Nanoseconds of [a, b) inside sorted disjoint intervals."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(intervals, zero, lambda acc, x: acc + F.greatest(zero, F.least(b, x["end_ns"]) - F.greatest(a, x["start_ns"])))


def inside(intervals: Column, at: Column) -> Column:
    return F.exists(intervals, lambda x: (x["start_ns"] <= at) & (at < x["end_ns"]))


def classify_quotes(quotes: DataFrame) -> DataFrame:
    """Adds ``valid`` (two-sided usable prices), ``spread_ok``, ``bid_ok`` and ``ask_ok``."""
    codes, indicators = _checked(F.col("conditions"), "quote condition"), _checked(F.col("indicators"), "quote indicator")
    bid, ask = F.col("bid_price"), F.col("ask_price")
    bad = _unknown(codes, KNOWN_QUOTE_CONDITIONS) | _unknown(indicators, KNOWN_QUOTE_INDICATORS) | F.arrays_overlap(codes, _codes(INVALID_QUOTE_CODES))
    valid = ~bad & positive(bid) & positive(ask) & F.coalesce(ask >= bid, F.lit(False))
    locked = F.array_contains(codes, LOCKED_QUOTE_CODE)
    return quotes.withColumns({
        "valid": valid, "spread_ok": valid & ~(locked & (bid != ask)),
        "bid_ok": valid & positive(F.col("bid_size")), "ask_ok": valid & positive(F.col("ask_size")),
    })


def trade_quantity() -> Column:
    """Exact shares: decimal text first, else a float whose binary value has at most nine decimal places."""
    size = F.col("size")
    exact = finite(size) & (size * 512 == F.floor(size * 512))
    return F.coalesce(exact_shares(F.col("decimal_size")), F.when(F.col("decimal_size").isNull() & exact, size.cast("decimal(38,9)")))


def classify_trades(trades: DataFrame, config: FeatureConfig = FeatureConfig(), start: str = "session_start_ns") -> DataFrame:
    """Adds ``kind`` (eligible, excluded, uncertain) and ``shares`` (exact, of eligible trades).

    Order of the rules: correction, unknown codes, allowed codes and reporting
    age, price, quantity.
    """
    correction = F.coalesce(F.col("correction"), F.lit(0))
    codes = _checked(F.col("conditions"), "trade condition")
    fail = lambda what: F.raise_error(F.lit(what)).cast("string")
    elapsed = whole_div(F.col("sip_timestamp") - F.col(start), NS)
    regular = (elapsed >= 19_800) & (elapsed < 43_200)
    disallowed = F.when(regular, F.size(F.array_except(codes, _codes(RTH_TRADE_CONDITIONS)))).otherwise(F.size(F.array_except(codes, _codes(EXTENDED_TRADE_CONDITIONS)))) > 0
    age = F.col("sip_timestamp") - F.col("participant_timestamp")
    price, shares = F.col("price"), trade_quantity()
    given = F.coalesce(F.col("decimal_size"), F.col("size").cast("string")).isNotNull()
    negative = F.col("decimal_size").isNull() & finite(F.col("size")) & (F.col("size") <= 0)
    kind = (
        F.when(~correction.isin(*KNOWN_CORRECTIONS), fail("unknown correction scope")).when(~correction.isin(*CAUSAL_CORRECTIONS), "excluded")
        .when(_unknown(codes, KNOWN_TRADE_CONDITIONS), "uncertain").when(F.col("participant_timestamp").isNull(), fail("untrustworthy participant clock"))
        .when(disallowed | (age < 0) | (age > config.trade_reporting_age_ns), "excluded").when(~finite(price), "uncertain").when(price <= 0, "excluded")
        .when(negative, "excluded").when(~given | shares.isNull() | (shares < 0), fail("untrustworthy trade quantity")).when(shares == 0, "excluded").otherwise("eligible")
    )
    return trades.withColumn("kind", kind).withColumn("shares", F.when(F.col("kind") == "eligible", shares))


def halted_seconds(context: DataFrame, grid: Grid) -> DataFrame:
    """Whole seconds that a halt touches, with the id of the first such halt listed."""
    one = context.select(*grid.keys, "session_start_ns", "session_end_ns", F.posexplode("halts").alias("_at", "h"))
    first, last = F.greatest(F.col("h.start_ns"), F.col("session_start_ns")), F.least(F.col("h.end_ns"), F.col("session_end_ns"))
    # the ends of the seconds that hold [first, last)
    ends = F.sequence(first - F.pmod(first, F.lit(grid.step)) + grid.step, last - 1 - F.pmod(last - 1, F.lit(grid.step)) + grid.step, F.lit(grid.step))
    return one.where(last > first).select(*grid.keys, F.explode(ends).alias(grid.time), "_at", F.col("h.id").alias("id")).groupBy(*grid.keys, grid.time).agg(F.min_by("id", "_at").alias("halt_id"))


def resets(context: DataFrame, halted: DataFrame, grid: Grid, side: str) -> DataFrame:
    """(keys, ts, kind): a row per break and gap onset in the session, and one per halt entry."""
    onsets = F.transform(F.coalesce(f"{side}_gaps", F.array().cast("array<struct<start_ns:bigint,end_ns:bigint>>")), lambda g: g["start_ns"])
    listed = context.select(*grid.keys, "session_start_ns", "session_end_ns", F.explode(F.concat(F.coalesce(f"{side}_breaks", F.array().cast("array<bigint>")), onsets)).alias("ts"))
    breaks = listed.where((F.col("ts") >= F.col("session_start_ns")) & (F.col("ts") < F.col("session_end_ns"))).select(*grid.keys, "ts", F.lit("break").alias("kind"))
    before = F.lag(grid.time).over(grid.window())
    entry = halted.withColumn("_new", F.coalesce(F.col(grid.time) - before != grid.step, F.lit(True))).where("_new")
    return breaks.unionByName(entry.select(*grid.keys, (F.col(grid.time) - grid.step).alias("ts"), F.lit("halt").alias("kind")))


def _open_events(events: DataFrame, context: DataFrame, halted: DataFrame, grid: Grid, gaps: str) -> DataFrame:
    """Events that are applied: outside halted seconds and gaps."""
    at = F.col("sip_timestamp")
    spans = context.select(*[F.col(k).alias(f"_{k}") for k in grid.keys], F.inline(gaps).alias("_start", "_stop"))
    on = (at >= F.col("_start")) & (at < F.col("_stop"))
    for k in grid.keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    listed = events.join(spans, on, "left_anti").join(context, list(grid.keys))
    return listed.withColumn(grid.time, grid.end_of(at)).join(halted.select(*grid.keys, grid.time), grid.columns, "left_anti")


def quote_states(quotes: DataFrame, context: DataFrame, halted: DataFrame, grid: Grid) -> DataFrame:
    """The quote state from each change event on: one row per applied quote and reset."""
    pre = (F.col("sip_timestamp") >= F.col("session_start_ns")) | (F.col("seed_verified") & (F.col("sip_timestamp") >= F.col("session_start_ns") - SEED_NS))
    applied = _open_events(quotes, context, halted, grid, "quote_gaps").where(pre & (F.col("sip_timestamp") < F.col("session_end_ns")))
    lot = F.coalesce("lot_multiplier", F.lit(1.0))
    q = classify_quotes(applied).select(
        *grid.keys, F.col("sip_timestamp").alias("ts"), F.lit(1).alias("rank"), F.col("sequence_number").alias("seq"), "session_start_ns", "session_end_ns", "quote_observed", "quote_gaps",
        "valid", "spread_ok", "bid_ok", "ask_ok", F.when(F.col("valid"), F.col("bid_price").cast("double")).alias("bid"), F.when(F.col("valid"), F.col("ask_price").cast("double")).alias("ask"),
        F.when(F.col("bid_ok"), F.col("bid_size").cast("double") * lot).alias("bid_shares"), F.when(F.col("ask_ok"), F.col("ask_size").cast("double") * lot).alias("ask_shares"),
    )
    r = resets(context, halted, grid, "quote").join(context.select(*grid.keys, "session_start_ns", "session_end_ns", "quote_observed", "quote_gaps"), list(grid.keys)).select(
        *grid.keys, "ts", F.lit(0).alias("rank"), F.lit(-1).cast("long").alias("seq"), "session_start_ns", "session_end_ns", "quote_observed", "quote_gaps"
    )
    every = q.unionByName(r, allowMissingColumns=True).withColumns({k: F.coalesce(k, F.lit(False)) for k in ("valid", "spread_ok", "bid_ok", "ask_ok")})
    order = Window.partitionBy(*grid.keys).orderBy("ts", "rank", "seq")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    reset = F.col("rank") == 0
    every = every.withColumns({
        "reset_id": F.sum(reset.cast("int")).over(running), "run": F.sum((reset | ~F.col("valid")).cast("int")).over(running), "mid": F.when(F.col("valid"), midpoint(F.col("bid"), F.col("ask"))),
        "until": F.lead("ts").over(order),
    })
    in_epoch = Window.partitionBy(*grid.keys, "reset_id").orderBy("ts", "rank", "seq").rowsBetween(Window.unboundedPreceding, 0)
    in_run = Window.partitionBy(*grid.keys, "run").orderBy("ts", "rank", "seq")
    so_far = in_run.rowsBetween(Window.unboundedPreceding, 0)
    previous = F.last("mid", ignorenulls=True).over(in_run.rowsBetween(Window.unboundedPreceding, -1))
    every = every.withColumns({
        "invalid_seen": F.max(~reset & ~F.col("valid")).over(in_epoch), "last_quote_ns": F.last(F.when(~reset, F.col("ts")), ignorenulls=True).over(in_epoch),
        "_changed": F.when(F.col("valid") & (F.col("mid") != previous) & (F.col("ts") >= F.col("session_start_ns")), F.col("ts")),
    })
    return every.withColumns({
        # a seed's run counts from the session's start
        "origin_ns": F.when(F.col("valid"), F.greatest(F.min(F.when(F.col("valid"), F.col("ts"))).over(so_far), F.col("session_start_ns"))),
        "last_change_ns": F.when(F.col("valid"), F.last("_changed", ignorenulls=True).over(so_far)),
        "broken": reset, "until": F.coalesce("until", "session_end_ns"),
    }).drop("_changed", "run")


def quote_integrals(states: DataFrame, halted: DataFrame, grid: Grid) -> DataFrame:
    """Per second: time integrals of valid states over observed time, with their own durations."""
    clipped = states.where("valid").withColumns({"a": F.greatest("ts", "session_start_ns"), "b": F.least("until", "session_end_ns")}).where("b > a")
    ends = F.sequence(grid.end_of(F.col("a")), grid.end_of(F.col("b") - 1), F.lit(grid.step))
    pieces = clipped.withColumn(grid.time, F.explode(ends)).join(halted.select(*grid.keys, grid.time), grid.columns, "left_anti")
    pieces = pieces.withColumns({"a": F.greatest(F.col("a"), F.col(grid.time) - grid.step), "b": F.least("b", grid.time)})
    ns = covered(F.col("quote_observed"), F.col("a"), F.col("b")) - F.coalesce(covered(F.col("quote_gaps"), F.col("a"), F.col("b")), F.lit(0))
    pieces = pieces.withColumn("ns", ns).where("ns > 0").withColumn("sec", F.col("ns") / grid.step)
    only = lambda flag, x: F.sum(F.when(F.col(flag), x))
    spread = 10_000 * (F.col("ask") - F.col("bid")) / midpoint(F.col("bid"), F.col("ask"))
    return pieces.groupBy(*grid.columns).agg(
        F.sum(F.col("bid") * F.col("sec")).alias("bid_sum"), F.sum(F.col("ask") * F.col("sec")).alias("ask_sum"), F.sum("ns").alias("price_ns"),
        only("spread_ok", spread * F.col("sec")).alias("spread_sum"), only("spread_ok", F.col("ns")).alias("spread_ns"),
        only("bid_ok", F.col("bid_shares") * F.col("sec")).alias("bid_size_sum"), only("bid_ok", F.col("ns")).alias("bid_size_ns"),
        only("ask_ok", F.col("ask_shares") * F.col("sec")).alias("ask_size_sum"), only("ask_ok", F.col("ns")).alias("ask_size_ns"),
    )


def replay(quotes: DataFrame, trades: DataFrame, context: DataFrame, config: FeatureConfig = FeatureConfig(), grid: Grid = Grid()) -> DataFrame:
    """The base grid of every member of ``context``, with two extra columns, ``{source}_interior_break``."""
    keys, t = list(grid.keys), F.col(grid.time)
    halted = halted_seconds(context, grid)
    states = quote_states(quotes, context, halted, grid)
    integrals = quote_integrals(states, halted, grid)

    # Trades: resets, eligible and uncertain events make the state; sums are per second.
    applied = _open_events(trades, context, halted, grid, "trade_gaps").where((F.col("sip_timestamp") >= F.col("session_start_ns")) & (F.col("sip_timestamp") < F.col("session_end_ns")))
    kinds = classify_trades(applied, config).where("kind <> 'excluded'")
    activity = kinds.groupBy(*grid.columns).agg(
        F.count_if(F.col("kind") == "eligible").alias("n"), F.sum("shares").alias("shares"), F.sum(F.col("price").cast("double") * F.col("shares").cast("double")).alias("dollars"),
        F.bool_or(F.col("kind") == "uncertain").alias("uncertain"),
    )
    trade_resets = resets(context, halted, grid, "trade").select(*keys, "ts", F.lit(0).alias("rank"), F.lit(-1).cast("long").alias("seq"), F.lit("reset").alias("kind"))
    stream = kinds.select(*keys, F.col("sip_timestamp").alias("ts"), F.lit(1).alias("rank"), F.col("sequence_number").alias("seq"), "kind").unionByName(trade_resets)
    running = Window.partitionBy(*keys).orderBy("ts", "rank", "seq").rowsBetween(Window.unboundedPreceding, 0)
    stream = stream.withColumns({
        "last_trade": F.when(F.col("kind") == "eligible", F.col("ts")), "t_broken": F.last(F.when(F.col("kind") != "uncertain", F.col("kind") == "reset"), ignorenulls=True).over(running),
        "t_cont": F.sum((F.col("kind") == "reset").cast("int")).over(running),
        "tie": F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "rank", "seq")),
    })

    members = context.withColumns({"start": F.col("session_start_ns"), "stop": F.col("session_end_ns")})
    seconds = grid.dense(members).join(halted, grid.columns, "left")
    points = seconds.select(*grid.columns)
    q_tie = states.withColumn("tie", F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "rank", "seq"))).withColumnsRenamed({"ts": grid.time})
    q_state = as_of(points, q_tie, keys, grid.time, ["valid", "bid", "ask", "bid_ok", "ask_ok", "bid_shares", "ask_shares", "origin_ns", "last_change_ns", "last_quote_ns", "invalid_seen", "broken", "reset_id"], tie="tie")
    t_state = as_of(points, stream.withColumnRenamed("ts", grid.time), keys, grid.time, ["last_trade", "t_broken", "t_cont"], tie="tie")
    df = seconds.join(q_state, grid.columns).join(t_state, grid.columns).join(integrals, grid.columns, "left").join(activity, grid.columns, "left")

    left, halt = t - grid.step, F.col("halt_id").isNotNull()
    entry = halt & ~F.coalesce(F.lag(halt).over(grid.window()), F.lit(False))
    status, observed, in_second, interior = {}, {}, {}, {}
    for s in ("quote", "trade"):
        gaps = F.coalesce(f"{s}_gaps", F.array().cast("array<struct<start_ns:bigint,end_ns:bigint>>"))
        status[s] = F.when(inside(F.col(f"{s}_observed"), t - 1) & ~inside(gaps, t - 1), M.ACCEPTED).otherwise(M.UNAVAILABLE)
        observed[s] = F.greatest(F.lit(0).cast("bigint"), covered(F.col(f"{s}_observed"), left, t) - covered(gaps, left, t))
        marks = F.concat(F.coalesce(f"{s}_breaks", F.array().cast("array<bigint>")), F.transform(gaps, lambda g: g["start_ns"]))
        in_second[s] = F.exists(marks, lambda x: (x >= left) & (x < t))
        interior[s] = F.exists(marks, lambda x: (x > left) & (x < t))
    df = df.withColumns({
        "halt_active": halt, "_entry": entry, "quote_source_status": status["quote"].cast("smallint"), "trade_source_status": status["trade"].cast("smallint"),
        "quote_observed_duration_ns": observed["quote"], "trade_observed_duration_ns": observed["trade"], "_qb": in_second["quote"], "_tb": in_second["trade"],
        "quote_interior_break": interior["quote"], "trade_interior_break": interior["trade"], **{k: F.coalesce(k, F.lit(0)) for k in ("price_ns", "spread_ns", "bid_size_ns", "ask_size_ns")},
        **{k: F.coalesce(k, F.lit(False)) for k in ("valid", "bid_ok", "ask_ok", "invalid_seen", "broken", "t_broken", "uncertain")},
    })
    # A halted second shows the cleared state.
    halt, qs, ts = F.col("halt_active"), F.col("quote_source_status"), F.col("trade_source_status")
    broken, t_broken = F.col("broken"), F.col("t_broken")
    live = {k: F.col(k) & ~halt for k in ("valid", "bid_ok", "ask_ok")}
    active_ns = F.when(halt | F.col("uncertain"), F.lit(0).cast("bigint")).otherwise(F.col("trade_observed_duration_ns"))
    has_activity = active_ns > 0
    age = lambda c: F.when(~halt, (t - F.col(c)) / grid.step)
    mid_status = F.when(halt | ~F.col("valid"), M.UNOBSERVABLE).when(F.col("last_change_ns").isNotNull(), M.KNOWN).otherwise(M.NO_CHANGE_OBSERVED)
    known, unchanged = mid_status == M.KNOWN, mid_status == M.NO_CHANGE_OBSERVED
    per = lambda total, ns: F.when(F.col(ns) > 0, F.col(total) / (F.col(ns) / grid.step))
    supported = lambda ns: M.supported_mask(F.col(ns), halt, qs, F.col("invalid_seen"), broken)
    current = lambda ok, **k: M.current_mask(ok, halt, qs, broken, **k)
    bid_twap, ask_twap = per("bid_sum", "price_ns"), per("ask_sum", "price_ns")
    sized = lambda total, ns: F.when(F.col(ns) > 0, F.col(total))
    return df.select(
        *grid.columns, bid_twap.alias("bid_twap_usd"), ask_twap.alias("ask_twap_usd"), (bid_twap / 2 + ask_twap / 2).alias("midpoint_twap_usd"), F.col("price_ns").alias("price_valid_duration_ns"),
        supported("price_ns").alias("price_twap_reason_mask"), F.when(live["valid"], F.col("bid")).alias("bid_end_usd"), F.when(live["valid"], F.col("ask")).alias("ask_end_usd"),
        current(live["valid"]).alias("price_end_reason_mask"),
        sized("spread_sum", "spread_ns").alias("spread_integral_bps_seconds"), F.col("spread_ns").alias("spread_valid_duration_ns"), supported("spread_ns").alias("spread_integral_reason_mask"),
        sized("bid_size_sum", "bid_size_ns").alias("bid_size_integral_shares_seconds"), F.col("bid_size_ns").alias("bid_size_valid_duration_ns"), supported("bid_size_ns").alias("bid_size_integral_reason_mask"),
        sized("ask_size_sum", "ask_size_ns").alias("ask_size_integral_shares_seconds"), F.col("ask_size_ns").alias("ask_size_valid_duration_ns"), supported("ask_size_ns").alias("ask_size_integral_reason_mask"),
        F.when(live["bid_ok"], F.col("bid_shares")).alias("bid_size_end_shares"), F.when(live["ask_ok"], F.col("ask_shares")).alias("ask_size_end_shares"),
        current(live["bid_ok"]).alias("bid_size_end_reason_mask"), current(live["ask_ok"]).alias("ask_size_end_reason_mask"),
        F.when(has_activity, F.coalesce("n", F.lit(0))).alias("trade_count_1s"), F.when(has_activity, F.coalesce("shares", F.lit(0))).cast("decimal(38,9)").alias("share_volume_1s"),
        F.when(has_activity, F.coalesce("dollars", F.lit(0.0))).alias("dollar_volume_1s_usd"), active_ns.alias("activity_valid_duration_ns"),
        M.supported_mask(active_ns, halt, ts, F.col("uncertain"), t_broken).alias("activity_reason_mask"),
        age("last_trade").alias("trade_age_seconds"), M.current_mask(F.col("last_trade").isNotNull() & ~halt, halt, ts, t_broken, missing_event=True).alias("trade_age_reason_mask"),
        age("last_quote_ns").alias("quote_age_seconds"), current(F.col("last_quote_ns").isNotNull() & ~halt, missing_event=True).alias("quote_age_reason_mask"),
        F.when(known, age("last_change_ns")).alias("midpoint_change_age_seconds"), current(known, bound=unchanged).alias("midpoint_change_age_reason_mask"),
        mid_status.cast("smallint").alias("midpoint_age_status"), F.when(known | unchanged, F.col("origin_ns")).alias("midpoint_observation_start_ns"),
        F.when(unchanged, age("origin_ns")).alias("midpoint_age_lower_bound_seconds"),
        "quote_source_status", "trade_source_status", "quote_observed_duration_ns", "trade_observed_duration_ns",
        F.coalesce("reset_id", F.lit(0)).cast("bigint").alias("quote_continuity_id"), F.coalesce("t_cont", F.lit(0)).cast("bigint").alias("trade_continuity_id"),
        (F.col("_qb") | F.col("_entry")).alias("quote_continuity_break_in_second"), (F.col("_tb") | F.col("_entry")).alias("trade_continuity_break_in_second"),
        "halt_active", "halt_id", "quote_interior_break", "trade_interior_break",
    )
