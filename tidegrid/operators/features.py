"""Features of the base grid: exponentially weighted views, trailing age quantiles, and their support.

All state is cleared by a halted row.  A halted row opens an epoch; positions
count from it, so one partition (member, epoch) serves every window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import NS, FeatureConfig
from tidegrid.functions import masks as M
from tidegrid.functions.numbers import midpoint, return_bps, sorted_quantile
from tidegrid.grid import Grid
from tidegrid.operators.ew import ew_sums, power2

#: A view's value stems, units and families, in published order.
STEMS = (
    ("midpoint_rms_5s_bps", "bps", "return"),
    ("movement_participation", "1", "participation"),
    ("quoted_spread_bps", "bps", "spread"),
    ("trade_rate_per_second", "trades/s", "activity"),
    ("share_rate_per_second", "shares/s", "activity"),
    ("dollar_rate_usd_per_second", "USD/s", "activity"),
    ("bid_size_mean_shares", "shares", "bid_size"),
    ("ask_size_mean_shares", "shares", "ask_size"),
    ("midpoint_rms_5s_to_spread", "1", "ratio"),
)
AGES = ("trade", "quote", "midpoint_change")
LAG = 5


def source_of(age: str) -> str:
    return "trade" if age == "trade" else "quote"


def with_epoch(base: DataFrame, grid: Grid) -> DataFrame:
    """``_epoch`` (halted rows so far), ``_o`` (position in the epoch) and ``_elapsed`` (open rows in it)."""
    epoch = F.sum(F.col("halt_active").cast("int")).over(grid.window().rowsBetween(Window.unboundedPreceding, 0))
    df = base.withColumn("_epoch", epoch)
    df = df.withColumn("_o", F.row_number().over(grid.window("_epoch")) - 1)
    return df.withColumn("_elapsed", (F.col("_o") + F.when(F.col("_epoch") == 0, 1).otherwise(0)).cast("long"))


def ew_features(base: DataFrame, grid: Grid, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The EW values, masks and support of every view; the base columns stay."""
    df = with_epoch(base, grid)
    part = [*grid.keys, "_epoch"]
    order = grid.window("_epoch")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    open_ = ~F.col("halt_active")
    valid = open_ & (F.col("price_end_reason_mask") == 0) & F.col("bid_end_usd").isNotNull() & F.col("ask_end_usd").isNotNull()
    df = df.withColumn("_mid", F.when(valid, midpoint(F.col("bid_end_usd"), F.col("ask_end_usd"))))
    back, same = F.lag("_mid", LAG).over(order), F.lag("quote_continuity_id", LAG).over(order) == F.col("quote_continuity_id")
    df = df.withColumn("_ret", F.when(same & back.isNotNull() & F.col("_mid").isNotNull(), return_bps(back, F.col("_mid"))))
    seconds = lambda c: F.when(open_, F.col(c) / NS)
    usable = {
        "return": F.when(F.col("_ret").isNotNull(), 1.0), "spread": seconds("spread_valid_duration_ns"), "activity": seconds("activity_valid_duration_ns"),
        "bid_size": seconds("bid_size_valid_duration_ns"), "ask_size": seconds("ask_size_valid_duration_ns"),
    }
    sums = {
        "u1": F.abs("_ret"), "u2": F.col("_ret") * F.col("_ret"), "possible": F.when(open_, 1.0), "ring": F.when(open_ & (F.col("_elapsed") > LAG), 1.0),
        "n_spread": F.col("spread_integral_bps_seconds"), "n_trades": F.col("trade_count_1s"), "n_shares": F.col("share_volume_1s").cast("double"),
        "n_dollars": F.col("dollar_volume_1s_usd"), "n_bid": F.col("bid_size_integral_shares_seconds"), "n_ask": F.col("ask_size_integral_shares_seconds"),
    } | {f"w_{k}": v for k, v in usable.items()}
    df = ew_sums(df, part, grid.time, "_o", {f"_{k}_{v.half_life}": (F.when(open_, x), v.half_life) for v in config.views for k, x in sums.items()})
    df = df.withColumns({f"_has_{k}": F.coalesce(F.max(u > 0).over(so_far), F.lit(False)) for k, u in usable.items()})
    out: dict[str, Column] = {}
    for v in config.views:
        h = v.half_life
        c = lambda k, h=h: F.col(f"_{k}_{h}")
        name = lambda stem, h=h: f"{stem}_hl{h}s"
        # The last nonzero return anchors the powers: after it both sums only decay, so they are scaled rather than read at underflow.
        anchor = F.last(F.when(F.col("_ret") != 0, F.struct(c("u1").alias("u1"), c("u2").alias("u2"), F.col("_o").alias("o"))), ignorenulls=True).over(so_far)
        df = df.withColumn(f"_anchor_{h}", anchor)
        a = F.col(f"_anchor_{h}")
        idle = (F.col("_o") - a["o"]) / h

        def mask(family: str, floor: float, v=v, c=c) -> Column:
            side = "trade" if family == "activity" else "quote"
            possible = c("ring") if family == "return" else c("possible")
            return M.history_mask(F.col(f"{side}_source_status"), F.col("halt_active"), F.col("_elapsed"), v.startup, F.col(f"_has_{family}"), c(f"w_{family}"), possible, floor)

        df = df.withColumns({f"_m_{k}_{h}": mask(k, config.spread_coverage if k == "spread" else config.other_coverage) for k in usable})
        m = {k: F.col(f"_m_{k}_{h}") for k in usable}
        rms = F.when(a.isNull(), 0.0).otherwise(F.sqrt(a["u2"] / c("w_return")) * power2(-idle / 2))
        share = F.least(F.lit(1.0), a["u1"] * a["u1"] / a["u2"] / c("w_return") * power2(-idle))
        zero = M.bit((m["return"] == 0) & a.isNull(), M.ZERO_RETURN_VARIATION)
        values = {
            "midpoint_rms_5s_bps": (rms, m["return"]), "movement_participation": (share, m["return"].bitwiseOR(zero)),
            "quoted_spread_bps": (c("n_spread") / c("w_spread"), m["spread"]),
            "trade_rate_per_second": (c("n_trades") / c("w_activity"), m["activity"]), "share_rate_per_second": (c("n_shares") / c("w_activity"), m["activity"]),
            "dollar_rate_usd_per_second": (c("n_dollars") / c("w_activity"), m["activity"]),
            "bid_size_mean_shares": (c("n_bid") / c("w_bid_size"), m["bid_size"]), "ask_size_mean_shares": (c("n_ask") / c("w_ask_size"), m["ask_size"]),
        }
        for stem, (value, reason) in values.items():
            out[name(stem)], out[name(stem) + "_reason_mask"] = F.when(reason == 0, value), reason
        both = m["return"].bitwiseOR(m["spread"])
        no_spread = (both == 0) & (F.col(f"_n_spread_{h}") == 0)
        out[name("midpoint_rms_5s_to_spread")] = F.when((both == 0) & ~no_spread, rms / (c("n_spread") / c("w_spread")))
        out[name("midpoint_rms_5s_to_spread") + "_reason_mask"] = both.bitwiseOR(M.bit(no_spread, M.ZERO_SPREAD))
        out |= {name("return_usable_weight"): c("w_return"), name("return_possible_weight"): c("ring")}
        for k in ("spread", "activity", "bid_size", "ask_size"):
            out |= {name(f"{k}_usable_exposure_seconds"): c(f"w_{k}"), name(f"{k}_possible_exposure_seconds"): c("possible")}
    out |= {f"{s}_ew_startup_elapsed_seconds": F.col("_elapsed") for s in ("quote", "trade")}
    df = df.withColumns(out)
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def age_features(base: DataFrame, grid: Grid, config: FeatureConfig = FeatureConfig(), full_ns: int = NS, q: float = 0.9) -> DataFrame:
    """Trailing p90 of each age over each window, with masks and support; the base columns stay.

    A row appends a slot if its source was observed for the whole step and no
    break lies inside it (``{source}_interior_break``, false where absent).  A
    source's break clears its windows before the append; a halt clears all.
    """
    df = base
    for side in ("quote", "trade"):
        if f"{side}_interior_break" not in df.columns:
            df = df.withColumn(f"{side}_interior_break", F.lit(False))
    for side in ("quote", "trade"):
        running = grid.window().rowsBetween(Window.unboundedPreceding, 0)
        cleared = F.col("halt_active") | F.col(f"{side}_continuity_break_in_second")
        df = df.withColumn(f"_e_{side}", F.sum(cleared.cast("int")).over(running))
        append = ~F.col("halt_active") & (F.col(f"{side}_observed_duration_ns") == full_ns) & ~F.col(f"{side}_interior_break")
        df = df.withColumn(f"_a_{side}", append)
        df = df.withColumn(f"_slot_{side}", F.sum(append.cast("int")).over(grid.window(f"_e_{side}").rowsBetween(Window.unboundedPreceding, 0)))
    # One source after the other: its window arrays become quantiles before the next sort carries the rows on.
    for side in ("quote", "trade"):
        ages = [a for a in AGES if source_of(a) == side]
        part = [*grid.keys, f"_e_{side}"]
        arrays = {}
        for age in ages:
            known = F.when(F.col(f"_a_{side}") & (F.col(f"{age}_age_reason_mask") == 0), F.col(f"{age}_age_seconds"))
            for w in config.age_windows:
                frame = Window.partitionBy(*part).orderBy(f"_slot_{side}").rangeBetween(1 - w, 0)
                arrays[f"_v_{age}_{w}"] = F.sort_array(F.collect_list(known).over(frame))
        df = df.withColumns(arrays)
        out: dict[str, Column] = {}
        for age in ages:
            for w in config.age_windows:
                values, slots = F.col(f"_v_{age}_{w}"), F.least(F.col(f"_slot_{side}"), F.lit(w)).cast("int")
                count = F.size(values)
                reason = M.any_of(
                    M.source_bit(F.col(f"{side}_source_status")), M.bit(F.col("halt_active"), M.HALT), M.bit(slots < w, M.STARTUP), M.bit(count == 0, M.NO_SUPPORTED_DATA),
                    M.bit((count > 0) & (slots >= w) & (count < math.ceil(config.age_coverage * w)), M.LOW_COVERAGE),
                )
                name = f"{age}_age_p90_seconds_window{w}s"
                out |= {name: F.when(reason == 0, sorted_quantile(values, q)), name + "_reason_mask": reason}
                out |= {f"{age}_age_sample_count_window{w}s": count, f"{age}_age_elapsed_slots_window{w}s": slots}
        df = df.withColumns(out).drop(*arrays)
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def feature_names(config: FeatureConfig = FeatureConfig()) -> list[tuple[str, str, str, str]]:
    """(name, unit, family, source) of every feature in published order."""
    out = [(f"{s}_hl{v.half_life}s", unit, family, "trade" if family == "activity" else "quote") for v in config.views for s, unit, family in STEMS]
    return out + [(f"{a}_age_p90_seconds_window{w}s", "s", f"{a}_age", source_of(a)) for w in config.age_windows for a in AGES]


def feature_catalog(config: FeatureConfig = FeatureConfig()) -> list[dict]:
    """The queryable fields: features, then the base's current ages."""
    rows = [{"name": n, "unit": u, "family": f, "source": s, "table": "features", "reason_mask": f"{n}_reason_mask"} for n, u, f, s in feature_names(config)]
    return rows + [
        {"name": f"{a}_age_seconds", "unit": "s", "family": f"{a}_current_age", "source": source_of(a), "table": "current_ages", "reason_mask": f"{a}_age_reason_mask"} for a in AGES
    ]


def features(base: DataFrame, grid: Grid, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Base columns with all features and support."""
    return age_features(ew_features(base, grid, config), grid, config)
