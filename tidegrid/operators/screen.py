"""Two-bar range and activity screen over minute bars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import NS
from tidegrid.functions.numbers import finite, positive


@dataclass(frozen=True)
class Screen:
    """Thresholds of a qualifying pair of neighbouring bars; the bar step is in the time column's unit."""

    range_bps: float = 700
    pair_transactions: float = 1600
    bar_transactions: float = 100
    kinds: tuple[str, ...] = ("CS", "ADRC")
    step: int = 60 * NS


def _valid(step: int) -> Column:
    """In its session, aligned, with usable activity and close."""
    t, v, c = (F.col(k).cast("double") for k in ("transactions", "volume", "close"))
    aligned = (F.col("window_start") >= F.col("session_start")) & (F.col("window_start") < F.col("session_end")) & (F.pmod(F.col("window_start"), F.lit(step)) == 0)
    return F.coalesce(aligned & finite(t) & finite(v) & finite(c) & (t >= 0) & (v >= 0) & (c > 0) & finite(v * c), F.lit(False))


def _quality() -> Column:
    o, c, h, low = (F.col(k).cast("double") for k in ("open", "close", "high", "low"))
    return F.coalesce(positive(o) & positive(c) & positive(h) & positive(low) & (h >= F.greatest(o, c, low)) & (low <= F.least(o, c, h)), F.lit(False))


def screened_bars(bars: DataFrame, reference: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """Bars of reference symbols of the wanted kinds that are valid, with ``quality`` and the pair's measures.

    A bar of bad quality stays in the order and so parts its neighbours.
    """
    kinds = reference.where(F.col("kind").isin(*screen.kinds)).select("symbol", "kind")
    good = bars.join(kinds, "symbol").where(_valid(screen.step)).withColumn("quality", _quality())
    order = Window.partitionBy("symbol").orderBy("window_start")
    before = F.lag(F.struct("window_start", "transactions", "high", "low", "quality")).over(order)
    good = good.withColumn("_p", before)
    pair = F.col("quality") & F.col("_p.quality") & (F.col("window_start") - F.col("_p.window_start") == screen.step)
    tr = F.col("transactions").cast("double")
    return good.withColumns({
        "pair": F.coalesce(pair, F.lit(False)), "pair_start": F.col("_p.window_start"),
        "range_bps": 10_000 * F.ln(F.try_divide(F.greatest("high", "_p.high").cast("double"), F.nullif(F.least("low", "_p.low").cast("double"), F.lit(0.0)))),
        "pair_transactions": tr + F.col("_p.transactions"), "least_transactions": F.least(tr, F.col("_p.transactions").cast("double")),
    }).drop("_p")


def qualifying(bars: DataFrame, screen: Screen = Screen()) -> DataFrame:
    return bars.where(F.col("pair") & (F.col("range_bps") >= screen.range_bps) & (F.col("pair_transactions") >= screen.pair_transactions) & (F.col("least_transactions") >= screen.bar_transactions))


def first_hits(bars: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """Each symbol's first qualifying pair; discovery is the close of its second bar.  An aggregate, not a sort."""
    row = F.struct("window_start", "kind", "pair_start", "range_bps", "pair_transactions", "least_transactions")
    hit = qualifying(bars, screen).groupBy("symbol").agg(F.min_by(row, "window_start").alias("h"))
    return hit.select("symbol", "h.kind", (F.col("h.window_start") + screen.step).alias("discovery_endpoint"), F.col("h.pair_start").alias("window_start"), "h.range_bps", "h.pair_transactions", "h.least_transactions")


def denominators(bars: DataFrame, reference: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """One row of counts: input, eligible, valid, bad-quality bars, symbols, qualifying pairs and candidates."""
    kinds = reference.where(F.col("kind").isin(*screen.kinds)).select("symbol")
    eligible = bars.join(kinds, "symbol", "left_semi")
    seen = screened_bars(bars, reference, screen)
    hits = qualifying(seen, screen)
    parts = [
        kinds.agg(F.count("*").alias("reference_symbols")), bars.agg(F.count("*").alias("input_rows")), eligible.agg(F.count("*").alias("eligible_rows")),
        seen.agg(F.count("*").alias("valid_session_rows"), F.count_if(~F.col("quality")).alias("invalid_ohlc_rows"), F.countDistinct("symbol").alias("eligible_source_symbols")),
        hits.agg(F.count("*").alias("qualifying_windows"), F.countDistinct("symbol").alias("candidates")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))
    return out


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """(symbol, time) pairs that occur more than once; a screen's input must have none."""
    return bars.groupBy("symbol", "window_start").count().where("count > 1")
