"""Daily populations and active hours, and the activity gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.accounting import count_if


def active_gate(half_life: int = 30, window: int = 60, rate: float = 1.0, age: float = 2.0) -> tuple[Column, Column]:
    """(valid, passing) of the gate: enough trades, recent enough.  Fast is (30, 60), slow (120, 300)."""
    x, y = F.col(f"trade_rate_per_second_hl{half_life}s"), F.col(f"trade_age_p90_seconds_window{window}s")
    return x.isNotNull() & y.isNotNull(), (x >= rate) & (y <= age)


def daily_members(members: DataFrame, date: str = "session_date", hours: float = 16.0) -> DataFrame:
    """Completed members and represented hours of each date; a member listed twice is an error of the listing."""
    return members.groupBy(date).agg(F.count("*").alias("completed_members"), (F.count("*") * F.lit(float(hours))).alias("represented_hours"))


def active_hours(rows: DataFrame, keys: Sequence[str], valid: Column, passing: Column, steps_per_hour: float = 3600.0) -> DataFrame:
    """Represented, valid, passing, failing and unavailable steps, and hours that pass."""
    ok = F.coalesce(valid, F.lit(False))
    good = ok & F.coalesce(passing, F.lit(False))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("represented"), count_if(ok).alias("valid"), count_if(good).alias("pass"), count_if(ok & ~good).alias("fail"), count_if(~ok).alias("unavailable"),
        (F.count_if(good) / F.lit(float(steps_per_hour))).alias("active_hours"),
    )
