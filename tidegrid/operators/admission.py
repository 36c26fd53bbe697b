"""Admission of member contexts: every rule is a Column, and a member's broken rules are its reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import NS
from tidegrid.grid import session_start, whole_div

MOST_HALTS = 1024
SESSION_SECONDS = 57_600


def _pairs(intervals: Column, test) -> Column:
    """``test(left, right)`` holds for all neighbours of an array."""
    n = F.size(intervals)
    left, right = F.slice(intervals, 1, F.greatest(n - 1, F.lit(0))), F.slice(intervals, 2, F.greatest(n - 1, F.lit(0)))
    return (n < 2) | F.forall(F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: test(p["a"], p["b"]))


def _proper(intervals: Column, start: Column, end: Column) -> Column:
    """Ascending, disjoint, non-empty and inside [start, end]."""
    inside = F.forall(intervals, lambda x: (x["start_ns"] >= start) & (x["start_ns"] < x["end_ns"]) & (x["end_ns"] <= end))
    return inside & _pairs(intervals, lambda a, b: a["end_ns"] <= b["start_ns"])


def rules() -> dict[str, Column]:
    start, end = F.col("session_start_ns"), F.col("session_end_ns")
    out = {
        "session start": start == session_start(F.col("session_date")),
        "coverage on the grid": (end > start) & (end <= start + SESSION_SECONDS * NS) & (F.pmod(end - start, F.lit(NS)) == 0),
        "symbol": F.rlike("symbol", F.lit(r"^[A-Z0-9][A-Z0-9._-]{0,31}$")),
    }
    for s in ("quote", "trade"):
        seen = F.col(f"{s}_observed")
        tiles = (F.size(seen) > 0) & (F.element_at(seen, 1)["start_ns"] == start) & (F.element_at(seen, -1)["end_ns"] == end) & _pairs(seen, lambda a, b: a["end_ns"] == b["start_ns"])
        out |= {
            f"{s} intervals cover": _proper(seen, start, end) & tiles, f"{s} gaps": _proper(F.coalesce(f"{s}_gaps", F.array().cast("array<struct<start_ns:bigint,end_ns:bigint>>")), start, end),
            f"{s} breaks": F.forall(F.coalesce(f"{s}_breaks", F.array().cast("array<bigint>")), lambda x: (x >= start) & (x < end)),
        }
    halts = F.col("halts")
    out |= {
        "halts": (F.size(halts) <= MOST_HALTS) & F.forall(halts, lambda h: (h["start_ns"] >= start) & (h["start_ns"] < h["end_ns"]) & (h["end_ns"] <= end)),
        # closures are whole seconds; two that touch would be one
        "halt closures apart": _pairs(halts, lambda a, b: whole_div(b["start_ns"], NS) > whole_div(a["end_ns"] - 1, NS) + 1),
        "halt ids": F.forall(halts, lambda h: F.rlike(h["id"], F.lit(r"^[A-Za-z0-9._:-]{1,128}$"))) & (F.size(F.array_distinct(F.transform(halts, lambda h: h["id"]))) == F.size(halts)),
    }
    return out


def admit(context: DataFrame, keys: Sequence[str] = ("session_date", "symbol")) -> DataFrame:
    """Contexts with ``reasons`` (names of broken rules) and ``state``; a repeated member is blocked."""
    checks = rules()
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in checks.items()]))
    repeats = context.groupBy(*keys).agg(F.count("*").alias("_n"))
    out = context.join(repeats, list(keys)).withColumn("reasons", F.concat(reasons, F.when(F.col("_n") > 1, F.array(F.lit("repeated member"))).otherwise(F.array().cast("array<string>")))).drop("_n")
    return out.withColumn("state", F.when(F.size("reasons") == 0, "admitted").otherwise("blocked"))
